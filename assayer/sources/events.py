"""Readers of raw events. All of them take an explicit schema: no inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from assayer.constants import BRONZE_SCHEMA
from assayer.functions.coercion import coerce
from assayer.operators.contract import conform

CORRUPT = "_corrupt_record"

# Where a row lies in the raw files; exact even if ids repeat.
ORIGIN_FILE = "origin_file"
ORIGIN_ROW = "origin_row"
ORIGIN = (ORIGIN_FILE, ORIGIN_ROW)


def with_corrupt(schema: StructType) -> StructType:
    """``schema`` plus the column that keeps the text of unreadable records."""
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def read_json_events(
    spark: SparkSession, path: str, schema: StructType = BRONZE_SCHEMA
) -> DataFrame:
    """Events from JSON lines. An unreadable line is kept as text, not dropped."""
    return _json_options(spark.read, schema).json(path)


def stream_json_events(
    spark: SparkSession,
    path: str,
    schema: StructType = BRONZE_SCHEMA,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The same as a stream over a folder that receives JSON files."""
    reader = _json_options(spark.readStream, schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def parse_json(text: Column | str, schema: StructType) -> Column:
    """A JSON string column as a struct, with unreadable text in ``CORRUPT``."""
    return F.from_json(
        text,
        with_corrupt(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def read_parquet_events(
    spark: SparkSession,
    path: str,
    schema: StructType = BRONZE_SCHEMA,
    with_origin: bool = False,
) -> DataFrame:
    """Events from Parquet, optionally with the file and row they came from."""
    rows = spark.read.schema(schema).parquet(path)
    return with_origins(rows) if with_origin else rows


def with_origins(rows: DataFrame) -> DataFrame:
    """Rows of a Parquet table, as it was read, with their file and row in it."""
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias(ORIGIN_FILE),
        F.col("_metadata.row_index").alias(ORIGIN_ROW),
    )


def literal_rows(
    spark: SparkSession, rows: Sequence[Sequence[object]], schema: StructType
) -> DataFrame:
    """A small batch typed by hand, in the columns and types of a table.

    Values may be given in any form that reads as the column's type: a time as text, an
    amount as a float. One that does not becomes null and fails if the column may not be.
    """
    texts = [[None if v is None else str(v) for v in row] for row in rows]
    untyped = StructType([StructField(name, StringType()) for name in schema.names])
    given = spark.createDataFrame(texts, untyped)
    typed = given.select(*[coerce(F.col(f.name), f.dataType).alias(f.name) for f in schema])
    return conform(typed, schema)


def _json_options(reader, schema: StructType):
    return (
        reader.schema(with_corrupt(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
