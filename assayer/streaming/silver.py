"""Bronze to Silver on a stream: the batch transform with a file sink.

Two forms: ``start_silver`` keeps what the contract accepts; ``QuarantinedSilver`` keeps
what it rejects as well, with the reason and the raw row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayer.constants import LAYER_CODECS
from assayer.operators.contract import EVENT_CONTRACT, OK, Contract, checked
from assayer.operators.silver import silver_columns, to_strict_silver

OUTCOME = "outcome"
ACCEPTED = "accepted"
REJECTED = "rejected"
REASON = "reason"
RAW = "raw"


def start_silver(bronze: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Clean all events that have arrived and stop; start again for more.

    The rows have the exact schema of the contract: a null in a non-null column
    fails the micro-batch. Stateless, and exactly once: the file sink lists each micro-batch in its
    log, so a repeated one adds nothing. ``processed_at`` is the time of the
    micro-batch.
    """
    return _start(to_strict_silver(bronze), path, checkpoint)


class QuarantinedSilver:
    """Silver and, next to it, the rows that did not get there.

    One read of the stream and one write: a row lands in the folder of its outcome, and
    a micro-batch counts for both outcomes at the moment Spark's file sink lists its
    files. There is no state in between in which one of them has a micro-batch and the
    other has not, and a repeated one adds nothing. So accepted and rejected rows
    together are what has landed, at any time.

    A rejected row keeps its raw columns as they came, with the first rule it violates,
    and the file it came in.

    While the stream runs, ``session.OPEN_FILES`` of two or more spares a sort of all rows
    by outcome. Spark's file sink looks at the session's value at each micro-batch.
    """

    def __init__(self, path: str, contract: Contract = EVENT_CONTRACT) -> None:
        self.path = path.rstrip("/")
        self.contract = contract

    def judged(self, bronze: DataFrame) -> DataFrame:
        """Every row with its outcome; works on batch and streaming input."""
        accepted = F.col(REASON) == OK
        rows = bronze.select(
            "*",
            self.contract.first_reason(bronze).alias(REASON),
            F.col("_metadata.file_path").alias("file"),
        )
        columns = dict(zip(self.contract.schema.names, silver_columns(bronze, self.contract)))
        cleaned = [
            # Checked again where it must not be null, as in the strict form.
            F.when(accepted, checked(columns[f.name], f)).alias(f.name)
            for f in self.contract.schema.fields
        ]
        raw = F.when(~accepted, F.struct(*bronze.columns)).alias(RAW)
        outcome = F.when(accepted, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED))
        file = F.when(~accepted, F.col("file")).alias("origin_file")
        reason = F.when(~accepted, F.col(REASON)).alias(REASON)
        return rows.select(*cleaned, reason, file, raw, outcome.alias(OUTCOME))

    def start(self, bronze: DataFrame, checkpoint: str) -> StreamingQuery:
        """Judge all events that have arrived and stop; start again for more."""
        return _start(self.judged(bronze), self.path, checkpoint, OUTCOME)

    def read_silver(self, spark: SparkSession) -> DataFrame:
        """The accepted rows, in the columns of the contract."""
        return self._read(spark, ACCEPTED).select(*self.contract.schema.names)

    def read_quarantine(self, spark: SparkSession) -> DataFrame:
        """The rejected rows: ``reason``, ``origin_file`` and the raw columns."""
        return self._read(spark, REJECTED).select(REASON, "origin_file", f"{RAW}.*")

    def _read(self, spark: SparkSession, outcome: str) -> DataFrame:
        return spark.read.parquet(self.path).where(F.col(OUTCOME) == outcome)


def _start(
    rows: DataFrame, path: str, checkpoint: str, split_by: str | None = None
) -> StreamingQuery:
    writer = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", LAYER_CODECS["silver"])
        .outputMode("append")
        .trigger(availableNow=True)
    )
    return (writer if split_by is None else writer.partitionBy(split_by)).start()
