"""Tables of the three layers: names, atomic replace, append, dropped loads.

A name stands for a view, and the view for the table that holds the rows now. A
replace writes a new table under a name of its own and then lets the view show it, in
one command of the catalog: whoever reads sees the old rows or the new ones, and a
write that fails leaves the old ones in place. The table before the newest is kept for
those who still read it; older ones are dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from assayer.constants import LAYER_CODECS, LAYERS

REPLACE = "overwrite"
APPEND = "append"

#: Properties of the view: the table it shows and the one before.
CURRENT = "assayer.current"
PREVIOUS = "assayer.previous"


def ensure_namespaces(
    spark: SparkSession, root: str | None = None, names: Iterable[str] = LAYERS
) -> None:
    """Create the databases of the layers in the catalog, if they are missing."""
    for name in names:
        location = "" if root is None else f" LOCATION '{root.rstrip('/')}/{name}'"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{location}")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(name):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def current_table(spark: SparkSession, name: str) -> str:
    """The table that a name stands for now; later replaces don't change its rows."""
    return _properties(spark, name).get(CURRENT, name)


def stage_table(
    df: DataFrame, layer: str, name: str, split_by: str | None = None
) -> str:
    """Write the rows as a new table, which no view shows yet; return its name."""
    fresh = f"{name}__{uuid.uuid4().hex[:12]}"
    _writer(df, layer, split_by).mode("errorifexists").saveAsTable(fresh)
    return fresh


def show_table(spark: SparkSession, name: str, fresh: str) -> None:
    """Let a name stand for a staged table from now on."""
    before = _properties(spark, name)
    properties = {CURRENT: fresh}
    if CURRENT in before:
        properties[PREVIOUS] = before[CURRENT]
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS SELECT * FROM {fresh}"
    )
    if PREVIOUS in before:
        spark.sql(f"DROP TABLE IF EXISTS {before[PREVIOUS]}")


def save_table(
    df: DataFrame, layer: str, name: str, mode: str, split_by: str | None = None
) -> None:
    """Write a table of the catalog in the codec of its layer.

    ``name`` is the table's full name. ``REPLACE`` gives it the rows and the
    schema of ``df``; ``APPEND`` adds rows, with columns matched by name.
    """
    spark = df.sparkSession
    known = CURRENT in _properties(spark, name)
    if mode == APPEND and known:
        into = current_table(spark, name)
        _writer(df, layer, split_by).mode("append").saveAsTable(into)
    else:
        show_table(spark, name, stage_table(df, layer, name, split_by))


#: Columns whose Bloom filters let a search for one value skip row groups. Their size
#: follows the number of values in a row group.
SEARCHED = {"silver": ("event_id",)}


def _writer(df: DataFrame, layer: str, split_by: str | None):
    writer = df.write.format("parquet").option("compression", LAYER_CODECS[layer])
    for column in SEARCHED.get(layer, ()):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    return writer if split_by is None else writer.partitionBy(split_by)


def drop_loads(spark: SparkSession, name: str, split_by: str, loads: Iterable[int]) -> None:
    """Drop the rows of some loads from a table that is split by load.

    Commands of the catalog only: no row is read or written again.
    """
    parts = [f"PARTITION (`{split_by}` = {int(load)})" for load in loads]
    for first in range(0, len(parts), 100):
        some = ", ".join(parts[first : first + 100])
        spark.sql(f"ALTER TABLE {current_table(spark, name)} DROP IF EXISTS {some}")
