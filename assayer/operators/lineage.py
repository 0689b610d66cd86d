"""Tracing rows back: Gold to the Silver events, Silver to the Bronze rows.

Rows are told apart by where they come from, not by ids that may repeat: a
Silver row carries the file and the row of its Bronze row
(``sources.events.ORIGIN``), a Gold row the load it was made of.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.operators.gold import REVENUE_PER_HOUR, Rollup, purchases
from assayer.sources.events import ORIGIN, ORIGIN_FILE, ORIGIN_ROW


def trace_gold_to_silver(
    gold: DataFrame,
    silver: DataFrame,
    spec: Rollup = REVENUE_PER_HOUR,
    carry: Sequence[str] = (),
) -> DataFrame:
    """For each Gold row the Silver purchases behind it, one row per event.

    A Gold table that was appended to has a key once per load: name the load's
    column among the keys of ``spec``, and it is part of the join. A key that
    Gold has twice all the same fails the job, as there is no telling which of
    its rows an event belongs to.

    One null-safe equi-join. AQE broadcasts Gold if it has measured it to be
    small, and splits a key that stands for a large part of all events.
    """
    events = purchases(silver).select(
        spec.bucket(), *spec.keys, spec.row_id, spec.amount, *carry
    )
    groups = gold.groupBy(*spec.group).agg(
        F.count(F.lit(1)).alias("times"),
        F.any_value("total_revenue").alias("total_revenue"),
        F.any_value("transaction_count").alias("transaction_count"),
    )
    fail = F.raise_error(F.lit("lineage: Gold has a key more than once"))
    count = F.when(F.col("times") == 1, F.col("transaction_count")).otherwise(
        fail.cast("bigint")
    )
    groups = groups.select(
        *spec.group, "total_revenue", count.alias("transaction_count")
    )
    return _join(events, groups, spec.group).select(
        *spec.group,
        "total_revenue",
        "transaction_count",
        spec.row_id,
        spec.amount,
        *carry,
    )


def trace_bronze_to_gold(
    origins: DataFrame,
    silver: DataFrame,
    gold: DataFrame,
    spec: Rollup = REVENUE_PER_HOUR,
    keys: Sequence[str] = ORIGIN,
) -> DataFrame:
    """The Gold rows that some Bronze rows have gone into, and how many went into each.

    ``origins`` names Bronze rows by ``keys``: a file alone, or file and row. Silver is
    looked through once, by a semi-join, and combined by group before it meets Gold.
    """
    sold = purchases(silver).select(spec.bucket(), *spec.keys, *keys)
    touched = _rows_named(sold, origins, keys)
    groups = touched.groupBy(*spec.group).agg(F.count(F.lit(1)).alias("bronze_rows"))
    return _join(gold, groups, spec.group)


def trace_event(silver: DataFrame, event_id: str, spec: Rollup = REVENUE_PER_HOUR) -> DataFrame:
    """The Silver rows of one id; on written Silver most row groups are skipped."""
    return silver.where(F.col(spec.row_id) == event_id)


def trace_silver_to_bronze(
    silver: DataFrame, bronze: DataFrame, keys: Sequence[str] = ORIGIN
) -> DataFrame:
    """Per key of Silver: how many Silver and how many Bronze rows carry it.

    By origin, both are 1, and ``bronze_rows`` is 0 for an orphan; by an id
    that repeats they say how often. Nothing is joined: both sides are counted
    by key in one aggregation, so a key that repeats very often is combined
    within the tasks and never multiplies.
    """
    marked = _mark(silver, keys, silver=1).unionByName(_mark(bronze, keys, bronze=1))
    return (
        marked.groupBy(*keys)
        .agg(
            F.sum("silver_rows").alias("silver_rows"),
            F.sum("bronze_rows").alias("bronze_rows"),
        )
        .where(F.col("silver_rows") > 0)
    )


def bronze_rows_behind(
    silver: DataFrame, bronze: DataFrame, keys: Sequence[str] = ORIGIN
) -> DataFrame:
    """The unchanged Bronze rows whose key occurs in ``silver``.

    By origin, these are the very rows that became the Silver rows: another raw
    row with the same id is not among them. A semi-join: repeated keys on
    either side do not multiply rows.
    """
    return _rows_named(bronze, silver, keys)


def _mark(df: DataFrame, keys: Sequence[str], silver: int = 0, bronze: int = 0):
    return df.select(
        *keys,
        F.lit(silver).cast("bigint").alias("silver_rows"),
        F.lit(bronze).cast("bigint").alias("bronze_rows"),
    )


def names_of(rows: DataFrame, keys: Sequence[str] = ORIGIN) -> DataFrame:
    """What tells whether a row's keys are among those of ``rows``, in few short rows.

    By origin, rows would be shuffled and sorted with the paths of their files, which
    take next to nothing in a shuffle's compressed blocks and most of a task's memory.
    A file is named by its SHA-256 instead, and 64 neighbouring rows of it by one name
    with a bit for each.
    """
    names = [column.alias(f"_right_{key}") for key, column in _short(keys).items()]
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(keys))
    named = rows.select(*names, one.alias("_one"))
    return named.groupBy(*[f"_right_{key}" for key in keys]).agg(F.bit_or("_one").alias("_ones"))


def _short(keys: Sequence[str]) -> dict[str, Column]:
    """The keys as they are compared."""
    shorter = {
        ORIGIN_FILE: F.unhex(F.sha2(F.col(ORIGIN_FILE).cast("binary"), 256)),
        ORIGIN_ROW: F.shiftright(ORIGIN_ROW, 6),
    }
    return {key: shorter.get(key, F.col(key)) for key in keys}


def _bit(keys: Sequence[str]) -> Column:
    """The place of a row among its 64 neighbours."""
    if ORIGIN_ROW not in keys:
        return F.lit(0)
    return F.col(ORIGIN_ROW).bitwiseAND(F.lit(63)).cast("int")


def _rows_named(rows: DataFrame, names: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose keys occur among those of ``names``, with null equal to null.

    The null-safe join does not reuse the shuffle of the grouping. That is on
    purpose: only between two shuffles of its own can it split a skewed key.
    """
    added = {f"_left_{key}": c for key, c in _short(keys).items() if key in ORIGIN}
    added["_bit"] = _bit(keys)
    left = {key: f"_left_{key}" if key in ORIGIN else key for key in keys}
    shifted = F.call_function("shiftright", F.col("_ones"), F.col("_bit"))
    same = [F.col(left[key]).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    if ORIGIN_ROW in keys:
        # Rows without a number have no bit; their name is enough.
        same.append(F.col("_bit").isNull() | (shifted.bitwiseAND(F.lit(1)) == 1))
    found = rows.withColumns(added).join(
        names_of(names, keys), reduce(lambda a, b: a & b, same), "left_semi"
    )
    return found.drop(*added)


def _join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on ``keys`` with null equal to null; the left keys are kept."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same: list[Column] = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*[f"_right_{key}" for key in keys])
