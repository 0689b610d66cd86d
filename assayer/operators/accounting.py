"""How many rows each layer holds and why rows were left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from assayer.constants import REVENUE_EVENT
from assayer.operators.contract import EVENT_CONTRACT, OK, Contract
from assayer.operators.gold import REVENUE_PER_HOUR


ALL_ROWS = "all_rows"


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, one decimal; null if ``whole`` is 0.

    Integer arithmetic, so that the rounding (half up) is exact.
    """
    tenths = F.when(
        whole > 0, F.call_function("div", part * 2000 + whole, whole * 2)
    )
    return (tenths.cast(DecimalType(9, 0)) / F.lit(10)).cast(DecimalType(6, 1))


def drop_accounting(
    bronze: DataFrame, contract: Contract = EVENT_CONTRACT
) -> DataFrame:
    """Rows per first violated rule, ``ok`` last; every reason has a row.

    One pass with a single global aggregate. Its counters are combined within
    each task, so only one small row per task is shuffled.
    """
    judged = bronze.select(contract.first_reason(bronze).alias("reason"))
    counted = judged.agg(*reason_counts(F.col("reason"), contract.reason_names(bronze)))
    return drops_of(counted)


def reason_counts(reason: Column, names: Sequence[str]) -> list[Column]:
    """All rows, and those of each reason, as aggregates."""
    return [
        F.count(F.lit(1)).alias(ALL_ROWS),
        *[F.count_if(reason == name).alias(name) for name in names],
    ]


def drops_of(counted: DataFrame) -> DataFrame:
    """One row per reason from one row with ``reason_counts``."""
    names = [name for name in counted.columns if name != ALL_ROWS]
    entries = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("reason"),
                F.col(name).alias("rows"),
            )
            for position, name in enumerate(names)
        ]
    )
    return (
        counted.select(ALL_ROWS, F.inline(entries))
        .select(
            "position",
            "reason",
            "rows",
            percent(F.col("rows"), F.col(ALL_ROWS)).alias("rows_pct"),
        )
    )


def layer_summary(
    bronze: DataFrame, silver: DataFrame, gold: DataFrame
) -> DataFrame:
    """One row per layer: records, rows dropped before Silver, clean revenue.

    Each layer is read once and reduced to one row before they are put
    together. On written tables the counts come from the Parquet footers.
    """
    healthy = F.when(F.col("total_revenue") > 0, F.col("total_revenue"))
    layers = (
        _counted(bronze, "bronze")
        .unionByName(_counted(silver, "silver"))
        .unionByName(_counted(gold, "gold", revenue=F.sum(healthy)))
    )
    wide = layers.agg(
        *[
            F.sum(F.when(F.col("layer") == name, F.col("records"))).alias(name)
            for name in ("bronze", "silver", "gold")
        ],
        F.max("total_revenue").alias("total_revenue"),
    )
    return summary_of(wide)


def layer_summary_of(bronze: DataFrame, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """The same from raw events alone, in one pass over them.

    Events are combined by whether they pass the contract and, for purchases
    that do, by the group of the hourly rollup; the layers' counts and the
    revenue follow from those few rows.
    """
    kept = contract.first_reason(bronze) == OK
    sold = kept & (F.col("event_type") == REVENUE_EVENT)
    hour = F.when(sold, REVENUE_PER_HOUR.typed_bucket(contract))
    keys = [F.when(sold, F.col(k)).alias(k) for k in REVENUE_PER_HOUR.keys]
    amount = F.when(sold, contract.typed(REVENUE_PER_HOUR.amount))
    judged = bronze.select(
        kept.alias("kept"), sold.alias("sold"), hour.alias("hour"), *keys, amount.alias("amount")
    )
    groups = judged.groupBy("kept", "sold", "hour", *REVENUE_PER_HOUR.keys).agg(
        F.count(F.lit(1)).alias("records"), F.sum("amount").alias("revenue")
    )
    revenue = F.sum(F.when(F.col("sold") & (F.col("revenue") > 0), F.col("revenue")))
    wide = groups.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("bronze"),
        F.coalesce(F.sum(F.when(F.col("kept"), F.col("records"))), F.lit(0)).alias("silver"),
        F.count_if("sold").alias("gold"),
        revenue.cast(DecimalType(38, 2)).alias("total_revenue"),
    )
    return summary_of(wide)


def summary_of(wide: DataFrame) -> DataFrame:
    """One row per layer from one row with all counts."""
    dropped = F.col("bronze") - F.col("silver")
    no_count = F.lit(None).cast("bigint")
    no_pct = F.lit(None).cast(DecimalType(6, 1))
    no_revenue = F.lit(None).cast(DecimalType(38, 2))
    revenue = F.col("total_revenue")
    rows = F.array(
        _summary_row("bronze", no_count, no_pct, no_revenue),
        _summary_row("silver", dropped, percent(dropped, F.col("bronze")), no_revenue),
        _summary_row("gold", no_count, no_pct, revenue),
    )
    return wide.select(F.inline(rows))


def _counted(df: DataFrame, layer: str, revenue: Column | None = None) -> DataFrame:
    measured = F.lit(None) if revenue is None else revenue
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        measured.cast(DecimalType(38, 2)).alias("total_revenue"),
    ).select(F.lit(layer).alias("layer"), "records", "total_revenue")


def _summary_row(layer: str, dropped: Column, pct: Column, revenue: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"),
        F.col(layer).alias("records"),
        dropped.alias("dropped"),
        pct.alias("dropped_pct"),
        revenue.alias("total_revenue"),
    )
