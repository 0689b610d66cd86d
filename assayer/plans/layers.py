"""The whole job: raw events to Bronze, Silver and Gold, as tables under a name.

    spark-submit build_layers.py --events <folder> --root <folder>

With ``--stream`` the events that have come to a folder of JSON files since the
last run are taken to Silver and Gold as a stream; run it as often as needed.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assayer.constants import LAYERS, RETENTION_DAYS
from assayer.operators.accounting import (
    ALL_ROWS,
    drop_accounting,
    drops_of,
    layer_summary,
    reason_counts,
    summary_of,
)
from assayer.operators.contract import EVENT_CONTRACT
from assayer.operators.gold import (
    REVENUE_PER_HOUR,
    Rollup,
    purchases,
    revenue_rollup,
    sorted_for_sink,
    stamp,
)
from assayer.operators.silver import to_silver, to_strict_silver
from assayer.session import build_session
from assayer.sources.events import (
    ORIGIN,
    read_json_events,
    read_parquet_events,
    stream_json_events,
    with_origins,
)
from assayer.sources.layers import (
    APPEND,
    REPLACE,
    current_table,
    drop_loads,
    ensure_namespaces,
    save_table,
    show_table,
    stage_table,
)
from assayer.sources.snapshots import LOAD, Ledger, expirable
from assayer.streaming.gold import RevenueStream
from assayer.streaming.silver import start_silver

RETENTION = timedelta(days=RETENTION_DAYS)

#: The reason of a raw row while it is counted; not written.
JUDGED = "__judged"

TABLES = {"bronze": "events", "silver": "events", "gold": "revenue_per_hour"}

#: Gold keeps the load of its rows: a group of two loads has a row of each.
REVENUE_PER_LOAD = Rollup(keys=(*REVENUE_PER_HOUR.keys, LOAD))


@dataclass(frozen=True)
class BuildCounts:
    """What a build has counted while it wrote: nothing is read again for it."""

    spark: SparkSession
    observed: dict[str, Observation]

    def drops(self) -> DataFrame:
        """Why rows of this load did not reach Silver (``drop_accounting``)."""
        counts = self.observed["bronze"].get
        kinds = ", ".join(f"`{name}` bigint" for name in counts)
        return drops_of(self.spark.createDataFrame([tuple(counts.values())], kinds))

    def summary(self) -> DataFrame:
        """Records per layer of this load, dropped rows, revenue (``layer_summary``)."""
        counts = {layer: seen.get for layer, seen in self.observed.items()}
        row = [counts["bronze"][ALL_ROWS], counts["silver"]["n"], counts["gold"]["n"]]
        kinds = "bronze bigint, silver bigint, gold bigint, total_revenue decimal(38,2)"
        row = (*row, counts["gold"]["revenue"])
        return summary_of(self.spark.createDataFrame([row], kinds))


@dataclass(frozen=True)
class Layers:
    """The three tables of one root folder: bronze.events and so on.

    ``prefix`` stands before the names of the databases.
    """

    spark: SparkSession
    root: str
    prefix: str = ""

    def name(self, layer: str) -> str:
        return f"`{self.prefix}{layer}`.{TABLES[layer]}"

    def read(self, layer: str) -> DataFrame:
        """The rows that a layer has now, whatever is written later."""
        return self.spark.table(current_table(self.spark, self.name(layer)))

    def build(
        self, events: DataFrame, load: int = 0, mode: str = REPLACE
    ) -> BuildCounts:
        """Take one load of raw events through all layers; return what was counted.

        ``REPLACE`` begins the tables anew: all three are written before the first is
        shown, so that a build that fails changes nothing. ``APPEND`` adds to them; what an
        earlier attempt has left of the same load goes first. Each layer is written
        before the next one reads it, and reads this load's folder only. Silver keeps
        where in the files of Bronze its rows come from.
        """
        names = [f"{self.prefix}{layer}" for layer in LAYERS]
        ensure_namespaces(self.spark, self.root, names)
        number = F.lit(load).cast("bigint")
        staged: dict[str, str] = {}
        if mode == APPEND:
            for layer in LAYERS:
                if self.spark.catalog.tableExists(self.name(layer)):
                    drop_loads(self.spark, self.name(layer), LOAD, [load])

        def save(rows: DataFrame, layer: str) -> None:
            if mode == APPEND:
                save_table(rows, layer, self.name(layer), APPEND, split_by=LOAD)
            else:
                staged[layer] = stage_table(rows, layer, self.name(layer), split_by=LOAD)

        def written(layer: str) -> DataFrame:
            return self.spark.table(staged[layer]) if staged else self.read(layer)

        # Counted by the tasks that write; a task that is repeated counts once.
        observed = {layer: Observation() for layer in LAYERS}
        counted = counted_bronze(events, observed["bronze"])
        save(counted.withColumn(LOAD, number), "bronze")
        bronze = with_origins(written("bronze")).where(F.col(LOAD) == number)
        save(counted_silver(bronze, number, observed["silver"]), "silver")
        silver = written("silver").where(F.col(LOAD) == number)
        gold = revenue_rollup(purchases(silver), REVENUE_PER_LOAD)
        gold = stamp(sorted_for_sink(gold, "hour_bucket", "category"))
        healthy = F.when(F.col("total_revenue") > 0, F.col("total_revenue"))
        revenue = F.sum(healthy).cast("decimal(38,2)").alias("revenue")
        save(gold.observe(observed["gold"], F.count(F.lit(1)).alias("n"), revenue), "gold")
        for layer, fresh in staged.items():
            show_table(self.spark, self.name(layer), fresh)
        return BuildCounts(self.spark, observed)

    def expire(self, ledger: Ledger, now: Column, max_age: timedelta = RETENTION) -> list[int]:
        """Drop the loads that no snapshot worth keeping shows; return their ids."""
        loads = sorted(r[LOAD] for r in expirable(ledger, now, max_age).collect())
        for layer in LAYERS:
            drop_loads(self.spark, self.name(layer), LOAD, loads)
        return loads

    def append(self, events: DataFrame, load: int) -> BuildCounts:
        """Add one load of raw events to all layers."""
        return self.build(events, load, APPEND)

    def summary(self) -> DataFrame:
        """Records per layer, dropped rows and clean revenue."""
        return layer_summary(*[self.read(layer) for layer in LAYERS])

    def drops(self) -> DataFrame:
        """Why Bronze rows did not reach Silver."""
        return drop_accounting(self.read("bronze"))


def counted_bronze(events: DataFrame, seen: Observation) -> DataFrame:
    """Raw events whose reasons are counted by whoever reads them.

    Each row is judged once, in a column of its own; the counts would judge it again for
    each reason.
    """
    counts = reason_counts(F.col(JUDGED), EVENT_CONTRACT.reason_names(events))
    judged = events.withColumn(JUDGED, EVENT_CONTRACT.first_reason(events))
    return judged.observe(seen, *counts).drop(JUDGED)


def counted_silver(bronze: DataFrame, load: Column, seen: Observation) -> DataFrame:
    """Silver of one load, counted by whoever reads it.

    The load is a literal that comes last, so that rows are not sorted by it before they
    are written.
    """
    cleaned = to_strict_silver(bronze, carry=ORIGIN)
    counted = cleaned.observe(seen, F.count(F.lit(1)).alias("n"))
    return counted.withColumn(LOAD, load)


def run_stream(
    spark: SparkSession, events: str, root: str, files_per_batch: int = 1000
) -> RevenueStream:
    """Take the new JSON files of a folder to Silver and Gold, then stop.

    Both streams keep their place under ``root``. ``files_per_batch`` bounds a
    micro-batch however many files have come.
    """
    folder = f"{root.rstrip('/')}/stream"
    revenue = RevenueStream(f"{folder}/revenue")

    def source() -> DataFrame:
        return stream_json_events(spark, events, files_per_batch=files_per_batch)

    running = [
        start_silver(source(), f"{folder}/silver", f"{folder}/checkpoint/silver"),
        revenue.start(to_silver(source()), f"{folder}/checkpoint/gold"),
    ]
    for query in running:
        query.awaitTermination()
    return revenue


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--events", required=True, help="folder of raw events")
    parser.add_argument("--format", choices=("json", "parquet"), default="json")
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--load", type=int, default=0, help="number of the load")
    parser.add_argument("--append", action="store_true", help="add to the tables")
    parser.add_argument("--stream", action="store_true", help="take what is new")
    options = parser.parse_args(arguments)

    spark = build_session("build-layers")
    if options.stream:
        run_stream(spark, options.events, options.root).read_gold(spark).show()
        return
    read = {"json": read_json_events, "parquet": read_parquet_events}[options.format]
    layers = Layers(spark, options.root)
    mode = APPEND if options.append else REPLACE
    counts = layers.build(read(spark, options.events), options.load, mode)
    counts.summary().show(truncate=False)
    counts.drops().show(truncate=False)
