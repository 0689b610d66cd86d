"""Hourly revenue on a stream, with exact distinct buyers.

Two forms with different treatment of late events:

* ``windowed_revenue``: an hour is emitted once, when the watermark has passed it;
  events that come later are dropped by Spark.
* ``RevenueStream``: an hour is corrected whenever events for it come, until it lies
  further back than is kept; state per (hour, key, buyer) is held that long.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    LongType,
    StructField,
    StructType,
)

from assayer.constants import LAYER_CODECS, MONEY, MONEY_TOTAL, RETENTION_DAYS
from assayer.operators.gold import (
    MEASURES,
    REVENUE_PER_HOUR,
    Rollup,
    buyer_partials,
    measures_from_partials,
    measures_from_sums,
    purchases,
)
from assayer.session import ROCKSDB, STATE_STORE, reach_workers, with_settings

PART = "part_us"
BUCKET = "bucket_us"
END = "end_ms"
SLOT = "slot"
VERSION = "version"
LATE = "late"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
#: State partitions of a new stream; one that goes on keeps the number it began with.
PARTITIONS_PER_CORE = 2
#: Buyers of an hour's slot that are kept with its totals.
FIRST_BUYERS = 64
#: What is known of a slot.
TOTALS = (
    StructField("amount_sum", MONEY_TOTAL),
    StructField("amount_count", LongType()),
    StructField("amount_max", MONEY),
    StructField("amount_min", MONEY),
    StructField("row_count", LongType()),
    StructField("buyer_count", LongType()),
)


def windowed_revenue(
    silver: DataFrame, delay: str = "1 hour", spec: Rollup = REVENUE_PER_HOUR
) -> DataFrame:
    """Measures of closed windows, for append mode.

    Spark refuses a distinct count on a stream. Two chained window
    aggregations give the same: the first has one state row per (window, key,
    buyer), which also spreads a hot key over the state partitions, the second
    counts those rows. State is held for open windows only.
    """
    width = f"1 {spec.grain}"
    rows = purchases(silver).withWatermark(spec.ts, delay)
    partials = buyer_partials(rows, spec, bucket=F.window(spec.ts, width))
    again = F.window(F.col(spec.bucket_name), width).alias(spec.bucket_name)
    totals = measures_from_partials(partials, spec, group=[again, *spec.keys])
    start = F.col(spec.bucket_name)["start"].alias(spec.bucket_name)
    return totals.select(start, *spec.keys, *MEASURES)


def start_windowed_revenue(
    silver: DataFrame, path: str, checkpoint: str, delay: str = "1 hour"
) -> StreamingQuery:
    """Write closed hours to Parquet until all available events are read."""
    return (
        windowed_revenue(silver, delay)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", LAYER_CODECS["gold"])
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


class SlotTotals(StatefulProcessor):
    """Totals of the hours of one (day, key, slot); each buyer belongs to one slot.

    State: the totals of each hour with its first buyers, and a map of all further
    buyers, so that a call reads and writes one value unless an hour has many. Each call
    emits the totals so far of the hours it touches, with a version; the highest of an
    hour's slot counts. A timer closes the day when the watermark passes its end: totals
    and buyers go. What comes for a closed day can't be merged exactly any more; it is
    emitted as totals of its own, marked late, so that nothing is lost or counted twice.
    """

    def __init__(self, spec: Rollup, buyer: DataType) -> None:
        self.spec = spec
        self.buyer = buyer

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        first = StructField("first_buyers", ArrayType(self.buyer))
        hour = StructType([StructField(BUCKET, LongType()), *TOTALS, first])
        fields = [StructField(VERSION, LongType()), StructField("hours", ArrayType(hour))]
        self.hours = handle.getValueState("hours", StructType(fields))
        self.others = handle.getMapState(
            "other_buyers",
            StructType([StructField(BUCKET, LongType()), StructField("buyer", self.buyer)]),
            StructType([StructField("seen", BooleanType())]),
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        spec, end = self.spec, 0
        come: dict[int, tuple[list, list, set]] = {}
        for row in rows:
            end = row[END]
            amounts, ids, buyers = come.setdefault(row[BUCKET], ([], [], set()))
            if row[spec.amount] is not None:
                amounts.append(row[spec.amount])
            if row[spec.row_id] is not None:
                ids.append(1)
            if row[spec.buyer] is not None:
                buyers.add(row[spec.buyer])
        late = end <= timerValues.getCurrentWatermarkInMs()
        found = None if late else self.hours.get()
        version, hours = (found[0], {h[0]: tuple(h) for h in found[1]}) if found else (0, {})
        version += 1
        for bucket, (amounts, ids, buyers) in come.items():
            known = hours.get(bucket, (bucket, None, 0, None, None, 0, 0, []))
            _, total, count, most, least, n, buyer_count, first = known
            if not late:
                buyers, first = self._fresh(bucket, buyers, list(first), buyer_count)
            held = [x for x in (most, least) if x is not None]
            totals = (
                sum(amounts, total or Decimal(0)) if amounts else total,
                count + len(amounts),
                max([*amounts, *held], default=None),
                min([*amounts, *held], default=None),
                n + len(ids),
                buyer_count + len(buyers),
            )
            hours[bucket] = (bucket, *totals, first)
            names = [BUCKET, *spec.keys, SLOT, *[f.name for f in TOTALS], VERSION, LATE]
            yield Row(**dict(zip(names, (bucket, *key[1:], *totals, version, late))))
        if not late:
            self.hours.update((version, list(hours.values())))
            if found is None:
                self.handle.registerTimer(end)

    def _fresh(self, bucket: int, buyers: set, first: list, known: int) -> tuple[list, list]:
        """An hour's buyers not seen before, now kept, and the first ones of all."""
        fresh = sorted(buyers.difference(first))
        if known > len(first):  # some are in the map
            fresh = [b for b in fresh if not self.others.containsKey((bucket, b))]
        room = FIRST_BUYERS - len(first)
        for buyer in fresh[room:]:
            self.others.updateValue((bucket, buyer), (True,))
        return fresh, first + fresh[:room]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.hours.clear()
        self.others.clear()
        return iter([])


class RevenueStream:
    """Gold that follows a stream of Silver events, late ones included.

    The log under ``path`` has a row for every (hour, key, slot) that a micro-batch
    touched: its totals so far. Spark's file sink lists the files of each micro-batch
    when it is complete, so a reader sees whole micro-batches only, a repeated one
    adds nothing, and a micro-batch writes one file per task, whatever hours it has.

    A hot (hour, key) is spread over ``slots`` by its buyers. ``keep`` is how far behind the
    newest event a day may end and its hours still be corrected. ``part`` is the span whose
    hours are held and closed together.
    """

    def __init__(
        self,
        path: str,
        spec: Rollup = REVENUE_PER_HOUR,
        slots: int = 8,
        keep: timedelta = timedelta(days=RETENTION_DAYS),
        part: str = "day",
    ):
        self.spec = spec
        self.path = path.rstrip("/") + "/log"
        self.slots = slots
        self.keep = f"{int(keep.total_seconds())} seconds"
        self.part = part

    def log(self, silver: DataFrame) -> DataFrame:
        """What the stream appends to the log."""
        spec = self.spec
        reach_workers(silver.sparkSession)
        slot = F.pmod(F.xxhash64(spec.buyer), F.lit(self.slots)).cast("int").alias(SLOT)
        part = F.date_trunc(self.part, spec.ts)
        # Only what is needed, so that the source reads no other fields and no mask is
        # computed. Without the time itself: Spark would drop the late rows by it.
        needed = purchases(silver.withWatermark(spec.ts, self.keep)).select(
            F.unix_micros(part).alias(PART),
            *spec.keys,
            slot,
            F.unix_micros(spec.bucket()).alias(BUCKET),
            F.unix_millis(part + F.expr(f"interval 1 {self.part}")).alias(END),
            spec.amount,
            spec.row_id,
            spec.buyer,
        )
        fields = needed.schema
        kept = [*[fields[n] for n in (BUCKET, *spec.keys, SLOT)], *TOTALS]
        schema = StructType(
            [
                *[StructField(f.name, f.dataType) for f in kept],
                StructField(VERSION, LongType()),
                StructField(LATE, BooleanType()),
            ]
        )
        processor = SlotTotals(spec, fields[spec.buyer].dataType)
        totals = needed.groupBy(PART, *spec.keys, SLOT).transformWithState(
            processor, schema, "Append", "EventTime"
        )
        time = F.timestamp_micros(BUCKET).alias(spec.bucket_name)
        return totals.select(time, *[n for n in schema.names if n != BUCKET])

    def start(self, silver: DataFrame, checkpoint: str) -> StreamingQuery:
        """Process all available events and stop; start again for more."""
        writer = (
            self.log(silver)
            .writeStream.format("parquet")
            .option("path", self.path)
            .option("checkpointLocation", checkpoint)
            .option("compression", LAYER_CODECS["gold"])
            .outputMode("append")
            .trigger(availableNow=True)
        )
        # Named states need RocksDB, whatever the session's setting is; a query keeps the
        # settings it was started with. Each micro-batch starts a Python worker and
        # commits a store per state partition, however few rows it has: no more of them
        # than keep the cores busy.
        spark = silver.sparkSession
        most = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
        partitions = min(int(spark.conf.get(SHUFFLE_PARTITIONS)), most)
        settings = {STATE_STORE: ROCKSDB, SHUFFLE_PARTITIONS: str(partitions)}
        with with_settings(spark, settings):
            return writer.start()

    def read_log(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def read_gold(self, spark: SparkSession) -> DataFrame:
        """The current Gold rows: the newest totals of each slot, added up."""
        spec = self.spec
        newest = F.max_by(F.struct(*[f.name for f in TOTALS]), VERSION).alias("newest")
        slots = self.read_log(spark).where(~F.col(LATE))
        slots = slots.groupBy(*spec.group, SLOT).agg(newest).select(*spec.group, "newest.*")
        sums = slots.groupBy(*spec.group).agg(
            F.sum("amount_sum").cast(MONEY_TOTAL).alias("amount_sum"),
            F.sum("amount_count").alias("amount_count"),
            F.sum("row_count").alias("transaction_count"),
            F.max("amount_max").alias("max_order_value"),
            F.min("amount_min").alias("min_order_value"),
            # No buyer is in two slots.
            F.sum("buyer_count").alias("unique_buyers"),
        )
        return measures_from_sums(sums, spec)

    def read_late(self, spark: SparkSession) -> DataFrame:
        """Totals of what came for hours after they were closed, one row per micro-batch."""
        return self.read_log(spark).where(LATE).drop(LATE, VERSION)
