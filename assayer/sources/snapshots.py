"""Snapshots of a table that grows by loads: as-of reads, history, audits, changes.

The rows of the table carry the id of their load. A ledger has two small tables, both
as long as there were loads:

* ``snapshots``: ``snapshot_id``, ``committed_at``, ``operation``, ``added_records`` and
  ``total_records``;
* ``intervals``: ``load_id`` and the snapshots that show it, from ``first_snapshot`` up to
  but not including ``end_snapshot`` (null: up to the newest). A load that a restore brings
  back has a second interval.

What a snapshot shows is a test on intervals. Both are ordinary DataFrames; nothing here
writes, and the rows of a table are never looked at in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.constants import HISTORY_LENGTH, RETENTION_DAYS

LOAD = "load_id"

REPLACE = "replace"
APPEND = "append"
RESTORE = "restore"

SNAPSHOTS = ("snapshot_id", "committed_at", "operation", "added_records", "total_records")
INTERVALS = (LOAD, "first_snapshot", "end_snapshot")

ADDED = "added"
REMOVED = "removed"
CHANGED = "changed"


@dataclass(frozen=True)
class Ledger:
    snapshots: DataFrame
    intervals: DataFrame

    def newest(self) -> Column:
        """The newest snapshot's id, as a scalar subquery."""
        return self.snapshots.agg(F.max("snapshot_id")).scalar()


def _open_at(snapshot: Column) -> Column:
    """Whether an interval has a snapshot."""
    ends = F.col("end_snapshot")
    return (F.col("first_snapshot") <= snapshot) & (ends.isNull() | (ends > snapshot))


def ledger_of(
    data: DataFrame,
    replaces: Column | None = None,
    time: str | None = None,
    load: str = LOAD,
) -> Ledger:
    """The ledger of a table whose loads came in the order of their ids.

    The first load, and each for which ``replaces`` holds (a condition on the
    load's id or ``committed_at``), replaces what was there before; the others
    are appended. ``committed_at`` is the latest ``time`` of a load.
    """
    latest = F.lit(None).cast("timestamp") if time is None else F.max(time)
    loads = data.groupBy(load).agg(
        F.count(F.lit(1)).alias("added_records"), latest.alias("committed_at")
    )
    in_order = Window.orderBy(load)
    number = F.row_number().over(in_order).cast("bigint") - 1
    starts = F.lit(False) if replaces is None else F.coalesce(replaces, F.lit(False))
    marked = loads.withColumn("snapshot_id", number).withColumn(
        "starts", starts | (F.col("snapshot_id") == 0)
    )
    # A load is visible until the next one that begins anew: from the last row up, the
    # start met last.
    later = Window.orderBy(F.desc(load)).rowsBetween(Window.unboundedPreceding, -1)
    start = F.when(F.col("starts"), F.col("snapshot_id"))
    marked = marked.withColumn("end_snapshot", F.last(start, ignorenulls=True).over(later))
    period = F.sum(F.col("starts").cast("bigint")).over(in_order)
    so_far = Window.partitionBy("period").orderBy("snapshot_id")
    snapshots = (
        marked.withColumn("period", period)
        .withColumn("total_records", F.sum("added_records").over(so_far))
        .withColumn("operation", F.when(F.col("starts"), REPLACE).otherwise(APPEND))
    )
    intervals = marked.withColumn("first_snapshot", F.col("snapshot_id"))
    shown = [F.col(load).alias(LOAD), "first_snapshot", "end_snapshot"]
    return Ledger(snapshots.select(*SNAPSHOTS), intervals.select(*shown))


def restored(ledger: Ledger, snapshot_id: int, after: timedelta) -> Ledger:
    """The ledger with one more snapshot, which shows what ``snapshot_id`` showed.

    An unknown ``snapshot_id`` changes nothing.
    """
    is_target = F.col("snapshot_id") == snapshot_id
    last = ledger.snapshots.agg(
        F.max("snapshot_id").alias("last_id"),
        F.max("committed_at").alias("last_at"),
        F.first(F.when(is_target, F.col("total_records")), ignorenulls=True).alias("total"),
    ).where(F.col("total").isNotNull())
    entry = last.select(
        (F.col("last_id") + 1).alias("snapshot_id"),
        (F.col("last_at") + F.lit(after)).alias("committed_at"),
        F.lit(RESTORE).alias("operation"),
        F.lit(0).cast("bigint").alias("added_records"),
        F.col("total").alias("total_records"),
    )
    fresh = last.select("last_id").scalar() + 1  # null if the target is unknown
    of_load = Window.partitionBy(LOAD)
    is_open = F.col("end_snapshot").isNull()
    marked = ledger.intervals.withColumn("fresh", fresh).withColumns(
        {
            "wanted": _open_at(F.lit(snapshot_id)),
            "is_open": is_open,
            # A load shown in the target and, by whichever interval, now.
            "wanted_load": F.max(_open_at(F.lit(snapshot_id))).over(of_load),
            "open_load": F.max(is_open).over(of_load),
        }
    )
    ends = F.when(F.col("is_open") & ~F.col("wanted_load"), F.col("fresh"))
    kept = marked.withColumn("end_snapshot", F.coalesce("end_snapshot", ends))
    again = marked.where(F.col("wanted") & ~F.col("open_load") & F.col("fresh").isNotNull())
    again = again.select(
        LOAD,
        F.col("fresh").alias("first_snapshot"),
        F.lit(None).cast("bigint").alias("end_snapshot"),
    )
    return Ledger(
        ledger.snapshots.unionByName(entry),
        kept.select(*INTERVALS).unionByName(again),
    )


def loads_of(ledger: Ledger, snapshot_id: int | None = None) -> DataFrame:
    """The loads that a snapshot shows; without an id, the newest one."""
    if snapshot_id is None:
        shown = F.col("end_snapshot").isNull()
    else:
        known = ledger.snapshots.agg(F.max("snapshot_id")).scalar()
        shown = _open_at(F.lit(snapshot_id)) & (F.lit(snapshot_id) <= known)
    return ledger.intervals.where(shown).select(LOAD)


def read_as_of(
    data: DataFrame, ledger: Ledger, snapshot_id: int | None = None, load: str = LOAD
) -> DataFrame:
    """The rows visible in a snapshot; without an id, in the newest one.

    A semi-join with the few loads of the snapshot: a table that is split into
    folders by load is read in those folders only.
    """
    loads = loads_of(ledger, snapshot_id).withColumnRenamed(LOAD, load)
    return data.join(loads, load, "left_semi")


def history(ledger: Ledger, n: int = HISTORY_LENGTH) -> DataFrame:
    """The newest ``n`` snapshots, newest first."""
    newest = (F.desc("committed_at"), F.desc("snapshot_id"))
    return ledger.snapshots.orderBy(*newest).limit(n)


def expirable(
    ledger: Ledger,
    now: Column,
    max_age: timedelta = timedelta(days=RETENTION_DAYS),
) -> DataFrame:
    """Loads that no snapshot worth keeping shows, with the time they came.

    Kept are the snapshots younger than ``max_age`` and the newest one, and with them
    those that came after the first of these. This reports only; ``layers.drop_loads``
    drops them.
    """
    young = F.col("committed_at") > now - F.lit(max_age)
    judged = ledger.snapshots.withColumn("is_young", young)
    first = judged.agg(
        F.min(F.when(F.col("is_young"), F.col("snapshot_id"))).alias("young"),
        F.max("snapshot_id").alias("newest"),
    ).select(F.least("young", "newest")).scalar()
    # Used by a kept snapshot: an interval that goes on beyond the first of them.
    last = F.max(F.coalesce("end_snapshot", F.lit(2**63 - 1)))
    used = ledger.intervals.groupBy(LOAD).agg(
        last.alias("until"), F.min("first_snapshot").alias("snapshot_id")
    )
    gone = used.withColumn("kept_from", first).where(F.col("until") <= F.col("kept_from"))
    # The first snapshot that shows a load is the one that wrote it.
    return gone.join(ledger.snapshots, "snapshot_id").select(
        LOAD, "committed_at", "added_records"
    )


def sums_by_load(
    frames: Sequence[DataFrame], load: str = LOAD, **sums: Column
) -> DataFrame:
    """Additive aggregates (counts, sums) of each load.

    A table whose schema has changed is given as one frame per schema, each
    with the loads that were written in it. Where a frame lacks a column that
    an aggregate needs, the aggregate is null: it cannot be known.
    """

    def of(frame: DataFrame) -> DataFrame:
        columns = []
        for name, value in sums.items():
            try:
                frame.select(value)
            except AnalysisException as error:
                if not str(error.getCondition()).startswith("UNRESOLVED_COLUMN"):
                    raise
                value = F.lit(None).cast("bigint")
            columns.append(value.alias(name))
        return frame.groupBy(load).agg(*columns)

    return reduce(DataFrame.unionByName, [of(frame) for frame in frames])


def audit(ledger: Ledger, by_load: DataFrame, load: str = LOAD) -> DataFrame:
    """The aggregates of every snapshot, next to what it did to the row count.

    ``by_load`` has one row per load (``sums_by_load``): the rows of the table
    are read once, whatever the number of snapshots. A load's aggregates come in with
    the first snapshot of an interval and go out at its end, so running sums give those
    of every snapshot; they are exact for whole numbers and decimals. The aggregate of a
    snapshot is null if that of one of its loads is.
    """
    names = [name for name in by_load.columns if name != load]
    known = by_load.withColumnRenamed(load, LOAD)
    valued = ledger.intervals.join(known, LOAD, "left")

    def step(at: str, sign: int) -> DataFrame:
        columns = []
        for name in names:
            value = F.coalesce(F.col(name), F.lit(0)) * sign
            unknown = F.col(name).isNull().cast("bigint") * sign
            columns += [value.alias(name), unknown.alias(f"_no_{name}")]
        return valued.where(F.col(at).isNotNull()).select(
            F.col(at).alias("snapshot_id"), *columns
        )

    steps = step("first_snapshot", 1).unionByName(step("end_snapshot", -1))
    sums = [F.sum(c).alias(c) for c in steps.columns if c != "snapshot_id"]
    steps = steps.groupBy("snapshot_id").agg(*sums)
    in_order = Window.orderBy("snapshot_id")
    running = in_order.rowsBetween(Window.unboundedPreceding, 0)

    def total(name: str) -> Column:
        value = F.coalesce(F.sum(name).over(running), F.lit(0))
        return F.when(F.coalesce(F.sum(f"_no_{name}").over(running), F.lit(0)) == 0, value)

    before = F.lag("total_records").over(in_order)
    return ledger.snapshots.join(steps, "snapshot_id", "left").select(
        "snapshot_id",
        "operation",
        F.col("total_records").alias("records"),
        (F.col("total_records") - before).alias("record_change"),
        *[total(name).alias(name) for name in names],
    )


def changes(
    data: DataFrame,
    ledger: Ledger,
    before: int,
    after: int,
    keys: Sequence[str],
    load: str = LOAD,
) -> DataFrame:
    """What differs between two snapshots, row by row.

    Rows of ``after`` count up and those of ``before`` down; what is left over was added
    or removed, ``times`` says how often (equal rows count each). Loads that both
    snapshots show are not read. ``change`` says whether a key has rows of one kind
    only, or was ``changed``. One aggregation of the rows, no join of them.
    """
    values = [c for c in data.columns if c != load]
    sides = (
        loads_of(ledger, before).select(LOAD, F.lit(-1).alias("sign"))
        .unionByName(loads_of(ledger, after).select(LOAD, F.lit(1).alias("sign")))
        .groupBy(LOAD).agg(F.sum("sign").alias("sign")).where("sign != 0")
    )
    signed = data.join(sides.withColumnRenamed(LOAD, load), load)
    counted = signed.groupBy(*values).agg(F.sum("sign").cast("bigint").alias("n"))
    left = counted.where("n != 0")
    of_key = Window.partitionBy(*keys)
    both = (F.max("n").over(of_key) > 0) & (F.min("n").over(of_key) < 0)
    side = F.when(F.col("n") > 0, F.lit(ADDED)).otherwise(F.lit(REMOVED))
    return left.withColumns(
        {"change": F.when(both, F.lit(CHANGED)).otherwise(side), "side": side}
    ).select(*values, "change", "side", F.abs("n").alias("times"))
