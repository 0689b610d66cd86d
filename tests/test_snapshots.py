from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans import plan_of
from pyspark.sql import functions as F

from assayer.operators.asof import join_as_of
from assayer.session import new_workspace
from assayer.sources.snapshots import (
    LOAD,
    audit,
    changes,
    expirable,
    history,
    ledger_of,
    loads_of as loads_seen,
    read_as_of,
    restored,
    sums_by_load,
)

START = datetime(2024, 1, 1)


def loads_of(spark, sizes):
    """A table with a load of each size, one day apart; values from -1 up."""
    rows = [
        (load, START + timedelta(days=load), value - 1)
        for load, size in enumerate(sizes)
        for value in range(size)
    ]
    return spark.createDataFrame(rows, f"{LOAD} bigint, at timestamp, value bigint")


def replaces():
    return F.col(LOAD) % 3 == 0


@pytest.fixture(scope="module")
def data(spark):
    return loads_of(spark, [4, 1, 3, 2, 5])


def test_ledger(data):
    found = ledger_of(data, replaces(), time="at")
    ledger = found.snapshots.orderBy("snapshot_id").collect()
    assert [(r.snapshot_id, r.operation) for r in ledger] == [
        (0, "replace"), (1, "append"), (2, "append"), (3, "replace"), (4, "append"),
    ]
    assert sorted(map(tuple, found.intervals.collect()), key=str) == [
        (0, 0, 3), (1, 1, 3), (2, 2, 3), (3, 3, None), (4, 4, None),
    ]
    assert [(r.added_records, r.total_records) for r in ledger] == [
        (4, 4), (1, 5), (3, 8), (2, 2), (5, 7),
    ]
    assert ledger[4].committed_at == START + timedelta(days=4)


def test_reads_as_of(data):
    ledger = restored(ledger_of(data, replaces(), time="at"), 1, timedelta(hours=1))

    def loads(snapshot=None):
        return {r[LOAD] for r in read_as_of(data, ledger, snapshot).collect()}

    assert loads(0) == {0} and loads(2) == {0, 1, 2} and loads(4) == {3, 4}
    assert loads() == {0, 1}
    assert loads(99) == set()
    newest = history(ledger, 2).collect()
    assert [(r.operation, r.total_records) for r in newest] == [("restore", 5), ("append", 7)]


def test_restore_of_an_unknown_snapshot_changes_nothing(data):
    ledger = ledger_of(data, time="at")
    found = restored(ledger, 99, timedelta(days=1))
    assert found.snapshots.collect() == ledger.snapshots.collect()
    assert sorted(found.intervals.collect(), key=str) == sorted(
        ledger.intervals.collect(), key=str
    )


def test_expirable(data):
    ledger = ledger_of(data, replaces(), time="at")
    now = F.lit(START + timedelta(days=5))

    def old(days):
        found = expirable(ledger, now, timedelta(days=days)).collect()
        return {(r[LOAD], r.added_records) for r in found}

    # The newest snapshot shows loads 3 and 4, a young one more than those.
    assert old(0.5) == {(0, 4), (1, 1), (2, 3)}
    assert old(3.5) == set()
    assert old(2.5) == {(0, 4), (1, 1), (2, 3)}


@settings(
    max_examples=4,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=6), st.integers(0, 9))
def test_audit_equals_reading_every_snapshot(spark, sizes, seed):
    data = loads_of(spark, sizes)
    ledger = ledger_of(data, replaces(), time="at")
    back = random.Random(seed).randrange(len(sizes))
    ledger = restored(ledger, back, timedelta(days=1))
    negative = F.count_if(F.col("value") < 0)
    found = audit(ledger, sums_by_load([data], negative=negative, total=F.sum("value")))
    expected, before = {}, None
    for entry in ledger.snapshots.orderBy("snapshot_id").collect():
        rows = read_as_of(data, ledger, entry.snapshot_id).collect()
        values = [r.value for r in rows]
        change = None if before is None else len(values) - before
        before = len(values)
        expected[entry.snapshot_id] = (
            len(values), change, sum(v < 0 for v in values), sum(values),
        )
    assert {
        r.snapshot_id: (r.records, r.record_change, r.negative, r.total) for r in found.collect()
    } == expected


def test_audit_after_a_rename_does_not_guess(spark, data):
    """A snapshot with a load whose column is unknown has no answer, not 0."""
    old = data.where(f"{LOAD} < 3").withColumnRenamed("value", "amount")
    new = data.where(f"{LOAD} >= 3")
    ledger = ledger_of(data, F.col(LOAD) == 2, time="at")
    negative = F.count_if(F.col("value") < 0)
    found = audit(ledger, sums_by_load([old, new], negative=negative)).collect()
    assert {r.snapshot_id: r.negative for r in found} == {0: None, 1: None, 2: None, 3: None, 4: None}
    ledger = ledger_of(data, F.col(LOAD) == 3, time="at")
    found = audit(ledger, sums_by_load([old, new], negative=negative)).collect()
    assert {r.snapshot_id: r.negative for r in found} == {0: None, 1: None, 2: None, 3: 1, 4: 2}


def test_audit_after_a_change_of_type(spark, data):
    old = data.where(f"{LOAD} < 2")
    new = data.where(f"{LOAD} >= 2").withColumn("value", F.col("value").cast("decimal(12,2)"))
    negative = F.count_if(F.col("value") < 0)
    found = audit(ledger_of(data, time="at"), sums_by_load([old, new], negative=negative))
    assert {r.snapshot_id: r.negative for r in found.collect()} == {k: k + 1 for k in range(5)}


def test_an_error_in_an_aggregate_is_not_hidden(data):
    with pytest.raises(Exception, match="DATATYPE_MISMATCH|CAST_INVALID"):
        sums_by_load([data], bad=F.sum(F.col("value") + F.array(F.lit(1)))).collect()


def test_only_the_folders_of_a_snapshot_are_read(spark, data):
    folder = new_workspace(spark, "test-loads")
    data.write.partitionBy(LOAD).parquet(folder)
    found = read_as_of(spark.read.parquet(folder), ledger_of(data, time="at"), 1)
    assert found.count() == 5
    assert "LeftSemi" in plan_of(found)


def test_a_ledger_is_as_long_as_there_were_loads(spark):
    """Of 100,000 loads, of which each one is visible to the end."""
    n = 100_000
    data = spark.range(n).select(F.col("id").alias(LOAD), F.col("id").alias("value"))
    ledger = ledger_of(data)
    assert ledger.intervals.count() == ledger.snapshots.count() == n
    found = audit(ledger, sums_by_load([data], total=F.sum("value")))
    last = found.orderBy(F.desc("snapshot_id")).first()
    assert (last.records, last.total) == (n, n * (n - 1) // 2)
    assert read_as_of(data, ledger, n // 2).count() == n // 2 + 1


@settings(
    max_examples=4,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(st.integers(1, 4), min_size=2, max_size=6),
    st.lists(st.integers(0, 9), min_size=1, max_size=3),
)
def test_snapshots_after_several_restores(spark, sizes, targets):
    """Against sets of loads, kept plainly."""
    data = loads_of(spark, sizes)
    ledger = ledger_of(data, replaces(), time="at")
    shown = []
    for load in range(len(sizes)):
        shown.append({load} if load % 3 == 0 or not shown else shown[-1] | {load})
    for target in targets:
        target %= len(shown)
        ledger = restored(ledger, target, timedelta(days=1))
        shown.append(shown[target])
    snapshots = ledger.snapshots.orderBy("snapshot_id").collect()
    assert [r.total_records for r in snapshots] == [sum(sizes[k] for k in s) for s in shown]
    intervals = ledger.intervals.collect()
    for k, loads in enumerate(shown):
        found = [
            r[LOAD] for r in intervals
            if r.first_snapshot <= k and (r.end_snapshot is None or k < r.end_snapshot)
        ]
        assert sorted(found) == sorted(loads)
    assert {r[LOAD] for r in loads_seen(ledger).collect()} == shown[-1]


def test_changes_count_repeated_rows(spark):
    columns = f"{LOAD} bigint, k string, v int"
    before = [("same", 1), ("gone", 2), ("gone", 2), ("new value", 3), ("twice", 4)]
    after = [("same", 1), ("new value", 5), ("twice", 4), ("twice", 4), ("come", None)]
    rows = [(0, *r) for r in before] + [(1, *r) for r in after] + [(2, "more", 1)]
    data = spark.createDataFrame(rows, columns)
    ledger = ledger_of(data, replaces=F.col(LOAD) == 1)
    found = changes(data, ledger, 0, 1, ["k"]).collect()
    assert {tuple(r) for r in found} == {
        ("gone", 2, "removed", "removed", 2),
        ("new value", 3, "changed", "removed", 1),
        ("new value", 5, "changed", "added", 1),
        ("twice", 4, "added", "added", 1),
        ("come", None, "added", "added", 1),
    }
    assert {tuple(r) for r in changes(data, ledger, 1, 2, ["k"]).collect()} == {
        ("more", 1, "added", "added", 1)
    }
    back = changes(data, ledger, 1, 0, ["k"])
    assert back.count() == 5 and changes(data, ledger, 2, 2, ["k"]).isEmpty()


def test_changes_read_only_loads_of_one_side(spark, data):
    plan = plan_of(changes(data, ledger_of(data), 1, 3, ["value"]))
    assert plan.count("Generate") == 0 and "CartesianProduct" not in plan


def at(minutes):
    return START + timedelta(minutes=minutes)


@pytest.mark.parametrize("span", ["hour", "day", "minute"])
@pytest.mark.parametrize("keyed", [False, True])
def test_as_of_join(spark, span, keyed):
    pick = random.Random(5)
    states = [(pick.choice(["a", "b", None]), at(pick.randrange(5000)), n) for n in range(60)]
    states += [("a", None, 99), (states[0][0], states[0][1], 77)]
    rows = [(pick.choice(["a", "b", "c", None]), at(pick.randrange(-50, 6000)), n) for n in range(300)]
    rows += [("a", None, 500), rows[0], rows[0]]
    keys = ["k"] if keyed else []
    right = spark.createDataFrame(states, "k string, since timestamp, value int")
    left = spark.createDataFrame(rows, "k string, at timestamp, id int")
    if not keyed:
        right = right.drop("k")
    found = join_as_of(left, "at", right, "since", keys, span).collect()
    wanted = []
    for k, time, number in rows:
        own = [
            (since, value) for other, since, value in states
            if time and since and since <= time and (not keyed or other == k)
        ]
        wanted.append((k, time, number, *max(own, default=(None, None))))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
