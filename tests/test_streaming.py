from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayer.constants import BRONZE_SCHEMA, SILVER_SCHEMA
from assayer.operators.accounting import drop_accounting
from assayer.operators.gold import MEASURES, revenue_per_hour
from assayer.operators.silver import to_silver
from assayer.plans import fixture
from assayer.plans.registry import QUERIES
from assayer.session import OPEN_FILES, new_workspace, with_settings
from assayer.sources.events import CORRUPT, read_json_events, stream_json_events
from assayer.streaming.gold import RevenueStream, start_windowed_revenue
from assayer.streaming.silver import QuarantinedSilver, start_silver

COLUMNS = ["cast(hour_bucket as timestamp_ntz)", "category", *MEASURES]
SMALL = "/root/testdata/sf0.001"


def purchase(number, time, amount=1.0, user="u1", category="Books"):
    return {
        "event_id": f"e{number}",
        "event_ts": f"2024-01-01T{time}",
        "amount": amount,
        "user_id": user,
        "category": category,
    }


@pytest.fixture
def work(spark):
    return new_workspace(spark, "test-stream")


def land(bronze, work, *changes):
    bronze(*changes).coalesce(1).write.mode("append").json(f"{work}/in")


def rows(df):
    return {tuple(row) for row in df.selectExpr(*COLUMNS).collect()}


def hour(value):
    return datetime(2024, 1, 1, value)


def test_json_lines_are_kept_as_they_are(spark, work):
    good = '{"event_id": "e1", "amount": 1.5, "quantity": 3, "unknown": 1}'
    lines = [good, "{broken", '{"event_id": "e2", "amount": "text"}']
    spark.createDataFrame([(line,) for line in lines], "v string").coalesce(1).write.text(
        f"{work}/in"
    )
    events = read_json_events(spark, f"{work}/in")
    assert events.columns == [*BRONZE_SCHEMA.names, CORRUPT]
    found = {row[CORRUPT]: (row.event_id, row.amount) for row in events.collect()}
    assert found == {
        None: ("e1", 1.5),
        "{broken": (None, None),
        lines[2]: ("e2", None),
    }


def test_silver_stream_continues_where_it_stopped(spark, bronze, work):
    def run():
        source = stream_json_events(spark, f"{work}/in")
        start_silver(source, f"{work}/silver", f"{work}/checkpoint").awaitTermination()
        written = spark.read.parquet(f"{work}/silver").collect()
        return sorted(row.event_id for row in written)

    land(bronze, work, purchase(1, "00:10:00"), {"event_id": "x", "user_id": None})
    assert run() == ["e1"]
    assert run() == ["e1"]
    land(bronze, work, purchase(2, "00:20:00"))
    assert run() == ["e1", "e2"]


@pytest.mark.parametrize(
    ("files", "slots", "part"), [(1, 3, "day"), (2, 1, "month"), (4, 8, "hour")]
)
def test_gold_stream_equals_batch(spark, work, files, slots, part):
    landing = fixture.json_landing(spark, SMALL)
    source = stream_json_events(spark, landing, files_per_batch=files)
    stream = RevenueStream(work, slots=slots, part=part, keep=fixture.FEED_SPAN)
    query = stream.start(to_silver(source), f"{work}/checkpoint")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4 // files
    assert stream.read_late(spark).isEmpty()
    batch = revenue_per_hour(fixture.silver_events(spark, SMALL))
    assert rows(stream.read_gold(spark)) == rows(batch) != set()


def test_late_event_corrects_its_hour_only(spark, bronze, work):
    stream = RevenueStream(work)

    def run():
        source = to_silver(stream_json_events(spark, f"{work}/in"))
        stream.start(source, f"{work}/checkpoint").awaitTermination()
        return rows(stream.read_gold(spark))

    land(
        bronze,
        work,
        purchase(1, "00:10:00", 2.0, "u1"),
        purchase(2, "05:10:00", 4.0, "u1"),
    )
    two, four, five = Decimal("2.00"), Decimal("4.00"), Decimal("5.00")
    later = (hour(5), "Books", four, 1, four, four, four, 1)
    assert run() == {(hour(0), "Books", two, 1, two, two, two, 1), later}
    # Hours later: one known and one new buyer for the first hour.
    land(
        bronze,
        work,
        purchase(3, "00:50:00", 5.0, "u1"),
        purchase(4, "00:55:00", 5.0, "u2"),
    )
    total = (hour(0), "Books", Decimal("12.00"), 3, four, five, two, 2)
    assert run() == {total, later}


def run_gold(spark, work, stream):
    source = to_silver(stream_json_events(spark, f"{work}/in", files_per_batch=1))
    stream.start(source, f"{work}/checkpoint").awaitTermination()
    return rows(stream.read_gold(spark))


def test_many_buyers_of_an_hour_are_counted_once(spark, bronze, work, monkeypatch):
    """Beyond the first few, buyers are in the map; both places are looked at."""
    monkeypatch.setattr("assayer.streaming.gold.FIRST_BUYERS", 2)
    stream = RevenueStream(work, slots=2)
    changes = []
    for batch in range(3):
        own = [
            purchase(100 * batch + k, f"0{k % 2}:{10 + batch}:00", k + 1.0, f"u{k * batch % 17}")
            for k in range(40)
        ]
        changes += own + [purchase(100 * batch + 99, "00:59:00", 2.5, "u1", None)]
        land(bronze, work, *own, changes[-1])
    batch = revenue_per_hour(to_silver(bronze(*changes)))
    assert run_gold(spark, work, stream) == rows(batch)


def test_late_events_of_a_closed_day_are_told_apart(spark, bronze, work):
    stream = RevenueStream(work, keep=timedelta(days=1))
    day = "2024-01-{:02d}T{}"

    def at(number, day_of_month, amount, user="u1"):
        change = purchase(number, "00:00:00", amount, user)
        return change | {"event_ts": day.format(day_of_month, "05:10:00")}

    land(bronze, work, at(1, 1, 2.0), at(2, 2, 3.0))
    first = run_gold(spark, work, stream)
    land(bronze, work, at(3, 1, 5.0, "u2"))  # a day behind: still open
    second = run_gold(spark, work, stream)
    land(bronze, work, at(4, 20, 7.0))  # closes both days
    third = run_gold(spark, work, stream)
    assert stream.read_late(spark).isEmpty()
    land(bronze, work, at(5, 1, 11.0, "u3"), at(6, 1, 1.0, "u3"), at(7, 20, 1.0))
    land(bronze, work, at(8, 2, 13.0, "u1"))
    last = run_gold(spark, work, stream)
    assert len(first) == len(second) == 2 and first != second
    assert second < third
    assert {r for r in last if r[0].day < 20} == {r for r in second}
    late = stream.read_late(spark).orderBy("amount_sum").collect()
    found = [(r["amount_sum"], r["row_count"], r["buyer_count"]) for r in late]
    assert found == [(Decimal("12.00"), 2, 1), (Decimal("13.00"), 1, 1)]
    # Nothing is lost: what Gold shows and what came late are all that came.
    total = sum(r[2] for r in last) + sum(r["amount_sum"] for r in late)
    assert total == Decimal("43.00")
    shown = spark.read.format("statestore").option("stateVarName", "hours")
    state = shown.load(f"{work}/checkpoint")
    assert state.count() == 1, "the state of closed days is gone"


def test_gold_stream_recovers_from_a_failing_batch(spark, bronze, work):
    """A micro-batch that fails in its tasks is repeated and counts once."""
    land(bronze, work, purchase(1, "00:10:00", 2.0), purchase(2, "01:10:00", 4.0))
    stream = RevenueStream(work)
    before = run_gold(spark, work, stream)
    land(bronze, work, purchase(3, "00:20:00", 6.0, "u2"))
    source = to_silver(stream_json_events(spark, f"{work}/in"))
    lost = F.raise_error(F.lit("lost")).cast("boolean")
    failing = source.where(F.when(F.col("user_id") == "u2", lost).otherwise(True))
    with pytest.raises(Exception, match="lost"):
        stream.start(failing, f"{work}/checkpoint").awaitTermination()
    # Readers still see the batches before, whole.
    assert rows(stream.read_gold(spark)) == before
    land(bronze, work, purchase(4, "00:30:00", 1.0, "u2"))
    everything = to_silver(read_json_events(spark, f"{work}/in"))
    assert run_gold(spark, work, stream) == rows(revenue_per_hour(everything))


def test_gold_stream_reads_only_needed_fields(spark, work):
    """The masks are not computed for a stream that does not show them."""
    source = to_silver(stream_json_events(spark, fixture.json_landing(spark, SMALL)))
    query = RevenueStream(work).start(source, f"{work}/checkpoint")
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "sha2" not in plan and "TransformWithState" in plan


def test_a_batch_writes_few_files(spark, work):
    """As many as there are tasks, however many hours it touches."""
    source = stream_json_events(spark, fixture.json_landing(spark, SMALL))
    stream = RevenueStream(work, keep=fixture.FEED_SPAN)
    stream.start(to_silver(source), f"{work}/checkpoint").awaitTermination()
    log = stream.read_log(spark)
    assert log.select("hour_bucket").distinct().count() > 100
    assert len(log.inputFiles()) <= 2 * 8  # of the events, and of closing hours


def test_silver_stream_fails_on_a_null_that_the_contract_forbids(spark, bronze, work, monkeypatch):
    """The rows are conformed: what the filters let through is checked again."""
    land(bronze, work, purchase(1, "00:10:00"))
    source = stream_json_events(spark, f"{work}/in")
    monkeypatch.setattr(
        "assayer.operators.silver.to_silver",
        lambda bronze, contract, carry=(): to_silver(bronze, contract, carry).withColumn(
            "user_id", F.nullif("user_id", F.lit("u1"))
        ),
    )
    query = start_silver(source, f"{work}/silver", f"{work}/checkpoint")
    with pytest.raises(Exception, match="null in non-null column user_id"):
        query.awaitTermination()


def test_batch_without_purchases(spark, bronze, work):
    stream = RevenueStream(work)
    land(bronze, work, purchase(1, "00:10:00"))
    run_gold(spark, work, stream)
    land(bronze, work, {"event_type": "view"})
    assert len(run_gold(spark, work, stream)) == 1


def test_kept_and_quarantined_rows_are_what_has_landed(spark, bronze, work):
    silver = QuarantinedSilver(f"{work}/silver")

    def run(rows=lambda source: source):
        source = rows(stream_json_events(spark, f"{work}/in", files_per_batch=1))
        silver.start(source, f"{work}/checkpoint").awaitTermination()

    def seen():
        kept = [r.event_id for r in silver.read_silver(spark).collect()]
        aside = [(r.reason, r.event_id) for r in silver.read_quarantine(spark).collect()]
        return sorted(kept), sorted(aside, key=str)

    land(bronze, work, purchase(1, "00:10:00"), {"event_id": "x", "user_id": None})
    run()
    assert seen() == (["e1"], [("missing_required", "x")])
    land(bronze, work, purchase(2, "00:20:00"), purchase(3, "00:20:00", -1.0))
    lost = F.raise_error(F.lit("lost")).cast("boolean")
    with pytest.raises(Exception, match="lost"):
        # Rejected rows can be written, an accepted one can't.
        run(lambda s: s.where(F.when(F.col("event_id") == "e2", lost).otherwise(True)))
    assert seen() == (["e1"], [("missing_required", "x")])
    land(bronze, work, {"event_id": "t", "event_ts": "soon", "amount": 5.0})
    spark.createDataFrame([("{broken",)], "v string").write.mode("append").text(f"{work}/in")
    for _ in range(2):
        run()
    everything = read_json_events(spark, f"{work}/in")
    kept, aside = seen()
    assert kept == ["e1", "e2"]
    assert aside == [
        ("bad_event_ts", "t"), ("missing_required", "x"), ("missing_required", None),
        ("non_positive_amount", "e3"),
    ]
    assert len(kept) + len(aside) == everything.count()
    raw = silver.read_quarantine(spark)
    assert raw.columns == ["reason", "origin_file", *BRONZE_SCHEMA.names, CORRUPT]
    broken = raw.where(F.col(CORRUPT).isNotNull()).collect()
    assert [r[CORRUPT] for r in broken] == ["{broken"]
    assert all(r.origin_file.startswith("file:") for r in raw.collect())
    assert silver.read_silver(spark).columns == SILVER_SCHEMA.names
    reasons = {r.reason: r.rows for r in drop_accounting(everything).collect() if r.rows}
    assert reasons == {"ok": 2, "missing_required": 2, "bad_event_ts": 1, "non_positive_amount": 1}


def test_quarantine_reads_the_stream_once(spark, work):
    source = stream_json_events(spark, fixture.json_landing(spark, SMALL))
    query = QuarantinedSilver(f"{work}/silver").start(source, f"{work}/checkpoint")
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert plan.count("FileScan json") == 1 and "Exchange" not in plan


def test_windows_are_emitted_once_closed(spark, bronze, work):
    def run():
        source = to_silver(stream_json_events(spark, f"{work}/in"))
        query = start_windowed_revenue(source, f"{work}/gold", f"{work}/checkpoint")
        query.awaitTermination()
        return rows(spark.read.parquet(f"{work}/gold"))

    one, three = Decimal("1.00"), Decimal("3.00")
    land(
        bronze,
        work,
        purchase(1, "00:10:00", 1.0, "u1"),
        purchase(2, "00:20:00", 3.0, "u1"),
        purchase(3, "00:30:00", 3.0, "u2"),
        purchase(4, "02:30:00", 9.0, "u2"),
    )
    average = Decimal("2.33")
    closed = (hour(0), "Books", Decimal("7.00"), 3, average, three, one, 2)
    assert run() == {closed}
    # Too late for hour 0, in time for hour 2, and it closes hour 2.
    land(bronze, work, purchase(5, "00:40:00"), purchase(6, "02:40:00", 3.0, "u3"))
    land(bronze, work, purchase(7, "09:00:00"))
    result = run()
    second = (hour(2), "Books", Decimal("12.00"), 2, Decimal("6.00"))
    assert result == {closed, (*second, Decimal("9.00"), three, 2)}


def test_landing_is_the_whole_feed(spark):
    landing = fixture.json_landing(spark, SMALL)
    landed = read_json_events(spark, landing).select(*BRONZE_SCHEMA.names)
    feed = fixture.bronze_events(spark, SMALL)
    assert landed.count() == feed.count() == 1000
    assert landed.exceptAll(feed).count() == 0
    hours = landed.select(F.col("event_ts").substr(1, 13)).distinct().count()
    assert hours > 24


def test_landings_are_compressed_bounded_and_whole(spark, monkeypatch, tmp_path):
    """Files of the mixed feed have few rows; no task lands a few events only."""
    monkeypatch.setattr(fixture, "LANDED_ROWS", 400)
    # Not the cached folder of the session.
    landing = fixture._mixed_landing.__wrapped__(spark, SMALL, ())
    landed = read_json_events(spark, landing)
    files = landed.groupBy(F.col("_metadata.file_path")).count().collect()
    assert all(r[0].endswith(".json.lz4") and r[1] <= 400 for r in files) and len(files) > 5
    feed = fixture.mixed_feed(spark, SMALL)
    landed = landed.select(*BRONZE_SCHEMA.names)
    assert landed.exceptAll(feed).isEmpty() and feed.exceptAll(landed).isEmpty()
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 * 2**20))
    try:
        assert fixture.table(spark, str(tmp_path), "events").rdd.getNumPartitions() == 5
        landed = read_json_events(spark, fixture.json_landing(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(landed.inputFiles()) == 4 and landed.count() == 1000


def test_state_has_no_more_partitions_than_cores_can_use(spark, bronze, work):
    land(bronze, work, purchase(1, "00:10:00"))
    source = to_silver(stream_json_events(spark, f"{work}/in"))
    with with_settings(spark, {"spark.sql.shuffle.partitions": "64"}):
        query = RevenueStream(work).start(source, f"{work}/checkpoint")
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    state = query.lastProgress["stateOperators"][0]
    assert state["numShufflePartitions"] == 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_rows_are_not_sorted_by_outcome(spark, work, monkeypatch):
    """While a query's stream runs, tasks may hold both files open."""
    seen = []
    start = QuarantinedSilver.start

    def noted(silver, *given):
        seen.append(spark.conf.get(OPEN_FILES))
        return start(silver, *given)

    monkeypatch.setattr(QuarantinedSilver, "start", noted)
    before = spark.conf.get(OPEN_FILES)
    assert not QUERIES["stream_quarantine"](spark, SMALL).isEmpty()
    assert int(seen[0]) >= 2 and spark.conf.get(OPEN_FILES) == before
