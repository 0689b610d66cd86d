from __future__ import annotations

from datetime import timedelta
from pathlib import Path

import pyarrow.parquet as parquet
import pytest
from plans import plan_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from assayer.constants import LAYERS, SILVER_SCHEMA
from assayer.operators.gold import clean_revenue, revenue_per_hour
from assayer.plans import fixture
from assayer.plans.layers import Layers, counted_bronze, counted_silver, main
from assayer.session import new_workspace
from assayer.sources.events import CORRUPT, ORIGIN, read_json_events, with_origins
from assayer.sources.layers import APPEND, REPLACE, save_table
from assayer.sources.snapshots import LOAD, Ledger, ledger_of, read_as_of
from assayer.streaming.gold import RevenueStream

SF = "/root/testdata/sf0.001"


@pytest.fixture
def layers(spark):
    return fixture.new_layers(spark, "test")


def test_job_from_json_to_gold(spark, layers):
    layers.build(read_json_events(spark, fixture.json_landing(spark, SF)))
    summary = {row.layer: row for row in layers.summary().collect()}
    drops = {row.reason: row.rows for row in layers.drops().collect()}
    assert summary["bronze"].records == 1000 == sum(drops.values())
    assert summary["silver"].records == drops["ok"] > 0
    assert summary["silver"].dropped == 1000 - drops["ok"]
    assert CORRUPT in layers.read("bronze").columns
    assert layers.read("silver").columns == [*SILVER_SCHEMA.names, *ORIGIN, LOAD]
    revenue = clean_revenue(layers.read("gold")).first()[0]
    assert revenue == summary["gold"].total_revenue > 0


def test_written_silver_names_its_origin(spark, layers):
    """Every row leads to one Bronze row with the same id."""
    layers.build(fixture.bronze_events(spark, SF))
    silver, bronze = layers.read("silver"), with_origins(layers.read("bronze"))
    both = silver.alias("s").join(bronze.alias("b"), list(ORIGIN))
    assert both.count() == silver.count() > 0
    assert both.where("s.event_id != b.event_id").isEmpty()


def test_files_let_a_time_filter_skip(spark, layers):
    """Written times have min/max in the footers, and the filter reaches them."""
    layers.build(fixture.bronze_events(spark, SF))
    silver = layers.read("silver")
    footer = parquet.ParquetFile(silver.inputFiles()[0].removeprefix("file:")).metadata
    times = footer.row_group(0).column(silver.columns.index("event_ts"))
    assert times.path_in_schema == "event_ts" and times.statistics.has_min_max
    plan = plan_of(silver.where("event_ts >= timestamp'2024-01-20'"))
    assert "GreaterThanOrEqual(event_ts" in plan


def test_tables_under_a_name(spark, layers):
    """Replace begins anew, append adds; columns are matched by name."""
    events = fixture.bronze_events(spark, SF)
    few = events.where("category = 'k1'")
    layers.build(events)
    layers.build(few)
    assert spark.table(layers.name("bronze")).count() == few.count()
    turned = events.select(*reversed(events.columns))
    layers.append(turned, 1)
    sizes = {r[LOAD]: r["count"] for r in layers.read("bronze").groupBy(LOAD).count().collect()}
    assert sizes == {0: few.count(), 1: events.count()}
    gold = layers.read("gold")
    keys = gold.select("hour_bucket", "category")
    assert gold.count() > keys.distinct().count()
    assert gold.count() == gold.select("hour_bucket", "category", LOAD).distinct().count()


def failing(events):
    """Events of which the last partition can't be computed."""
    lost = F.raise_error(F.lit("lost")).cast("boolean")
    return events.where(F.when(F.col("category") == "k3", lost).otherwise(True))


def test_a_replace_that_fails_leaves_the_old_rows(spark, layers):
    """In a build of all layers and in each table of its own."""
    events = fixture.bronze_events(spark, SF)
    layers.build(events)
    before = {layer: spark.table(layers.name(layer)).collect() for layer in LAYERS}
    with pytest.raises(Exception, match="lost"):
        layers.build(failing(events))
    broken_silver = events.withColumn("user_agent", F.lit(1))
    broken_silver = broken_silver.drop("email")
    with pytest.raises(Exception, match="email"):
        layers.build(broken_silver)  # Bronze can be written, Silver can't
    with pytest.raises(Exception, match="lost"):
        save_table(failing(layers.read("silver")), "silver", layers.name("silver"), REPLACE)
    for layer in LAYERS:
        assert spark.table(layers.name(layer)).collect() == before[layer] != []


def test_a_reader_keeps_its_rows_during_a_replace(spark, layers):
    events = fixture.bronze_events(spark, SF)
    layers.build(events)
    reading, shown = layers.read("bronze"), spark.table(layers.name("bronze"))
    layers.build(events.limit(3).withColumn("more", F.lit(1)))
    assert reading.count() == shown.count() == 1000
    assert layers.read("bronze").count() == 3
    # The schema has changed with the rows.
    assert "more" in spark.table(layers.name("bronze")).columns
    layers.build(events.limit(2))
    base = layers.name("bronze").split(".")[0]
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {base}").collect()]
    assert len([t for t in tables if t.startswith("events__")]) == 2, "the newest and one before"


def test_an_append_may_be_repeated(spark, layers):
    """What a failed attempt has left of a load does not count twice."""
    events = fixture.bronze_events(spark, SF)
    layers.build(events)
    layers.append(events.limit(10), 1)
    left = events.limit(10).withColumn(LOAD, F.lit(2).cast("bigint"))
    save_table(left, "bronze", layers.name("bronze"), APPEND, split_by=LOAD)
    for _ in range(2):
        layers.append(events.limit(20), 2)
    for frame in (layers.read("bronze"), spark.table(layers.name("bronze"))):
        sizes = {r[LOAD]: r["count"] for r in frame.groupBy(LOAD).count().collect()}
        assert sizes == {0: 1000, 1: 10, 2: 20}


def test_retention_drops_loads_and_keeps_snapshots(spark, layers):
    events = fixture.bronze_events(spark, SF)
    layers.build(events)
    for load in range(1, 5):
        layers.append(events, load)
    bronze = layers.read("bronze")
    ledger = ledger_of(bronze, F.col(LOAD) == 2, time=(F.lit("2024-01-01").cast("timestamp")
        + F.make_dt_interval(days=F.col(LOAD).cast("int"))))
    old = [Path(f.removeprefix("file:")) for f in bronze.where(f"{LOAD} < 2").inputFiles()]
    kept = {k: read_as_of(bronze, ledger, k).count() for k in (2, 3, 4)}
    now = F.lit("2024-01-06").cast("timestamp")
    snapshots, intervals = ledger.snapshots.collect(), ledger.intervals.collect()
    gone = layers.expire(ledger, now, timedelta(days=3.5))
    assert gone == [0, 1]
    fixed = Ledger(spark.createDataFrame(snapshots), spark.createDataFrame(
        intervals, "load_id bigint, first_snapshot bigint, end_snapshot bigint"))
    for layer in LAYERS:
        loads = spark.table(layers.name(layer)).select(LOAD).distinct().collect()
        assert {r[LOAD] for r in loads} == {2, 3, 4}
    after = layers.read("bronze")
    assert {k: read_as_of(after, fixed, k).count() for k in (2, 3, 4)} == kept
    assert not any(f.exists() for f in old if not f.is_symlink())
    assert layers.expire(fixed, now, timedelta(days=30)) == []


def test_codecs_of_the_layers(spark, layers):
    layers.build(fixture.bronze_events(spark, SF))
    found = {}
    for layer in LAYERS:
        path = layers.read(layer).inputFiles()[0].removeprefix("file:")
        found[layer] = parquet.ParquetFile(path).metadata.row_group(0).column(0).compression
    assert found == {"bronze": "SNAPPY", "silver": "ZSTD", "gold": "ZSTD"}


def test_streaming_job_takes_what_is_new(spark, capsys):
    root = new_workspace(spark, "test-stream-main")
    landing = f"{root}/in"
    events = fixture.bronze_events(spark, SF)
    early = F.col("event_ts") < "2024-01-15"
    for part in (events.where(early), events.where(~early)):
        part.write.mode("append").json(landing)
        main(["--events", landing, "--root", root, "--stream"])
    assert "hour_bucket" in capsys.readouterr().out
    gold = RevenueStream(f"{root}/stream/revenue").read_gold(spark)
    wanted = revenue_per_hour(fixture.silver_events(spark, SF))
    assert gold.exceptAll(wanted).isEmpty() and gold.count() == wanted.count() > 0
    silver = spark.read.parquet(f"{root}/stream/silver")
    assert silver.count() == fixture.silver_events(spark, SF).count()


def test_command_line(spark, capsys):
    root = new_workspace(spark, "test-main")
    landing = fixture.json_landing(spark, SF)
    main(["--events", landing, "--root", root])
    main(["--events", landing, "--root", root, "--load", "1", "--append"])
    printed = capsys.readouterr().out
    assert "missing_required" in printed
    layers = Layers(spark, root)
    assert layers.read("gold").select(F.countDistinct(LOAD)).first()[0] == 2
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_rows_are_judged_once_and_not_sorted_by_load(spark, bronze):
    events = bronze({}, {"user_id": None})
    counted = counted_bronze(events, Observation())
    lines = counted._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # The rule is in a column of its own, not in each of the counts.
    assert not any("CASE WHEN" in line for line in lines if "CollectMetrics" in line)
    assert counted.columns == events.columns
    folder = new_workspace(spark, "test-counted")
    events.withColumn(LOAD, F.lit(3).cast("bigint")).write.partitionBy(LOAD).parquet(folder)
    raw = with_origins(spark.read.parquet(folder)).where(F.col(LOAD) == 3)
    silver = counted_silver(raw, F.lit(3).cast("bigint"), Observation())
    assert f"3 AS {LOAD}" in silver._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert [r[LOAD] for r in silver.collect()] == [3]
