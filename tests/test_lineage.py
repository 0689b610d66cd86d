from __future__ import annotations

import random
from collections import Counter

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from assayer.operators.gold import purchases, revenue_per_hour, revenue_rollup
from assayer.operators.lineage import (
    bronze_rows_behind,
    names_of,
    trace_bronze_to_gold,
    trace_event,
    trace_gold_to_silver,
    trace_silver_to_bronze,
)
from assayer.operators.silver import to_silver
from assayer.plans import fixture
from assayer.plans.layers import REVENUE_PER_LOAD
from assayer.session import new_workspace
from assayer.sources.events import ORIGIN, read_parquet_events, with_origins


def events(count, seed=3):
    """Changes for good events: a hot hour, repeated ids, some defects."""
    rng = random.Random(seed)
    for i in range(count):
        hot = rng.random() < 0.34
        hour = 7 if hot else rng.randrange(24)
        minute = rng.randrange(60)
        yield {
            "event_id": "copy" if rng.random() < 0.34 else f"e{i}",
            "user_id": None if rng.random() < 0.05 else f"u{rng.randrange(9)}",
            "session_id": str(i),
            "event_type": rng.choice(["purchase", "view", "signup"]),
            "category": "Books" if hot else rng.choice(["Sports", None]),
            "amount": rng.randrange(-100, 10**5) / 100,
            "event_ts": f"2024-01-01T{hour:02}:{minute:02}:00",
        }


@pytest.fixture(scope="module")
def layers(spark, bronze):
    raw = bronze(*events(600))
    silver = to_silver(raw)
    folder = new_workspace(spark, "test-lineage")
    revenue_per_hour(silver).write.parquet(folder)
    return raw, silver, spark.read.parquet(folder)


def trace_rows(df):
    times = df.withColumn("hour_bucket", F.col("hour_bucket").cast("timestamp_ntz"))
    return Counter(tuple(row) for row in times.collect())


def test_gold_to_silver_equals_brute_force(layers):
    _, silver, gold = layers
    traced = trace_gold_to_silver(gold, silver)
    totals = {(r.hour_bucket, r.category): r for r in gold.collect()}
    expected = Counter()
    for row in silver.where("event_type = 'purchase'").collect():
        hour = row.event_ts.replace(minute=0, second=0)
        group = totals[hour, row.category]
        expected[
            (hour, row.category, group.total_revenue, group.transaction_count)
            + (row.event_id, row.amount)
        ] += 1
    assert trace_rows(traced) == expected
    assert sum(expected.values()) == silver.where("event_type = 'purchase'").count()


def test_one_join_that_can_split_a_hot_key(spark, layers):
    _, silver, gold = layers
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(trace_gold_to_silver(gold, silver))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("SortMergeJoin Inner") == 1 and "Broadcast" not in plan


def test_a_key_that_gold_has_twice_fails(layers):
    _, silver, gold = layers
    twice = gold.unionAll(gold.where("category = 'Books'"))
    with pytest.raises(Exception, match="Gold has a key more than once"):
        trace_gold_to_silver(twice, silver).collect()


def test_loads_of_one_hour_are_told_apart(spark, bronze):
    """An event is behind the Gold row of its own load only."""
    raw = bronze(*[{**c, "event_type": "purchase", "amount": 5.0} for c in events(200)])
    silver = to_silver(raw).withColumn("load_id", F.length("session_id").cast("bigint"))
    gold = revenue_rollup(purchases(silver), REVENUE_PER_LOAD)
    traced = trace_gold_to_silver(gold, silver, REVENUE_PER_LOAD)
    assert traced.count() == silver.count()
    per_row = traced.groupBy("hour_bucket", "category", "load_id").agg(
        F.count("*").alias("n"), F.any_value("transaction_count").alias("t")
    )
    assert per_row.where("n != t").isEmpty()
    assert gold.count() > revenue_per_hour(silver).count()


def test_trace_of_selected_gold_rows(layers):
    _, silver, gold = layers
    one = gold.where("category = 'Books'")
    traced = trace_gold_to_silver(one, silver)
    assert traced.count() == one.first().transaction_count > 0


def test_silver_to_bronze_reports_fan_out(layers):
    raw, silver, _ = layers
    result = {
        row.event_id: (row.silver_rows, row.bronze_rows)
        for row in trace_silver_to_bronze(silver, raw, ["event_id"]).collect()
    }
    in_silver = Counter(row.event_id for row in silver.collect())
    in_bronze = Counter(row.event_id for row in raw.collect())
    assert result == {key: (n, in_bronze[key]) for key, n in in_silver.items()}
    assert result["copy"][1] > 100


def test_silver_to_bronze_reports_orphans(layers):
    raw, silver, _ = layers
    without = raw.where("event_id <> 'copy'")
    result = trace_silver_to_bronze(silver, without, ["event_id"])
    assert [r.event_id for r in result.where("bronze_rows = 0").collect()] == ["copy"]


def test_silver_to_bronze_has_no_join(layers):
    raw, silver, _ = layers
    plan = plan_of(trace_silver_to_bronze(silver, raw, ["event_id"]))
    assert "Join" not in plan
    assert "partial_sum" in plan


def test_bronze_rows_behind_a_selection(layers):
    raw, silver, _ = layers
    chosen = silver.where("category = 'Books'")
    ids = {row.event_id for row in chosen.collect()}
    expected = sorted(r.session_id for r in raw.collect() if r.event_id in ids)
    found = bronze_rows_behind(chosen, raw, ["event_id"])
    assert found.columns == raw.columns
    assert sorted(row.session_id for row in found.collect()) == expected


def test_selection_of_a_hot_id_can_be_split(spark, layers):
    """AQE splits a skewed join only if both sides come straight from a shuffle."""
    raw, silver, _ = layers
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan_of(bronze_rows_behind(silver, raw, ["event_id"])).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin LeftSemi" in line)
    below = [line for line in lines[join:] if "Sort (" in line or "Exchange (" in line]
    assert ["Sort" in line for line in below[:4]] == [True, False, True, False]


def test_origin_columns_name_the_exact_raw_row(spark, bronze):
    folder = new_workspace(spark, "test-origin")
    bronze(*events(100)).repartition(3).write.parquet(folder)
    raw = read_parquet_events(spark, folder, with_origin=True)
    silver = to_silver(raw, carry=ORIGIN)
    # Ids repeat, origins do not.
    assert silver.select("event_id").distinct().count() < silver.count()
    assert silver.select(*ORIGIN).distinct().count() == silver.count()
    back = bronze_rows_behind(silver, raw)
    assert sorted(r.session_id for r in back.collect()) == sorted(
        r.session_id for r in silver.collect()
    )
    counted = trace_silver_to_bronze(silver, raw)
    assert counted.where("silver_rows != 1 or bronze_rows != 1").isEmpty()


def test_a_rejected_row_with_the_id_of_an_accepted_one(spark, bronze):
    folder = new_workspace(spark, "test-origin")
    bronze({"event_id": "x", "amount": -5.0}, {"event_id": "x", "amount": 5.0}).write.parquet(folder)
    raw = read_parquet_events(spark, folder, with_origin=True)
    behind = bronze_rows_behind(to_silver(raw, carry=ORIGIN), raw)
    assert [r.amount for r in behind.collect()] == [5.0]


def test_forward_trace_of_a_file_and_of_a_row(spark):
    """Against a join of all rows, kept plainly."""
    layers = fixture.new_layers(spark, "forward")
    events = fixture.bronze_events(spark, "/root/testdata/sf0.001")
    layers.build(events.repartition(4, "event_id"))
    bronze, silver, gold = (with_origins(layers.read("bronze")), *map(layers.read, ("silver", "gold")))
    files = sorted(r[0] for r in bronze.select(ORIGIN[0]).distinct().collect())
    sold = [r for r in silver.collect() if r.event_type == "purchase"]
    for keys, wanted in (([ORIGIN[0]], bronze.where(F.col(ORIGIN[0]) == files[0])),
                         (ORIGIN, bronze.where(F.col(ORIGIN[0]) == files[1]).limit(30))):
        names = {tuple(r) for r in wanted.select(*keys).collect()}
        expected: dict = {}
        for r in sold:
            if tuple(r[k] for k in keys) in names:
                group = (r.event_ts.replace(minute=0, second=0, microsecond=0), r.category)
                expected[group] = expected.get(group, 0) + 1
        found = trace_bronze_to_gold(wanted, silver, gold, REVENUE_PER_LOAD, keys).collect()
        assert {(r.hour_bucket, r.category): r.bronze_rows for r in found} == expected != {}


def test_a_point_trace_skips_row_groups(spark):
    """By the Bloom filters of written Silver: ids are spread over all files, so that
    neither their least and largest values nor a dictionary tells them apart."""
    layers = fixture.new_layers(spark, "bloom")
    events = fixture.bronze_events(spark, "/root/testdata/sf0.01").where("event_type = 'view'")
    long_ids = F.concat(F.sha2("event_id", 512), F.sha2(F.concat("event_id", F.lit("x")), 512))
    events = events.withColumn("event_id", long_ids)
    many = events.crossJoin(spark.range(40).select(F.col("id").alias("copy")))
    many = many.withColumn("event_id", F.concat("event_id", F.col("copy").cast("string")))
    layers.build(many.drop("copy").repartition(6, "event_id"))
    silver = layers.read("silver")
    some = silver.select("event_id").first().event_id

    def rows_read(frame):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        metrics = [leaves.apply(i).metrics().get("numOutputRows") for i in range(leaves.size())]
        return sum(m.get().value() for m in metrics)

    found = trace_event(silver, some)
    assert rows_read(found.select("event_id")) < silver.count() / 3
    assert found.count() == 1
    spark.conf.set("parquet.filter.bloom.enabled", "false")
    try:
        without = spark.read.option("parquet.filter.bloom.enabled", "false").parquet(
            *sorted({f.rsplit("/", 1)[0] for f in silver.inputFiles()})
        )
        assert rows_read(trace_event(without, some).select("event_id")) == silver.count()
    finally:
        spark.conf.unset("parquet.filter.bloom.enabled")


def test_rows_of_a_file_are_few_short_names(spark):
    """Neither path nor a row of its own for each row that is looked for."""
    path = "file:/" + "long/" * 40
    origins = spark.range(640).select(
        F.lit(path).alias(ORIGIN[0]), F.col("id").alias(ORIGIN[1])
    )
    plan = plan_of(bronze_rows_behind(origins, origins))
    shuffled = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert shuffled and all("_right_" in line or "_left_" in line for line in shuffled)
    names = names_of(origins, ORIGIN)
    assert names.count() == 10
    assert {len(r[0]) for r in names.collect()} == {32}


def test_named_rows_equal_brute_force(spark):
    rng = random.Random(5)
    kinds = "origin_file string, origin_row bigint, n int"

    def made(count):
        files, rows = ["a", "b", None], [None, 0, 63, 64, 2**40, *range(100, 300)]
        return [(rng.choice(files), rng.choice(rows), i) for i in range(count)]

    rows, names = made(900), made(150)
    left, right = spark.createDataFrame(rows, kinds), spark.createDataFrame(names, kinds)
    for keys in (ORIGIN, ORIGIN[:1], ORIGIN[1:], ("n", *ORIGIN)):
        place = [left.columns.index(key) for key in keys]
        wanted = {tuple(r[i] for i in place) for r in names}
        found = bronze_rows_behind(right, left, keys)
        assert found.columns == left.columns
        kept = [r for r in rows if tuple(r[i] for i in place) in wanted]
        assert Counter(tuple(r) for r in found.collect()) == Counter(kept)
