from __future__ import annotations

import pytest
from compare import differences

from __spark_entry__ import entry
from assayer.plans import fixture
from assayer.plans.oracle import ORACLE
from assayer.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, QUERIES[name], ORACLE[name], SF) == []


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["hour_bucket", "category"]
    assert df.count() > 0


def test_events_are_conserved(spark):
    """Each count of the layers follows from the one below it."""
    run = {name: QUERIES[name](spark, SF) for name in (
        "bronze_events",
        "silver_drop_accounting",
        "silver_events",
        "gold_revenue_per_hour",
        "lineage_gold_to_silver",
    )}
    drops = {row.reason: row.rows for row in run["silver_drop_accounting"].collect()}
    silver = run["silver_events"]
    assert sum(drops.values()) == run["bronze_events"].count()
    assert drops["ok"] == silver.count()
    sold = silver.where("event_type = 'purchase'").count()
    gold = run["gold_revenue_per_hour"].collect()
    assert sum(row.transaction_count for row in gold) == sold
    assert run["lineage_gold_to_silver"].count() == sold


@pytest.mark.parametrize(
    "name, scans",
    [
        ("layer_summary", 1),
        ("silver_drop_accounting", 1),
        ("gold_revenue_per_hour", 1),
        ("lineage_gold_to_silver", 2),
        ("lineage_silver_to_bronze", 2),
        ("lineage_gold_to_bronze", 3),
        ("lineage_bronze_to_gold", 3),
    ],
)
def test_each_input_is_read_once(spark, name, scans):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == scans


def test_every_rule_has_rows_that_violate_it(spark):
    """The mixed feed meets all reasons, so that a rule that is missing shows."""
    drops = {r.reason: r.rows for r in QUERIES["mixed_drop_accounting"](spark, SF).collect()}
    assert all(drops.values()) and len(drops) == 6
    typed = QUERIES["mixed_typed"](spark, SF).collect()
    over = [r for r in typed if r.raw_quantity is not None and r.raw_quantity >= 2**31]
    fits = [r for r in typed if r.raw_quantity is not None and r.raw_quantity < 2**31]
    assert over and all(r.quantity is None for r in over)
    assert fits and all(r.quantity == r.raw_quantity for r in fits)
    kinds = {r.change for r in QUERIES["snapshot_changes"](spark, SF).collect()}
    assert kinds == {"added", "removed", "changed"}
    corrupt = QUERIES["bronze_variant_drift"](spark, SF).collect()
    assert {r.source for r in corrupt if r.corrupt_records} == {
        "conversations", "documents", "pages",
    }


def test_written_inputs_follow_the_given_tables(spark, tmp_path):
    """A table that has changed is landed again."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    counts = []
    for n in (5, 8):
        events.limit(n).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        counts += [
            QUERIES["bronze_json_events"](spark, str(tmp_path)).count(),
            fixture.written_layers(spark, str(tmp_path)).read("bronze").count(),
        ]
    assert counts == [5, 5, 8, 8]
    first = fixture.json_landing(spark, str(tmp_path))
    assert fixture.json_landing(spark, str(tmp_path)) == first
