from __future__ import annotations

import pytest
from plans import plan_of
from pyspark import TaskContext
from pyspark.sql import functions as F

from assayer.operators.gold import revenue_per_hour
from assayer.operators.silver import to_silver
from assayer.plans import fixture
from assayer.session import new_workspace
from assayer.sources.events import stream_json_events
from assayer.streaming.gold import RevenueStream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def clean(spark):
    return to_silver(fixture.bronze_events(spark, SF)).drop("processed_at")


def losing(name):
    """A column that some tasks fail to compute on their first attempt."""

    def lost_once(value):
        if TaskContext.get().attemptNumber() == 0 and int(value) % 50 == 49:
            raise RuntimeError("lost")
        return value

    return F.udf(lost_once)(name)


@pytest.fixture(scope="module")
def unreliable_bronze(spark):
    """The same events, from tasks some of which fail on their first attempt."""
    bronze = fixture.bronze_events(spark, SF).repartition(6, "event_id")
    return bronze.withColumn("event_id", losing("event_id"))


@pytest.fixture(scope="module")
def unreliable(unreliable_bronze):
    return to_silver(unreliable_bronze).drop("processed_at")


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_layers_count_rows_once(spark, clean, unreliable):
    folder = new_workspace(spark, "test-retry")
    unreliable.write.mode("append").parquet(folder)
    unreliable.write.mode("append").parquet(folder)
    assert same(spark.read.parquet(folder), clean.unionAll(clean))


def test_counts_of_a_build_are_those_of_its_tables(spark, unreliable_bronze):
    layers = fixture.new_layers(spark, "retry")
    counts = layers.build(unreliable_bronze)
    assert same(counts.summary(), layers.summary())
    assert same(counts.drops(), layers.drops())
    more = layers.append(unreliable_bronze.where("category = 'k1'"), 1)
    bronze = more.summary().where("layer = 'bronze'").first().records
    assert bronze == layers.read("bronze").where("load_id = 1").count() > 0
    # They cost no scan: the plans have no table in them.
    assert "FileScan" not in plan_of(counts.summary()) + plan_of(counts.drops())


def test_gold_stream_counts_rows_once(spark, clean):
    work = new_workspace(spark, "test-retry")
    landing = fixture.json_landing(spark, SF)
    source = stream_json_events(spark, landing, files_per_batch=2)
    failing = source.withColumn("event_id", losing("event_id"))
    stream = RevenueStream(work, keep=fixture.FEED_SPAN)
    stream.start(to_silver(failing), f"{work}/checkpoint").awaitTermination()
    assert same(stream.read_gold(spark), revenue_per_hour(clean))
