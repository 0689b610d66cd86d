from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from plans import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayer.functions.coercion import exact_average
from assayer.operators.accounting import layer_summary
from assayer.operators.gold import (
    MEASURES,
    buyer_partials,
    clean_revenue,
    combine_partials,
    measures_from_partials,
    negative_revenue,
    revenue_per_hour,
    revenue_rollup,
    sorted_for_sink,
)
from assayer.operators.silver import to_silver
from assayer.session import new_workspace

COLUMNS = ["cast(hour_bucket as timestamp_ntz)", "category", *MEASURES]


def sales(spark, rows):
    """Silver-like rows: (id, buyer, category, amount, time)."""
    typed = [(i, b, c, a and Decimal(a), t, "purchase") for i, b, c, a, t in rows]
    return spark.createDataFrame(
        typed,
        "event_id string, user_id string, category string, amount decimal(12,2), "
        "event_ts timestamp, event_type string",
    )


def random_rows(count, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        # A third of all rows falls into one group, and a third has one buyer.
        hot = rng.random() < 0.34
        category = "hot" if hot else rng.choice(["a", "b", None])
        hour = 5 if hot else rng.randrange(24)
        buyer = "u0" if rng.random() < 0.34 else rng.choice([*"pqrstuvw", None])
        amount = f"{rng.randrange(1, 10**6)}e-2"
        when = datetime(2024, 1, 1, hour, rng.randrange(60), rng.randrange(60))
        rows.append((str(i), buyer, category, amount, when))
    return rows


def half_up(value: Decimal, places: str) -> Decimal:
    return value.quantize(Decimal(places), ROUND_HALF_UP)


def brute_force(rows):
    groups = defaultdict(list)
    for i, buyer, category, amount, when in rows:
        hour = when.replace(minute=0, second=0)
        groups[hour, category].append((i, buyer, Decimal(amount)))
    result = set()
    for (hour, category), members in groups.items():
        amounts = [amount for _, _, amount in members]
        mean = half_up(half_up(sum(amounts) / len(amounts), "1e-6"), "0.01")
        buyers = {buyer for _, buyer, _ in members if buyer is not None}
        result.add(
            (hour, category, sum(amounts), len(members), mean)
            + (max(amounts), min(amounts), len(buyers))
        )
    return result


def test_rollup_equals_brute_force(spark):
    rows = random_rows(3000)
    result = revenue_per_hour(sales(spark, rows)).selectExpr(*COLUMNS)
    assert {tuple(row) for row in result.collect()} == brute_force(rows)


def test_merged_partials_equal_rollup(spark):
    rows = random_rows(3000)
    parts = [buyer_partials(sales(spark, rows[i::3])) for i in range(3)]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = measures_from_partials(combine_partials(together))
    assert {tuple(row) for row in merged.selectExpr(*COLUMNS).collect()} == brute_force(rows)


def test_exact_average_equals_decimal_average(spark):
    # Quotients that end in a tie: ...435 must become ...44.
    groups = [["19.43", "19.44"], ["0.01", "0.02"], ["1.00", "1.00", "1.01"]]
    groups += [[f"{n}.0{d}", f"{n}.05"] for n in range(3) for d in range(10)]
    rows = [(g, Decimal(v)) for g, values in enumerate(groups) for v in values]
    df = spark.createDataFrame(rows, "g int, amount decimal(12,2)")
    both = df.groupBy("g").agg(
        F.round(F.avg("amount"), 2).alias("direct"),
        exact_average(F.sum("amount"), F.count("amount")).alias("merged"),
    )
    assert both.where("direct <> merged").count() == 0
    assert both.where("g = 0").first().merged == Decimal("19.44")


@settings(
    max_examples=10,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(
            st.integers(1, 10**15),
            st.one_of(st.integers(1, 200), st.integers(1, 10**9)),
        ),
        min_size=30,
    )
)
def test_exact_average_of_any_total_and_count(spark, pairs):
    with localcontext() as context:
        context.prec = 60
        expected = [
            half_up(half_up(Decimal(cents).scaleb(-2) / n, "1e-6"), "0.01")
            for cents, n in pairs
        ]
    # An average of amounts fits decimal(12,2).
    kept = [i for i, value in enumerate(expected) if value < 10**10]
    rows = [(i, Decimal(pairs[i][0]).scaleb(-2), pairs[i][1]) for i in kept]
    df = spark.createDataFrame(rows, "i int, total decimal(22,2), n bigint")
    result = df.select("i", exact_average(F.col("total"), F.col("n")).alias("a"))
    assert {r.i: r.a for r in result.collect()} == {i: expected[i] for i in kept}


def test_amounts_of_another_type_are_refused(spark):
    df = sales(spark, random_rows(3)).withColumn("amount", F.lit(1.0))
    for rollup in (revenue_rollup, buyer_partials):
        with pytest.raises(TypeError, match="decimal"):
            rollup(df)


def test_group_without_amounts(spark):
    when = datetime(2024, 1, 1)
    df = sales(spark, [("1", "u", "a", None, when)])
    direct = revenue_rollup(df).selectExpr(*COLUMNS).first()
    merged = measures_from_partials(buyer_partials(df)).selectExpr(*COLUMNS).first()
    assert tuple(direct) == tuple(merged) == (when, "a", None, 1, None, None, None, 1)


def test_only_purchases_count(spark):
    df = sales(spark, random_rows(50)).withColumn("event_type", F.lit("view"))
    assert revenue_per_hour(df).count() == 0


def test_gold_types(spark):
    types = dict(revenue_per_hour(sales(spark, random_rows(5))).dtypes)
    assert types == {
        "hour_bucket": "timestamp",
        "category": "string",
        "total_revenue": "decimal(23,2)",
        "transaction_count": "bigint",
        "avg_order_value": "decimal(13,2)",
        "max_order_value": "decimal(12,2)",
        "min_order_value": "decimal(12,2)",
        "unique_buyers": "bigint",
    }


def test_gold_reads_only_what_it_needs(spark, bronze):
    folder = new_workspace(spark, "test-silver")
    to_silver(bronze({})).write.parquet(folder)
    plan = plan_of(revenue_per_hour(spark.read.parquet(folder)))
    assert "EqualTo(event_type,purchase)" in plan
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert schema.count(":") - 1 == 6
    # Combined before the shuffle, and spread by buyer.
    assert "partial_sum(amount" in plan
    assert "hashpartitioning(hour_bucket" in plan and "user_id" in plan


def gold_rows(spark, revenues):
    return spark.createDataFrame(
        [(Decimal(r),) for r in revenues], "total_revenue decimal(23,2)"
    )


def test_negative_and_clean_revenue(spark):
    gold = gold_rows(spark, ["10.50", "-99999.99", "0.00", "2.25"])
    assert negative_revenue(gold).count() == 1
    assert clean_revenue(gold).first()[0] == Decimal("12.75")
    assert clean_revenue(gold.where("false")).first()[0] is None


def test_layer_summary(spark, bronze):
    raw = bronze({}, {"user_id": None}, {"amount": 30.0}, {"event_type": "view"})
    silver = to_silver(raw)
    rows = layer_summary(raw, silver, revenue_per_hour(silver)).collect()
    assert [tuple(row) for row in rows] == [
        ("bronze", 4, None, None, None),
        ("silver", 3, 1, Decimal("25.0"), None),
        ("gold", 1, None, None, Decimal("40.00")),
    ]
    nothing = raw.where("false")
    empty = to_silver(nothing)
    rows = layer_summary(nothing, empty, revenue_per_hour(empty)).collect()
    assert [tuple(row) for row in rows] == [
        ("bronze", 0, None, None, None),
        ("silver", 0, 0, None, None),
        ("gold", 0, None, None, None),
    ]


def test_sorted_for_sink_orders_across_files(spark):
    df = sorted_for_sink(spark.range(1000).select(F.rand(3).alias("x")), "x")
    per_part = (
        df.groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min("x").alias("low"), F.max("x").alias("high"))
        .orderBy("p")
        .collect()
    )
    for left, right in zip(per_part, per_part[1:]):
        assert left.high <= right.low
