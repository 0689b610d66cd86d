from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from assayer.operators.distinct import (
    BITS,
    SKETCH_ERROR,
    buyer_bitmaps,
    buyer_sketches,
    count_bitmaps,
    count_sketches,
    merge_bitmaps,
    merge_sketches,
)
from assayer.operators.gold import Rollup

SPEC = Rollup(ts="at", keys=("k",), buyer="buyer")
START = datetime(2024, 1, 30)


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(4)
    made = [
        (
            START + timedelta(minutes=pick.randrange(4 * 24 * 60)),
            pick.choice(["a", "b", None]),
            pick.choice([None, -pick.randrange(70_000), pick.randrange(70_000), 2**40, 0]),
        )
        for _ in range(20_000)
    ]
    return made, spark.createDataFrame(made, "at timestamp, k string, buyer bigint")


@pytest.mark.parametrize("grain", ["day", "month"])
@pytest.mark.parametrize("keys", [(), ("k",)])
def test_merged_sets_against_plain_sets(rows, grain, keys):
    made, frame = rows
    wanted: dict[tuple, set] = {}
    for at, k, buyer in made:
        time = at.replace(hour=0, minute=0)
        time = time.replace(day=1) if grain == "month" else time
        wanted.setdefault((time, k) if keys else (time,), set()).add(buyer)
    wanted = {group: len(found - {None}) for group, found in wanted.items()}
    group = [f"{grain}_bucket", *keys]
    hourly = buyer_bitmaps(frame, F.col("buyer"), SPEC)
    # By way of days, and at once.
    daily = merge_bitmaps(hourly, "day", ("k",), SPEC)
    by_day = Rollup(ts="at", grain="day", keys=("k",))
    for bitmaps in (
        merge_bitmaps(hourly, grain, keys, SPEC),
        merge_bitmaps(daily, grain, keys, by_day),
    ):
        found = count_bitmaps(bitmaps, group).collect()
        assert {tuple(r)[:-1]: r.unique_buyers for r in found} == wanted
    about = merge_sketches(buyer_sketches(frame, SPEC), grain, keys, SPEC)
    for r in count_sketches(about, group).collect():
        exact = wanted[tuple(r)[:-1]]
        assert abs(r.estimated_buyers - exact) <= 5 * SKETCH_ERROR * exact + 1


def test_a_bitmap_has_a_bounded_size(spark):
    """Many buyers of one group are many blocks, none of which is large."""
    frame = spark.range(500_000).select(
        F.lit(START).alias("at"), F.lit("a").alias("k"), F.col("id").alias("buyer")
    )
    bitmaps = buyer_bitmaps(frame, F.col("buyer"), SPEC)
    sizes = bitmaps.agg(F.count(F.lit(1)), F.max(F.octet_length(BITS))).first()
    assert sizes[0] == -(-499_999 // 32_768) + 1 and sizes[1] == 4096
    assert count_bitmaps(bitmaps, ["k"]).first().unique_buyers == 500_000


def test_no_rows(spark, rows):
    none = rows[1].limit(0)
    assert count_bitmaps(buyer_bitmaps(none, F.col("buyer"), SPEC), ["k"]).isEmpty()
    assert count_sketches(buyer_sketches(none, SPEC), ["k"]).isEmpty()


def test_a_sparse_bitmap_takes_what_its_buyers_take(spark):
    """A buyer in each of many blocks: bytes follow the buyers, not the blocks' size."""
    frame = spark.range(300).select(
        F.lit(START).alias("at"), F.lit("a").alias("k"), (F.col("id") * 40_000).alias("buyer")
    )
    hourly = buyer_bitmaps(frame, F.col("buyer"), SPEC)
    daily = merge_bitmaps(hourly, "day", ("k",), SPEC)
    for bitmaps in (hourly, daily):
        sizes = bitmaps.agg(F.count(F.lit(1)), F.sum(F.octet_length(BITS))).first()
        assert tuple(sizes) == (300, 300 * 8)
        assert count_bitmaps(bitmaps, ["k"]).first().unique_buyers == 300
