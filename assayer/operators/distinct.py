"""Distinct buyers of longer spans from those of shorter ones.

Counts of distinct buyers can't be added up: a buyer of two hours is one buyer of the
day. What can be merged are sets. Two forms, both made once per hour and merged to
days, months or across keys without reading the events again:

* bitmaps, exact: one bit per buyer number, in blocks of 32,768 bits, so that a hot
  group is spread over the blocks of its buyers. A block holds the words of 64 bits that
  have a buyer, so that it takes no more than its buyers do, and 4,096 bytes at most;
* HLL sketches, approximate: a fixed size per group, whatever it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.coercion import bucket
from assayer.operators.gold import REVENUE_PER_HOUR, Rollup

BLOCK = "block"
BITS = "bits"
#: Which of a block's 512 words are in its bits, in this order.
WORDS = "words"
SKETCH = "sketch"
#: Logarithm of the number of registers of a sketch.
LOG_REGISTERS = 12
#: Relative standard error of an estimate.
SKETCH_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)


def buyer_bitmaps(rows: DataFrame, number: Column, spec: Rollup = REVENUE_PER_HOUR) -> DataFrame:
    """The buyers of each group as bitmaps; ``number`` is a buyer's whole number.

    Rows without a number have no buyer. Words are combined within the tasks, before
    they are shuffled.
    """
    numbered = rows.select(spec.bucket(), *spec.keys, number.cast("bigint").alias("n"))
    numbered = numbered.where(F.col("n").isNotNull())
    position = F.bitmap_bit_position("n").cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), position.bitwiseAND(F.lit(63)))
    words = numbered.select(
        *spec.group,
        F.bitmap_bucket_number("n").alias(BLOCK),
        F.shiftright(position, 6).alias("word"),
        bit.alias("ones"),
    )
    return _packed(words, [*spec.group, BLOCK])


def _packed(words: DataFrame, block: Sequence[str]) -> DataFrame:
    """One row per block from its words, some of which may come several times."""
    once = words.groupBy(*block, "word").agg(F.bit_or("ones").alias("ones"))
    found = F.sort_array(F.collect_list(F.struct("word", "ones"))).alias("found")
    digits = F.transform("found", lambda w: F.lpad(F.hex(w["ones"]), 16, "0"))
    return once.groupBy(*block).agg(found).select(
        *block, F.col("found.word").alias(WORDS), F.unhex(F.array_join(digits, "")).alias(BITS)
    )


def _unpacked(place: Column, word: Column) -> Column:
    """A word of a block and its ones, by its place in the bits."""
    digits = F.hex(F.substring(BITS, place * 8 + 1, F.lit(8)))
    return F.struct(word.alias("word"), F.conv(digits, 16, -10).cast("bigint").alias("ones"))


def buyer_sketches(rows: DataFrame, spec: Rollup = REVENUE_PER_HOUR) -> DataFrame:
    """The buyers of each group as an HLL sketch; null buyers are not in it."""
    sketch = F.hll_sketch_agg(spec.buyer, LOG_REGISTERS).alias(SKETCH)
    return rows.groupBy(spec.bucket(), *spec.keys).agg(sketch)


def merge_bitmaps(
    bitmaps: DataFrame, grain: str, keys: Sequence[str], spec: Rollup = REVENUE_PER_HOUR
) -> DataFrame:
    """Bitmaps of a coarser grain, for some of the keys; can be merged again."""
    coarse_name = f"{grain}_bucket"
    coarse = bucket(F.col(spec.bucket_name), grain).alias(coarse_name)
    words = F.inline(F.transform(WORDS, lambda word, place: _unpacked(place, word)))
    return _packed(bitmaps.select(coarse, *keys, BLOCK, words), [coarse_name, *keys, BLOCK])


def merge_sketches(
    sketches: DataFrame, grain: str, keys: Sequence[str], spec: Rollup = REVENUE_PER_HOUR
) -> DataFrame:
    coarse = bucket(F.col(spec.bucket_name), grain).alias(f"{grain}_bucket")
    return sketches.groupBy(coarse, *keys).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def count_bitmaps(bitmaps: DataFrame, group: Sequence[str]) -> DataFrame:
    """Exact distinct buyers of each group; no buyer is in two blocks."""
    return bitmaps.groupBy(*group).agg(F.sum(F.bitmap_count(BITS)).alias("unique_buyers"))


def count_sketches(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """About as many, within a few times ``SKETCH_ERROR``."""
    estimate = F.hll_sketch_estimate(SKETCH).alias("estimated_buyers")
    return sketches.select(*group, estimate)
