"""Mixing sources to target weights, by cube-method balanced sampling.

Each source has a target, in words. Its documents are taken as many whole times as
the target divided by the source's size says; the rest of that ratio is an inclusion
probability, the same for all documents of a source. The cube method turns these
probabilities into 0 or 1 so that words and documents stay in balance (Deville and
Tille, Biometrika 91, 2004). In each step of the flight the probabilities of all undecided
documents move along a direction in the null space of the two constraints (number of
documents, number of words), so that neither total changes: the direction of the largest
document, without its part in the constraints. They move this way or that with the odds that
keep every expectation, until a probability is 0 or 1. Since the largest go first, small
ones are left.

A source is cut into blocks of bounded size by a hash, and each block flies by itself.
At most two documents of a block stay undecided. They meet those of other blocks in
blocks of the next level, and so on until a source has one block, so that no task ever
has a whole source. Of the last block a dozen undecided documents are left, the landing
problem: all their combinations are tried, and of those that keep the number of
documents the one whose words are nearest to the total wins.

The draws depend on the source's place, the level and the block alone, and documents of
a block are put in an order of their own: reruns agree, whatever the partitions.

Defined results: a null text has no words; a null source is a source, the last one;
documents without words count as documents and take no words; repeated rows are
documents each, and equal ones are interchangeable; a source without words has the
target 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import reach_workers, written
from assayer.llm.quality import SPACE

#: Documents that fly together.
BLOCK = 1024
#: Blocks whose undecided documents, two at most of each, meet in a block.
FAN_IN = BLOCK // 2
#: Documents whose combinations are tried in the end.
LANDING = 14
#: Rows that are alike travel as one, up to so many.
ALIKE = 64
#: Nearer to 0 or 1 a chance counts as decided.
_NEAR = 1e-12
_SURE = 1e-10

_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text, without a list of them: each becomes one character."""
    return F.length(F.regexp_replace(F.regexp_replace(text, _WORD, "x"), SPACE, ""))


# -- one block -----------------------------------------------------------------


def flight(
    sizes: np.ndarray, chances: np.ndarray, draws: np.ndarray, leave: int = 2
) -> np.ndarray:
    """Chances after the flight: 0 or 1 but for ``leave`` of them, 2 at least.

    Neither the sum of the chances nor the sum of chance times size changes. Sizes
    are whole numbers in falling order: the largest document is always the next to be
    moved, while there are many others to make up for it.
    """
    p = np.array(chances, float)
    at = np.flatnonzero((p > 0) & (p < 1))
    for draw in draws:
        n = len(at)
        if n <= max(leave, 2):
            break
        apart = sizes[at] - sizes[at].mean()
        square = apart @ apart
        unit = apart / np.sqrt(square) if square > 0 else apart
        # How far the constraints let each document move by itself.
        free = 1 - 1 / n - unit * unit
        lead = int((free > _SURE).argmax())
        # Its direction without the part that would change the totals.
        u = -1 / n - unit[lead] * unit
        u[lead] += 1
        moves = np.abs(u) > _SURE
        q, v = p[at[moves]], u[moves]
        ahead, behind = np.where(v > 0, 1 - q, q), np.where(v > 0, q, 1 - q)
        up, down = (ahead / np.abs(v)).min(), (behind / np.abs(v)).min()
        q += v * (up if draw * (up + down) < down else -down)
        q[q < _NEAR] = 0
        q[q > 1 - _NEAR] = 1
        p[at[moves]] = q
        at = at[(p[at] > 0) & (p[at] < 1)]
    return p


def landing(sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """0 or 1 for each of a few documents: the words of the total kept as well as can
    be. Documents, the constraint that is let go, count like a word each."""
    choices = (np.arange(1 << len(sizes))[:, None] >> np.arange(len(sizes))) & 1
    words = np.abs(choices @ sizes - (sizes * chances).sum())
    documents = np.abs(choices.sum(axis=1) - chances.sum())
    return choices[int((words + documents).argmin())]


def decided(sizes: np.ndarray, chances: np.ndarray, seed: list[int], last: bool) -> np.ndarray:
    """Chances of a block after its flight, all of them 0 or 1 if it is the last."""
    draws = np.random.default_rng(seed).random(len(sizes))
    leave = LANDING if last else 2
    p = flight(sizes, chances, draws, leave)
    if last:
        at = np.flatnonzero((p > 0) & (p < 1))
        p[at] = landing(sizes[at].astype(float), p[at])
    return p


# -- targets -------------------------------------------------------------------


def _numbered(frame: DataFrame, by: list[Column]) -> DataFrame:
    """A written table with ``place``, the place of each row from 0, in order.

    Ranges are sorted in tasks of their own; only their lengths meet.
    """
    spark = frame.sparkSession
    local = F.monotonically_increasing_id()  # range number, then place in the range
    ranges = frame.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("local", local)
    ranges = written(spark, ranges, "numbered")
    part = F.shiftright("local", 33)
    lengths = ranges.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts, before = [], 0
    for row in lengths:
        starts.append((row["part"], before))
        before += row["count"]
    starts = spark.createDataFrame(starts, "part long, start long")
    place = F.col("start") + F.col("local").bitwiseAND((1 << 33) - 1)
    return (
        ranges.withColumn("part", part)
        .join(F.broadcast(starts), "part")  # one row per range
        .withColumn("place", place)
        .drop("part", "start", "local")
    )


def targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``sources`` (``source``, ``source_size``) with ``place`` and ``target``.

    Weights repeat over the sources by code point. All sizes together are shared by
    weight; no target is above ``most`` times its source's size, and what is over goes
    to the others by weight. So a target is the lesser of that bound and a common level
    times the weight; the level rises as sources reach their bound, and each round adds
    up what is left for the others.
    """
    order = [F.col("source").isNull(), F.col("source")]
    numbered = _numbered(sources, order)
    turn = F.pmod(F.col("place"), F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), turn + 1)
    frame = written(numbered.sparkSession, numbered.withColumn("weight", weight), "sources")
    bound = (F.col("source_size") * most).cast("decimal(38,0)")
    level, full = 0.0, None
    while True:
        above = F.col("weight") * F.lit(level) > bound.cast("double")
        found = frame.agg(
            F.sum(F.col("source_size").cast("decimal(38,0)")).alias("total"),
            F.sum(F.when(above, bound)).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.count(F.when(above, True)).alias("full"),
        ).first()
        if found["full"] == full or not found["weight"]:
            break
        full = found["full"]
        level = float((found["total"] or 0) - (found["held"] or 0)) / found["weight"]
    target = F.least(F.col("weight") * F.lit(level), bound.cast("double"))
    return frame.withColumn("target", target)


# -- all blocks ----------------------------------------------------------------

_UNITS = (
    "doc_id long, source_no long, size long, whole long, chance double, "
    "tie long, alike int, block long, blocks long"
)


def _fly(units: DataFrame, level: int, seed: int) -> DataFrame:
    """One flight of every block."""

    def block(table: pa.Table) -> pa.Table:
        keys = [(c, "ascending") for c in ("tie", "doc_id", "chance")]
        table = table.sort_by([("size", "descending"), *keys])
        table = table.take(np.repeat(np.arange(len(table)), table["alike"].to_numpy()))
        first = {c: table[c][0].as_py() for c in ("source_no", "block", "blocks")}
        p = decided(
            table["size"].to_numpy(),
            table["chance"].to_numpy(),
            [seed, first["source_no"], level, first["block"]],
            last=first["blocks"] == 1,
        )
        sure = (p == 0) | (p == 1)
        whole = table["whole"].to_numpy() + np.where(p == 1, 1, 0)
        changed = {
            "whole": pa.array(whole),
            "chance": pa.array(p, mask=sure),
            "alike": pa.array(np.ones(len(p), np.int32)),
        }
        return pa.table({n: changed.get(n, table[n]) for n in table.column_names})

    flown = units.groupBy("source_no", "block").applyInArrow(block, _UNITS)
    return written(units.sparkSession, flown, f"flight-{level}")


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: int = 0
) -> DataFrame:
    """How often the mix takes each document.

    Columns: ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target``,
    ``copies`` and ``taken`` (words). Together the sources take as many words as there
    are, but for what the landing leaves over.
    """
    spark = docs.sparkSession
    reach_workers(spark)
    size = word_count(F.coalesce("text", F.lit(""))).cast("long").alias("size")
    units = docs.select("doc_id", "source", size).groupBy("doc_id", "source", "size")
    units = written(spark, units.agg(F.count("*").alias("rows")), "units")
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"),
        F.sum("rows").alias("documents"),
    )
    sources = written(spark, targets(sources, weights, most), "targets")
    blocks = F.ceil(F.col("documents") / BLOCK)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    known = sources.select(
        F.col("source").alias("of_source"),
        F.col("place").alias("source_no"),
        F.coalesce(ratio, F.lit(0.0)).alias("ratio"),
        blocks.alias("blocks"),
    )
    placed = units.join(known, F.col("source").eqNullSafe(F.col("of_source")))
    whole = F.floor("ratio").cast("long")
    chance = F.col("ratio") - whole
    placed = placed.withColumns({"whole": whole, "chance": chance})
    copies = ("doc_id", "source_no", "size", F.col("whole").alias("copies"))

    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    done = [placed.where("chance = 0").select("*", each.alias("row")).select(*copies)]

    # Rows that are alike are dealt to blocks in groups, so that no block is overfull.
    groups = F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / ALIKE))
    flying = placed.where("chance > 0").select("*", F.explode(groups).alias("group"))
    tie = F.xxhash64("doc_id", "size", "group", F.lit(seed))
    alike = F.least(F.lit(ALIKE), F.col("rows") - F.col("group") * ALIKE).cast("int")
    flying = flying.withColumns(
        {"tie": tie, "alike": alike, "block": F.pmod(tie, F.col("blocks"))}
    )
    names = [part.split()[0] for part in _UNITS.split(", ")]
    left = sources.agg(F.max(blocks)).first()[0] or 0
    level = 0
    while left:
        flown = _fly(flying.select(*names), level, seed)
        done.append(flown.where("chance is null").select(*copies))
        flying = flown.where("chance is not null").withColumns(
            {
                "block": F.floor(F.col("block") / FAN_IN),
                "blocks": F.ceil(F.col("blocks") / FAN_IN),
            }
        )
        left = 0 if left == 1 else -(-left // FAN_IN)
        level += 1

    together = done[0]
    for one in done[1:]:
        together = together.unionByName(one)
    shown = sources.select(
        F.col("place").alias("source_no"), "source", "source_size", "target"
    )
    return together.join(shown, "source_no").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
