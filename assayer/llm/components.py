"""Connected components of a graph of links, by large-star and small-star rounds.

Each round sends, for every node, one row per neighbour; no neighbourhood is
gathered into one row or task. The links of a round are written to the shared
folder, which cuts their lineage and lets the rounds stop when nothing changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import written

#: Far more than any chain of links needs: rounds grow with the logarithm.
MOST_ROUNDS = 60


def _lowest(links: DataFrame) -> DataFrame:
    """For every node the smallest of itself and its neighbours."""
    low = F.min("b").alias("low")
    return links.groupBy("a").agg(low).select("a", F.least("a", "low").alias("low"))


def _both_ways(links: DataFrame) -> DataFrame:
    ends = F.explode(F.array(F.struct("a", "b"), F.struct(_as("b", "a"), _as("a", "b"))))
    return links.select(ends.alias("e")).select("e.a", "e.b")


def _as(name: str, other: str) -> Column:
    return F.col(name).alias(other)


def _large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to its smallest."""
    both = _both_ways(links)
    found = both.join(_lowest(both), "a").where("b > a")
    return found.select(_as("b", "a"), _as("low", "b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = down.join(_lowest(down), "a")
    ends = F.explode(F.array_distinct(F.array("a", "b"))).alias("a")
    return found.select(ends, _as("low", "b")).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of all linked nodes.

    ``links`` has the columns ``a`` and ``b``, in any order, repeated or not.
    Nodes are compared as they are: signed integers by their value.
    """
    spark = links.sparkSession
    links = written(spark, links.where("a != b").distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        links = written(spark, _small_star(_large_star(links)), "links")
        now = links.agg(
            F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")),
            F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b")),
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    roots = links.select(_as("b", "node"), _as("b", "component"))
    return links.select(_as("a", "node"), _as("b", "component")).union(roots).distinct()
