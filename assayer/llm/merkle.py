"""Document fingerprints: a Merkle tree over clauses, paragraphs and sections.

The leaves are SHA-256 hashes of a paragraph's clauses; a paragraph (a line)
hashes its clauses, a section its paragraphs, and the root all sections. A
section ends where a paragraph's hash says so, so that an inserted paragraph
changes its own section and no other. Roots test equality; where two roots
differ, the branches that differ tell where.

The clauses keep every character, so that different texts have different trees.
The likeness of two trees is the share of their distinct leaves that both have.

All of it is made of Spark's own functions. Defined results: a null text is an
empty text, a tree with one empty leaf; equal rows have equal trees; documents
with equal ids follow each other in descending order of their text, and a null
id comes after all others; the document after the last is the first, so that a
single document follows itself; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.quality import let

#: A clause begins at the white space behind one of these marks.
CLAUSE = r"(?<=[.,;:!?|])(?=[ \t])"
#: A paragraph whose hash ends in one of these digits ends a section: one in four.
SECTION_ENDS = ("0", "4", "8", "c")
#: Digits of a leaf's hash that count for the likeness of two trees (64 bits).
LEAF_DIGITS = 16

#: Documents of a bucket of neighbouring ids, on average.
DOCUMENTS_PER_BUCKET = 256
#: The most buckets. Their bounds are all that is collected.
MOST_BUCKETS = 1 << 16
_FANOUT = 16


def _node(kind: str, parts: Column) -> Column:
    """The hash of a node; its kind keeps the levels of the tree apart."""
    return F.sha2(F.concat(F.lit(kind), F.array_join(parts, "")), 256)


def tree(text: Column) -> Column:
    """``root``, ``sections``, ``paragraphs`` and ``leaves`` (distinct, cut short)."""
    clauses = F.transform(
        F.split(text, "\n"),
        lambda line: F.transform(F.split(line, CLAUSE), lambda c: F.sha2(c, 256)),
    )

    def above(leaves: Column) -> Column:
        paragraphs = F.transform(leaves, lambda each: _node("p", each))
        marks = F.transform(F.flatten(leaves), lambda h: F.left(h, F.lit(LEAF_DIGITS)))
        return let(paragraphs, lambda p: top(p, F.array_distinct(marks)))

    def top(paragraphs: Column, leaves: Column) -> Column:
        return let(
            _sections(paragraphs),
            lambda sections: F.struct(
                _node("r", sections).alias("root"),
                sections.alias("sections"),
                paragraphs.alias("paragraphs"),
                leaves.alias("leaves"),
            ),
        )

    return let(clauses, above)


def _sections(paragraphs: Column) -> Column:
    size = F.size(paragraphs)
    ending = F.transform(
        paragraphs,
        lambda p, i: F.when(
            (i == size - 1) | F.right(p, F.lit(1)).isin(*SECTION_ENDS), i + 1
        ),
    )
    return let(
        F.array_compact(ending),
        lambda ends: F.transform(
            ends,
            lambda end, k: let(
                F.coalesce(F.get(ends, k - 1), F.lit(0)),
                lambda begin: _node("s", F.slice(paragraphs, begin + 1, end - begin)),
            ),
        ),
    )


def likeness(one: Column, other: Column) -> Column:
    """The share of the distinct leaves of both trees that they have in common."""
    common = F.size(F.array_intersect(one, other))
    return common / (F.size(one) + F.size(other) - common)


def changed_paragraphs(one: Column, other: Column) -> Column:
    """The places of the paragraphs of ``one`` that ``other`` does not have.

    Sections are compared first: only paragraphs of a tree whose root differs
    are looked at.
    """
    places = F.transform(
        one["paragraphs"],
        lambda p, i: F.when(~F.array_contains(other["paragraphs"], p), i),
    )
    same = one["root"] == other["root"]
    return F.when(same, F.array().cast("array<int>")).otherwise(F.array_compact(places))


def changed_sections(one: Column, other: Column) -> Column:
    """How many of the sections of ``one`` are not sections of ``other``."""
    return F.size(F.array_except(one["sections"], other["sections"]))


# -- the next document ---------------------------------------------------------------


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds but the first are at most ``key``, by a search tree."""
    steps, step = [], 1
    while step < len(bounds):
        steps.append(step)
        step *= _FANOUT

    def search(place: Column, left: list[int]) -> Column:
        if not left:
            return place
        step = left[-1]
        level = F.lit(bounds[::step])
        # The bounds of this level from where the level above has come to.
        near = F.slice(level, (place / step).cast("int") + 1, _FANOUT)
        passed = F.size(F.filter(near, lambda bound: bound <= key))
        return let(
            place + step * F.greatest(passed - 1, F.lit(0)),
            lambda found: search(found, left[:-1]),
        )

    return search(F.lit(0), steps)


def with_next(docs: DataFrame, *, per_bucket: int = DOCUMENTS_PER_BUCKET) -> DataFrame:
    """``doc_id``, ``text``, ``leaves`` and those of the next document.

    The next document is that with the next smaller ``doc_id``. The ids are cut
    into buckets of about equal size, and each bucket gets a copy of the
    document that follows its last one, so that a window within each bucket
    sees all neighbours. Texts are shuffled once, and no window spans the
    table. What the driver holds is two numbers per bucket.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key")
    )
    bounds, heads = _buckets(rows.select("key"), per_bucket)
    numbers = [b for b, head in enumerate(heads) if head is not None]
    after = dict(zip(numbers, numbers[1:] + numbers[:1]))
    follower = F.lit([after.get(b, b) for b in range(len(heads))] or [0])
    last = F.lit([head if head is not None else 0 for head in heads] or [0])
    bucket = _bucket(F.col("key"), bounds)

    def places(b: Column) -> Column:
        own = F.struct(b.alias("bucket"), F.lit(0).alias("copy"))
        copy = F.struct(F.get(follower, b).alias("bucket"), F.lit(1).alias("copy"))
        return F.when(F.get(last, b) == F.col("key"), F.array(own, copy)).otherwise(F.array(own))

    placed = rows.select("doc_id", "key", "text", F.explode(let(bucket, places)).alias("at"))
    dealt = placed.select("doc_id", "key", "text", "at.bucket", "at.copy").repartition("bucket")
    marked = dealt.withColumn("own", tree(F.col("text")))
    near = Window.partitionBy("bucket").orderBy("copy", F.desc("key"), F.desc("text"))
    found = marked.select(
        "doc_id",
        "text",
        "own",
        "copy",
        F.lead("text").over(near).alias("next_text"),
        F.lead("own.leaves").over(near).alias("next_leaves"),
    )
    return found.where("copy = 0").drop("copy")


def _buckets(keys: DataFrame, per_bucket: int) -> tuple[list[int], list[int | None]]:
    """The lowest key of each bucket and the highest that occurs in it."""
    count = min(MOST_BUCKETS, -(-keys.count() // per_bucket))
    if not count:
        return [0], []
    shares = F.lit([k / count for k in range(count)])
    quantiles = keys.agg(F.percentile_approx("key", shares, 10 * max(count, 1000)))
    bounds = sorted(set(quantiles.first()[0]))
    tops = keys.groupBy(_bucket(F.col("key"), bounds).alias("b")).agg(F.max("key").alias("top"))
    heads: list[int | None] = [None] * len(bounds)
    for row in tops.collect():
        heads[row["b"]] = row["top"]
    return bounds, heads


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Trees of all documents and of their edited texts.

    The edit replaces the last half of a text (its floor(n / 2) last code
    points) by the first as many of the next document. Columns: ``doc_id``,
    ``n_chars``, ``edited`` (text), ``own`` and ``changed`` (trees),
    ``near_edited`` and ``near_next``.
    """
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.left("text", size - half), F.left("next_text", half))
    found = with_next(docs).select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        "own",
        edited.alias("edited"),
        likeness(F.col("own.leaves"), F.col("next_leaves")).alias("near_next"),
    )
    found = found.withColumn("changed", tree(F.col("edited")))
    near = likeness(F.col("own.leaves"), F.col("changed.leaves"))
    return found.withColumn("near_edited", near)
