"""Ranked lexical search by dense blocked matrix products.

Documents are read once per block of items and reduced to the terms that some
item has (the compact vocabulary), with their counts. Then the scores are matrix
products: a tile of items (rows) by vocabulary (columns) holds the weights of the
items' terms, a tile of vocabulary by documents the impacts of these terms. Weights
and impacts are whole numbers, and a vocabulary tile is so narrow that no sum of
products can reach 2^53, so that float64 products are exact whatever the order of
addition; sums over vocabulary tiles are 64-bit integers.

Of every tile of documents only scores count that reach the k-th best of an
item so far. All that are equal to it stay until the ids have decided.

Terms are runs of ASCII letters and digits and of characters beyond ASCII; only
A-Z are lower-cased. In UTF-8 this is a rule on bytes.

Defined results: a null or empty text has no terms; a document without terms counts
nowhere; an item without terms, or whose terms no document has, gives no rows;
equal scores go by ascending ``doc_id``, null last; repeated documents count each;
every row of the items gets its rows, repeated ones too; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import pieces, texts, written

#: Fixed values of the score: how much the length of a document counts (percent),
#: how soon further occurrences stop to count (tenths), and the scales of the whole numbers.
LENGTH_PERCENT = 90
SATURATION = 8
WEIGHT_SCALE = 1000
IMPACT_SCALE = 1_000_000

#: Items that are searched for at a time, and the bytes of their texts: what is sent
#: to the workers does not grow with the table of items.
BLOCK_ITEMS = 2048
BLOCK_BYTES = 2 << 20
#: Bytes of a text whose terms are held at a time.
PIECE_BYTES = 1 << 20
#: Sides of the tiles.
TILE_ITEMS = 128
TILE_TERMS = 4096
TILE_DOCUMENTS = 512
#: Tiles of weights that a worker keeps instead of making them again.
KEPT_BYTES = 64 << 20

_FOLD = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)
_EXACT = 1 << 53


def terms_of(data: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return data.translate(_FOLD).split()


def counted_terms(data: bytes, piece: int = PIECE_BYTES) -> tuple[int, Counter]:
    """How many terms a text has, and how often each; long texts piece by piece."""
    folded = data.translate(_FOLD)
    total, found, at = 0, Counter(), 0
    while at < len(folded):
        end = folded.find(b" ", at + piece)
        end = len(folded) if end < 0 else end
        words = folded[at:end].split()
        total += len(words)
        found.update(words)
        at = end
    return total, found


@dataclass(frozen=True)
class Queries:
    """A block of items: their terms by number, and the weight of each term."""

    terms: list[np.ndarray]
    weights: np.ndarray


@dataclass(frozen=True)
class Tile:
    """Weights of some items (``first`` is the first one's number) for some terms."""

    first: int
    columns: list[np.ndarray]  # term numbers, one array for each vocabulary tile
    rows: int


def tiles_of(queries: Queries) -> list[Tile]:
    """Items cut into tiles, each with a vocabulary of its own."""
    largest = int(queries.weights.max(initial=1))
    width = max(1, min(TILE_TERMS, (_EXACT - 1) // (largest * IMPACT_SCALE)))
    tiles = []
    for first in range(0, len(queries.terms), TILE_ITEMS):
        own = queries.terms[first : first + TILE_ITEMS]
        used = np.unique(np.concatenate(own))
        columns = [used[i : i + width] for i in range(0, len(used), width)]
        tiles.append(Tile(first, columns, len(own)))
    return tiles


def weights_tile(queries: Queries, tile: Tile, columns: np.ndarray) -> np.ndarray:
    """The dense tile: weight of a term where the item has it, else 0."""
    out = np.zeros((tile.rows, len(columns)))
    for row in range(tile.rows):
        own = np.intersect1d(queries.terms[tile.first + row], columns, assume_unique=True)
        out[row, np.searchsorted(columns, own)] = queries.weights[own]
    return out


class Best:
    """The ``k`` best documents of each item, equal scores by ascending id."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        #: A score must reach this.
        self.least = np.ones(items, np.int64)
        self.rows = {
            "item": np.zeros(0, np.int64),
            "score": np.zeros(0, np.int64),
            "doc_id": np.zeros(0, np.int64),
            "no_id": np.zeros(0, bool),
        }

    def offer(self, first: int, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """Scores of a tile: items from number ``first`` on by documents."""
        least = self.least[first : first + len(scores)]
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        row, column = np.nonzero(scores >= least[:, None])
        if not len(row):
            return
        found = {
            "item": row + first,
            "score": scores[row, column],
            "doc_id": ids[column],
            "no_id": no_id[column],
        }
        merged = {n: np.concatenate([self.rows[n], v]) for n, v in found.items()}
        order = np.lexsort(
            (merged["doc_id"], merged["no_id"], -merged["score"], merged["item"])
        )
        item = merged["item"][order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        best = order[place < self.k]
        self.rows = {n: v[best] for n, v in merged.items()}
        last = place[place < self.k] == self.k - 1
        self.least[self.rows["item"][last]] = self.rows["score"][last]


def impacts(tf: np.ndarray, measure: np.ndarray) -> np.ndarray:
    """What ``tf`` occurrences are worth in a document of this length measure."""
    return (1000 * IMPACT_SCALE * tf) // (1000 * tf + SATURATION * measure)


def length_measure(n: int, documents: int, terms: int) -> int:
    """The length of a document in percent of the mean, damped."""
    return 100 - LENGTH_PERCENT + LENGTH_PERCENT * n * documents // terms


# -- tasks ---------------------------------------------------------------------

_COMPACT = "doc_id long, n long, terms array<int>, tfs array<int>"
_FOUND = "item int, score long, doc_id long"


def _compacted(docs: DataFrame, vocabulary) -> DataFrame:
    """Each document with terms: its number of terms, and those of the vocabulary."""

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in pieces(batches):
            ids, sizes, ends, terms, tfs = [], [], [0], [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                size, found = counted_terms(text.as_buffer().to_pybytes())
                if not size:
                    continue
                ids.append(doc_id.as_py())
                sizes.append(size)
                for word, count in found.items():
                    if word in number:
                        terms.append(number[word])
                        tfs.append(count)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (terms, tfs)
            ]
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return texts(docs).mapInArrow(compact, _COMPACT)


def _ranked(batches, queries: Queries, documents: int, total: int, k: int):
    """The best documents of a task for each item."""
    tiles = tiles_of(queries)
    place = np.full(len(queries.weights), -1, np.int64)
    kept: dict[tuple[int, int], np.ndarray] = {}
    spare = KEPT_BYTES
    best = Best(len(queries.terms), k)
    for batch in batches:
        for start in range(0, batch.num_rows, TILE_DOCUMENTS):
            part = batch.slice(start, TILE_DOCUMENTS)
            n = part["n"].to_numpy()
            measure = np.array([length_measure(int(x), documents, total) for x in n], np.int64)
            counts = part["terms"].value_lengths().to_numpy()
            term = part["terms"].flatten().to_numpy()
            column = np.repeat(np.arange(len(n)), counts)
            impact = impacts(
                part["tfs"].flatten().to_numpy().astype(np.int64), measure[column]
            ).astype(np.float64)
            no_id = part["doc_id"].is_null().to_numpy(zero_copy_only=False)
            ids = part["doc_id"].fill_null(0).to_numpy()
            for t, tile in enumerate(tiles):
                scores = np.zeros((tile.rows, len(n)), np.int64)
                for v, columns in enumerate(tile.columns):
                    weights = kept.get((t, v))
                    if weights is None:
                        weights = weights_tile(queries, tile, columns)
                        if weights.nbytes <= spare:
                            kept[t, v] = weights
                            spare -= weights.nbytes
                    place[columns] = np.arange(len(columns))
                    row = place[term]
                    own = row >= 0
                    dense = np.zeros((len(columns), len(n)))
                    dense[row[own], column[own]] = impact[own]
                    place[columns] = -1
                    # Whole numbers whose sums stay below 2^53: exact.
                    scores += (weights @ dense).astype(np.int64)
                best.offer(tile.first, scores, ids, no_id)
    rows = best.rows
    yield pa.record_batch(
        [
            pa.array(rows["item"], pa.int32()),
            pa.array(rows["score"], pa.int64()),
            pa.array(rows["doc_id"], pa.int64(), mask=rows["no_id"]),
        ],
        names=["item", "score", "doc_id"],
    )


def _search_block(
    docs: DataFrame, keys: list[str], data: list[bytes], k: int
) -> DataFrame | None:
    """The best documents for a block of distinct item texts."""
    spark = docs.sparkSession
    number: dict[bytes, int] = {}
    terms = []
    for text in data:
        own = {number.setdefault(term, len(number)) for term in terms_of(text)}
        terms.append(np.array(sorted(own), np.int64))
    if not number:
        return None
    compact = written(spark, _compacted(docs, spark.sparkContext.broadcast(number)), "terms")
    size = compact.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    if not size["documents"]:
        return None
    # One count for each term of the block, whose size is bounded.
    held = compact.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(number), np.int64)
    documents, total = size["documents"], size["terms"]
    for term, df in held:
        ratio = (2 * documents + 2) / (2 * df + 1)
        weights[term] = math.floor(WEIGHT_SCALE * math.log(ratio))
    queries = spark.sparkContext.broadcast(Queries(terms, weights))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _ranked(batches, queries.value, documents, total, k)

    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = (
        compact.mapInArrow(rank, _FOUND)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )
    numbered = spark.createDataFrame(list(enumerate(keys)), "item int, item_key string")
    return ranked.join(F.broadcast(numbered), "item").drop("item")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents for each row of ``items`` (``item_id``, ``text``).

    Columns: ``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``. The items are
    the stated queries; equal texts are searched for once. They pass through the
    driver in blocks of bounded size, and the documents are read once per block.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    keyed = items.select("item_id", F.sha2(text, 256).alias("item_key"), text.alias("text"))
    distinct = keyed.groupBy("item_key").agg(F.first("text").alias("text"))
    distinct = written(spark, distinct, "items")
    size = distinct.agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")
    ).first()
    blocks = max(1, -(-size["rows"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    block = F.pmod(F.crc32(F.col("item_key").cast("binary")), F.lit(blocks))
    found = []
    for number in range(blocks):
        rows = distinct.where(block == number).orderBy("item_key").collect()
        one = _search_block(
            docs, [r["item_key"] for r in rows], [r["text"].encode() for r in rows], k
        )
        if one is not None:
            found.append(one if blocks == 1 else written(spark, one, "found"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    together = found[0]
    for one in found[1:]:
        together = together.unionByName(one)
    return (
        keyed.drop("text")
        .join(together, "item_key")
        .select("item_id", "rank", "doc_id", "score")
    )
