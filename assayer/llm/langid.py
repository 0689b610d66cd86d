"""Language identification: multinomial naive Bayes over hashed n-grams.

Texts are lower-cased, everything that is no letter becomes a space, and all
runs of one to three characters are hashed into ``BUCKETS`` buckets. Spark adds
up the buckets' counts per language; the log probabilities are one matrix of
buckets by languages, which is bounded by the number of languages and goes to
the tasks by broadcast. Numpy scores whole batches of documents.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text if nothing could be learned; rows without ``doc_id`` are
learned from; an empty table gives no rows.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import pieces, texts

BUCKETS = 1 << 16
LONGEST = 3
UNKNOWN = "und"
#: Bytes of text worked on at a time; its n-grams take some 150 times as much.
SCORE_BYTES = 1 << 19

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once per Python worker."""
    if not _LETTERS:
        kinds = (unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1))
        _LETTERS.append(np.fromiter(kinds, bool, sys.maxunicode + 1))
    return _LETTERS[0]


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the row of each, and which rows have a letter."""
    low = [text.lower() for text in column.to_pylist()]
    sizes = np.fromiter(map(len, low), np.int64, len(low))
    data = "".join(low).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(data, np.uint32)
    letter = _letters()[points]
    points = np.where(letter, points, np.uint32(32)).astype(np.uint64)
    row = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))
    lettered = np.zeros(len(low), bool)
    lettered[row[letter]] = True
    buckets, rows = [], []
    code, any_letter = np.zeros(len(points), np.uint64), np.zeros(len(points), bool)
    for n in range(1, LONGEST + 1):
        # ``code`` is that of the n characters from here on.
        keep = len(points) - n + 1
        if keep <= 0:
            break
        code = code[:keep] * np.uint64(0x100000001B3)
        code += points[n - 1 :]
        code += np.uint64(n)
        any_letter = any_letter[:keep] | letter[n - 1 :]
        use = np.flatnonzero(any_letter & (left[:keep] >= n))
        mixed = code[use]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        buckets.append((mixed >> np.uint64(48)).astype(np.int32))
        rows.append(row[use])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), lettered
    return np.concatenate(buckets), np.concatenate(rows), lettered


@dataclass(frozen=True)
class Model:
    """Log probabilities: ``prior`` by language, ``log_prob`` by bucket and language."""

    languages: list[str]
    prior: np.ndarray
    log_prob: np.ndarray

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        return self.judge(column)[:2]

    def judge(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, its probability, the mean log probability of an n-gram in it, and
        the number of n-grams."""
        buckets, rows, lettered = grams(column)
        if not self.languages:
            none = np.zeros(len(column))
            return [UNKNOWN] * len(column), none, none, np.zeros(len(column), np.int64)
        score = np.empty((len(column), len(self.languages)))
        for k in range(len(self.languages)):
            each = self.log_prob[:, k][buckets]
            score[:, k] = np.bincount(rows, each, len(column)) + self.prior[k]
        best = score.argmax(1)
        odds = np.exp(score - score.max(1, keepdims=True))
        sure = odds[np.arange(len(best)), best] / odds.sum(1)
        named = [
            self.languages[k] if known else UNKNOWN for k, known in zip(best, lettered.tolist())
        ]
        own = score[np.arange(len(best)), best] - self.prior[best]
        size = np.bincount(rows, minlength=len(column))
        return named, np.where(lettered, sure, 0.0), own / np.maximum(size, 1), size


def train(docs: DataFrame, smoothing: float = 0.1) -> Model:
    """A model of all rows that have a ``lang`` and a text with letters."""
    labelled = texts(docs, "lang").where(F.col("lang").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        totals = np.zeros((0, BUCKETS + 1), np.int64)  # the last column: documents
        for batch in pieces(batches, limit=SCORE_BYTES):
            buckets, rows, lettered = grams(batch["text"])
            number = [names.setdefault(x, len(names)) for x in batch["lang"].to_pylist()]
            number = np.array(number, np.int64)
            if len(names) > len(totals):
                more = np.zeros((len(names) - len(totals), BUCKETS + 1), np.int64)
                totals = np.concatenate([totals, more])
            cell = number[rows] * (BUCKETS + 1) + buckets  # int64
            totals += np.bincount(cell, minlength=totals.size).reshape(totals.shape)
            totals[:, BUCKETS] += np.bincount(number[lettered], minlength=len(totals))
        for name, k in names.items():
            found = np.flatnonzero(totals[k])
            yield pa.record_batch(
                {
                    "lang": pa.array([name] * len(found), pa.string()),
                    "bucket": pa.array(found.astype(np.int32)),
                    "n": pa.array(totals[k][found]),
                }
            )

    counted = labelled.mapInArrow(count, "lang string, bucket int, n long")
    # At most one row per language and bucket reaches the driver.
    total = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(total["lang"].to_pylist()))
    counts = np.zeros((BUCKETS + 1, len(languages)))
    place = {name: k for k, name in enumerate(languages)}
    column = np.array([place[x] for x in total["lang"].to_pylist()], np.int64)
    counts[total["bucket"].to_numpy(), column] = total["n"].to_numpy()
    documents = counts[BUCKETS]
    counts = counts[:BUCKETS] + smoothing
    log_prob = np.log(counts / counts.sum(0)).astype(np.float32)
    return Model(languages, np.log(documents / max(1.0, documents.sum())), log_prob)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the posterior probability)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=SCORE_BYTES):
            named, sure = shared.value.predict(batch["text"])
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "lang_pred": pa.array(named, pa.string()),
                    "score": pa.array(sure),
                }
            )

    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def predict_rows(docs: DataFrame, model: Model) -> DataFrame:
    """Each row of ``docs`` as a struct, ``document``, and its ``language``.

    ``language`` has ``lang_pred``, ``score``, the mean log probability of an n-gram in
    that language, ``per_gram``, and the number of n-grams, ``grams``. The rows go through the tasks
    whole, so that nothing has to be joined back by ids that may repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    whole = docs.select(F.struct(*docs.columns).alias("document"))
    kind = dict(whole.dtypes)["document"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch["document"]
            text = pc.fill_null(rows.field("text"), "")
            both = pa.record_batch({"document": rows, "text": text})
            for piece in pieces(iter([both]), limit=SCORE_BYTES):
                named, *numbers = shared.value.judge(piece["text"])
                found = pa.StructArray.from_arrays(
                    [pa.array(named, pa.string()), *map(pa.array, numbers)],
                    ["lang_pred", "score", "per_gram", "grams"],
                )
                yield pa.record_batch({"document": piece["document"], "language": found})

    language = "struct<lang_pred: string, score: double, per_gram: double, grams: long>"
    schema = f"document {kind}, language {language}"
    return whole.mapInArrow(run, schema)
