"""Embedding whitening: components from a covariance that Spark adds up.

Three passes over the vectors, none of which moves a row: exact sums per
dimension, the covariance around the exact mean, and the whitened vectors. A task
sends one number per pair of dimensions, Spark adds them up, and the driver, which
gets one matrix, splits it by ``qdwh``. Mean and components are as large as the
number of dimensions says, whatever the number of rows, and go to all tasks.

Entries are whole numbers: ``x = floor(scale * c) + offset``, as 64-bit integers.

Defined results: a vector that is null, holds a null, NaN or infinite entry, or one of
more than 2^56 in magnitude (no 64-bit integer could hold its ``x``) is dropped. So is one
that has not as many dimensions as most have (of two lengths that are as frequent, the
longer counts). Repeated rows and null ids are rows like any other. Components along which
the vectors do not vary (eigenvalue below 1e-11 of the largest) can't be whitened and are
left out, so that equal vectors give no rows; neither does an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from assayer.llm.common import reach_workers
from assayer.llm.qdwh import components

#: Fixed values of the whole numbers that entries become.
SCALE = 64
OFFSET = 1_000_000

LARGEST = float(1 << 56)
#: Components with less than this share of the largest eigenvalue are left out.
LEAST_SHARE = 1e-11
#: Entries that are looked at at a time.
PIECE_ENTRIES = 1 << 18

Reader = Callable[[pa.RecordBatch], tuple[pa.RecordBatch, np.ndarray]]


@dataclass(frozen=True)
class Whitening:
    """What was learned from the vectors: small, and the same for all rows."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, as columns
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centre(x, self.n, self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2, null beyond 64 bits."""
        near = (self.centred(x) * self.n) ** 2
        rough = near.sum(axis=1)
        # Modulo 2^64 this is right wherever the result fits.
        wrap = np.array([s & (2**64 - 1) for s in self.sums], np.uint64)
        d = x.astype(np.uint64) * np.uint64(self.n & (2**64 - 1)) - wrap
        exact = (d * d).sum(axis=1, dtype=np.uint64).astype(np.int64).tolist()
        for i in np.flatnonzero(rough > 0.99 * 2.0**63):
            whole = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i], self.sums))
            exact[i] = whole if whole < 2**63 else None
        return exact


def centre(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - S / n``, rounded once: the whole part of the mean goes first."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole) - rest


def usable(vector: str):
    """Whether a vector can be used, as a condition on its column."""
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= LARGEST, F.lit(False)))
    return F.coalesce(fits, F.lit(False)) & (F.size(vector) > 0)


def whole_numbers(column: pa.Array) -> np.ndarray:
    """The entries of usable vectors as whole numbers, one row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(SCALE * flat).astype(np.int64) + OFFSET
    return x.reshape(len(column), -1)


def _pieces(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    size = max(1, PIECE_ENTRIES // dims)
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def _sums(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        for batch in _pieces(batches, dims):
            x = whole_numbers(batch["vector"])
            # Two halves, so that no sum of a task can overflow.
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            n += len(x)
        if n:
            columns = [np.arange(dims), high, low, np.full(dims, n)]
            yield pa.record_batch([pa.array(c) for c in columns], ["dim", "high", "low", "n"])

    exact = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low", "n")]
    found = rows.mapInArrow(add, "dim long, high long, low long, n long")
    totals = sorted(found.groupBy("dim").agg(*exact).collect(), key=lambda r: r["dim"])
    return int(totals[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in totals]


def _gram(rows: DataFrame, dims: int, side: int, of: Callable[[np.ndarray], np.ndarray]):
    """The sum over rows of the outer product of ``of`` their numbers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((side, side))
        for batch in _pieces(batches, dims):
            made = of(whole_numbers(batch["vector"]))
            total += made.T @ made
        i, j = np.triu_indices(side)
        yield pa.record_batch(
            [pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "value"]
        )

    found = rows.mapInArrow(add, "i long, j long, value double")
    out = np.zeros((side, side))
    for row in found.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["value"]
    return out


def usable_rows(table: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Id and vector of the rows that count, and their number of dimensions."""
    reach_workers(table.sparkSession)
    rows = table.where(usable(vector)).select("vec_id", F.col(vector).alias("vector"))
    lengths = rows.groupBy(F.size("vector").alias("dims")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = most[0]["dims"] if most else 0
    return rows.where(F.size("vector") == dims), dims


def fit(rows: DataFrame, dims: int, most: int) -> Whitening:
    """Mean and components of all rows."""
    n, sums = _sums(rows, dims)
    covariance = _gram(rows, dims, dims, lambda x: centre(x, n, sums)) / n
    values, vectors = components(covariance, most)
    varies = values > LEAST_SHARE * values.max(initial=0)
    return Whitening(
        n, sums, values[varies], vectors[:, varies], float(np.trace(covariance))
    )


def identity_error(rows: DataFrame, dims: int, model: Whitening) -> float:
    """How far the covariance of all whitened rows is from the identity."""
    side = len(model.values)
    if not side:
        return 0.0
    measured = _gram(rows, dims, side, model.project) / model.n
    return float(np.abs(measured - np.eye(side)).max())


def whiten(table: DataFrame, vector: str = "embedding", most: int = 32) -> DataFrame:
    """One row per vector and component: ``vec_id``, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    fields = (
        "component int, n long, deviation long, whitened double, explained double,"
        " identity_error double"
    )
    schema = StructType([StructField("vec_id", LongType())])
    schema = StructType([*schema, *StructType.fromDDL(fields)])
    rows, dims = usable_rows(table, vector)
    if not dims:
        return table.sparkSession.createDataFrame([], schema)
    model = fit(rows, dims, most)
    error = identity_error(rows, dims, model)
    side = len(model.values)
    explained = model.values / model.trace if side else model.values

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, dims):
            x = whole_numbers(batch["vector"])
            m = len(x)
            rows_of = np.repeat(np.arange(m), side)
            yield pa.record_batch(
                [
                    batch["vec_id"].take(pa.array(rows_of)),
                    pa.array(np.tile(np.arange(1, side + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * side, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(rows_of)),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * side, error)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(apply, schema)
