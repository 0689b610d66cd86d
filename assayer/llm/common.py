"""Small helpers the operators share: columns, Arrow batches, shared files."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.session import new_workspace, reach_workers

#: Bytes of text that a kernel takes at a time; longer batches are cut between
#: documents (one document is never cut).
PIECE_BYTES = 8 << 20


def texts(docs: DataFrame, *others: str) -> DataFrame:
    """Only ``doc_id``, ``text`` (null becomes empty) and ``others``.

    Choosing columns here keeps any further column, whatever its name, away
    from the columns an operator adds.
    """
    reach_workers(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *others)


def crc_mod(column: str | Column, divisor: int) -> Column:
    """crc32 of a number written as text, modulo ``divisor`` (null: null)."""
    value = F.col(column) if isinstance(column, str) else column
    return F.crc32(value.cast("string").cast("binary")) % divisor


def give_back() -> None:
    """Hand free memory back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):  # not glibc
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut between rows so that ``column`` has about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last
    give_back()


def per_piece(
    kernel: Callable[[pa.RecordBatch], pa.RecordBatch],
    column: str = "text",
    limit: int = PIECE_BYTES,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that applies ``kernel`` piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, column, limit):
            yield kernel(piece)

    return run


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a string column in order, and where each row's words begin.

    Words are what stands between ASCII white space (x20, x09 to x0D). The
    second result has one entry more than there are rows.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(column))
    words = lists.flatten()
    ends = lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    blank = pc.equal(words, "")  # a row without words gives one empty string
    if pc.any(blank).as_py():
        keep = pc.invert(blank)
        kept = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
        return words.filter(keep), kept[ends]
    return words, ends


def gather_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``starts[i] .. starts[i] + lengths[i] - 1``, one after another."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def binary_rows(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column: ``flat`` cut into rows of ``lengths`` items each."""
    ends = np.concatenate([[0], np.cumsum(lengths * flat.itemsize)]).astype(np.int64)
    data = pa.py_buffer(np.ascontiguousarray(flat))
    rows = pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), data]
    )
    return rows.cast(pa.binary()) if ends[-1] < 2**31 else rows


# -- tables and files in the shared folder -------------------------------------


def written(
    spark: SparkSession, frame: DataFrame, purpose: str, codec: str = "snappy"
) -> DataFrame:
    """The frame as a table in the shared folder, read again.

    This cuts the lineage: a lost executor costs no more than the tasks it ran,
    and what is random or costly is settled once.
    """
    folder = new_workspace(spark, f"llm-{purpose}")
    frame.write.mode("overwrite").option("compression", codec).parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def as_uri(folder: str) -> str:
    if "://" in folder or folder.startswith("file:"):
        return folder.replace("s3a://", "s3://", 1)
    return f"file://{folder}"


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    uri = as_uri(folder)
    if uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:").removeprefix("//")
    return pafs.FileSystem.from_uri(uri)


def save_file(folder: str, name: str, chunks: Iterator[bytes]) -> int:
    """Write a file that appears under its name only when it is complete.

    A repeated task writes the same content and replaces the file.
    """
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    hidden = f"{path}/_{name}.{uuid.uuid4().hex}"
    size = 0
    with system.open_output_stream(hidden, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    system.move(hidden, f"{path}/{name}")
    return size


def one_task_each(spark: SparkSession, count: int) -> DataFrame:
    """A frame with the numbers 0 to count - 1 in ``shard``, one per task."""
    return spark.range(0, count, 1, max(1, count)).withColumnRenamed("id", "shard")
