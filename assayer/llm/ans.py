"""Token ids in compressed binary files, coded by a static range ANS.

Asymmetric numeral system with one frequency table for all files. A file holds
the ids of consecutive documents in blocks that are coded independently:

* ``LANES`` states are interleaved in a block: id ``i`` belongs to lane
  ``i % LANES``. Numpy steps all lanes of many blocks at a time.
* Every ``STEPS`` ids per lane there is a checkpoint: the states and the place
  in the block's words, so that decoding can begin there. The decoder uses this
  to run all stretches of a group of blocks side by side.
* Every block has the crc32 of its ids, and is refused if they differ.

File: ``MAGIC``; the header (JSON, length before it); the documents, those without an id
first (ids and
numbers of tokens, as 64-bit integers, zlib); the blocks. The table is a file
of its own, and the header of each file has its crc32.

Defined results: a null text is empty, so that its document has the end id
only; documents with equal ids stand side by side, ordered by a hash of their text; a
null ``doc_id`` comes first; an empty table gives no files and no rows.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.common import (
    binary_rows,
    file_system,
    one_task_each,
    pieces,
    save_file,
    texts,
    written,
)
from assayer.llm.tokens import TEXT_BYTES, word_encoder

MAGIC = b"TOKRANS1"
LANES = 64
STEPS = 256
#: Checkpoints of a block, the one at its start included.
STRETCHES = 4
BLOCK = LANES * STEPS * STRETCHES
#: Blocks that are coded side by side.
GROUP = 32
#: The frequencies of a table add up to two to this power.
SCALE = 20
#: States lie in [LOW, LOW << 32).
LOW = np.uint64(1 << 31)
TABLE_FILE = "table.bin"

_U64 = np.uint64


@dataclass(frozen=True)
class Table:
    """Frequencies that add up to ``1 << SCALE``."""

    freq: np.ndarray  # uint64 by symbol
    low: np.ndarray  # uint64 by symbol: the frequencies before it
    symbol: np.ndarray  # uint32 by slot

    @staticmethod
    def of(freq: np.ndarray) -> Table:
        freq = freq.astype(_U64)
        symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        return Table(freq, np.cumsum(freq) - freq, symbol)

    def to_bytes(self) -> bytes:
        return self.freq.astype("<u4").tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> Table:
        return Table.of(np.frombuffer(data, "<u4"))

    @property
    def crc(self) -> int:
        return zlib.crc32(self.to_bytes())


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of ``1 << SCALE``; what occurs keeps at least 1."""
    total, size = int(counts.sum()), 1 << SCALE
    seen = counts > 0
    if not total:
        return np.zeros(len(counts), np.int64)
    if int(seen.sum()) > size:
        raise ValueError("more symbols than the table has slots")
    freq = np.where(seen, np.maximum(1, counts.astype(float) * size // total), 0)
    freq = freq.astype(np.int64)
    while (over := int(freq.sum()) - size) != 0:
        # The most frequent symbols bear the difference.
        top = np.argsort(-freq, kind="stable")[: max(1, int((freq > 1).sum()))]
        share = np.sign(over) * np.minimum(
            np.maximum(1, abs(over) * freq[top] // max(1, int(freq[top].sum()))),
            np.maximum(0, freq[top] - 1) if over > 0 else abs(over),
        )
        left = np.minimum(np.cumsum(np.abs(share)), abs(over))
        freq[top] -= np.sign(over) * np.diff(left, prepend=0)
    return freq


def encode_blocks(ids: np.ndarray, table: Table) -> list[bytes]:
    """The ids in blocks of ``BLOCK``, coded side by side."""
    count = -(-len(ids) // BLOCK)
    steps = STEPS * STRETCHES
    # The last block is filled up with the id that costs least.
    padded = np.full(count * BLOCK, table.freq.argmax() if count else 0, np.uint32)
    padded[: len(ids)] = ids
    # By step, then block and lane.
    lanes = padded.reshape(count, steps, LANES).transpose(1, 0, 2).reshape(steps, -1)
    state = np.full(count * LANES, LOW, _U64)
    words = np.zeros(lanes.shape, np.uint32)
    wrote = np.zeros(lanes.shape, bool)
    points = np.zeros((STRETCHES, count * LANES), _U64)
    shift, half = _U64(SCALE), _U64(32)
    top = _U64((int(LOW) >> SCALE) << 32)
    for step in range(steps - 1, -1, -1):
        freq = table.freq[lanes[step]]
        full = state >= top * freq
        words[step] = state  # its low 32 bits
        wrote[step] = full
        state = np.where(full, state >> half, state)
        quotient = state // freq
        state = (quotient << shift) + (state - quotient * freq) + table.low[lanes[step]]
        if step % STEPS == 0:
            points[step // STEPS] = state
    words = words.reshape(steps, count, LANES).transpose(1, 0, 2)
    wrote = wrote.reshape(steps, count, LANES).transpose(1, 0, 2)
    points = points.reshape(STRETCHES, count, LANES)
    blocks = []
    for b in range(count):
        own = ids[b * BLOCK : (b + 1) * BLOCK].astype("<u4")
        places = wrote[b].reshape(STRETCHES, -1).sum(1).cumsum()
        head = struct.pack("<IIII", len(own), zlib.crc32(own.tobytes()), places[-1], 0)
        begins = np.concatenate([[0], places[:-1]]).astype("<u4").tobytes()
        states = points[:, b].astype("<u8").tobytes()
        blocks.append(head + begins + states + words[b][wrote[b]].astype("<u4").tobytes())
    return blocks


_HEAD = 16 + 4 * STRETCHES + 8 * STRETCHES * LANES


def decode_blocks(blocks: list[bytes], table: Table) -> list[np.ndarray]:
    """The ids of each block; every stretch of every block is a row of lanes."""
    heads = [struct.unpack_from("<IIII", b) for b in blocks]
    begins = np.stack([np.frombuffer(b, "<u4", STRETCHES, 16) for b in blocks])
    state = np.concatenate(
        [np.frombuffer(b, "<u8", STRETCHES * LANES, 16 + 4 * STRETCHES) for b in blocks]
    ).astype(_U64).reshape(-1, LANES)
    before = np.cumsum([0] + [h[2] for h in heads])
    words = np.concatenate(
        [np.frombuffer(b, "<u4", h[2], _HEAD) for b, h in zip(blocks, heads)] + [[0]]
    ).astype(_U64)
    at = (begins.astype(np.int64) + before[:-1, None]).reshape(-1)
    out = np.zeros((STEPS, len(at), LANES), np.uint32)
    shift, half, mask = _U64(SCALE), _U64(32), _U64((1 << SCALE) - 1)
    last = len(words) - 1
    for step in range(STEPS):
        slot = state & mask
        found = table.symbol[slot]
        out[step] = found
        state = table.freq[found] * (state >> shift) + slot - table.low[found]
        hungry = state < LOW
        rank = np.cumsum(hungry, 1)
        place = np.minimum(at[:, None] + rank - 1, last)
        state = np.where(hungry, (state << half) | words[place], state)
        at = at + rank[:, -1]
    rows = out.transpose(1, 0, 2).reshape(len(blocks), BLOCK)
    decoded = []
    for row, head in zip(rows, heads):
        ids = row[: head[0]]
        if zlib.crc32(ids.astype("<u4").tobytes()) != head[1]:
            raise ValueError("a block's checksum differs")
        decoded.append(ids)
    return decoded


# -- files -----------------------------------------------------------------------


def _raw_name(shard: int) -> str:
    return f"ids-{shard:06d}.zst"


def file_name(shard: int) -> str:
    return f"tokens-{shard:06d}.bin"


def _sized(data: bytes) -> bytes:
    return struct.pack("<Q", len(data)) + data


def _coded_file(
    ids: Iterator[np.ndarray], no_ids: int, doc_ids, lengths, start: int, table: Table
):
    header = {
        "lanes": LANES, "steps": STEPS, "stretches": STRETCHES, "scale": SCALE,
        "table_crc": table.crc, "documents": len(lengths), "start": start,
        "ids": int(lengths.sum()), "no_ids": no_ids,
    }
    yield MAGIC
    yield _sized(json.dumps(header).encode())
    yield _sized(zlib.compress(doc_ids.astype("<i8").tobytes(), 1))
    yield _sized(zlib.compress(lengths.astype("<i8").tobytes(), 1))
    rest = np.zeros(0, np.uint32)
    for more in ids:
        rest = np.concatenate([rest, more])
        whole = len(rest) // (BLOCK * GROUP) * BLOCK * GROUP
        for first in range(0, whole, BLOCK * GROUP):
            yield from map(_sized, encode_blocks(rest[first : first + BLOCK * GROUP], table))
        rest = rest[whole:]
    if len(rest):
        yield from map(_sized, encode_blocks(rest, table))


def _raw_ids(folder: str, shard: int) -> Iterator[np.ndarray]:
    system, path = file_system(folder)
    with system.open_input_stream(f"{path}/{_raw_name(shard)}", compression="zstd") as f:
        odd = b""
        while data := f.read(4 << 20):
            data = odd + data
            whole = len(data) // 4 * 4
            yield np.frombuffer(data[:whole], "<u4").astype(np.uint32)
            odd = data[whole:]


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1
) -> DataFrame:
    """Write the ids of all documents, in ascending order of ``doc_id``.

    First the documents are put in order by range and tokenized once, into raw
    files of their ids, one per range; the numbers of every id are added up
    by Spark to the table that all files share. Then each raw file is coded.
    Returns one row per file: ``shard``, ``file``, ``start`` (ids in the files
    before it), ``ids`` and ``bytes``.
    """
    spark = docs.sparkSession
    raw = f"{folder}/raw"
    schema = (
        "shard int, no_ids long, doc_ids binary, lengths binary, ids long, seen array<int>, "
        "counts array<long>"
    )

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        doc_ids, lengths, no_ids, counts = [], [], 0, np.zeros(0, np.int64)
        cut = pieces(batches, limit=TEXT_BYTES)
        head = next(cut, None)
        if head is None:
            return

        def stream() -> Iterator[bytes]:
            """The ids, compressed; a piece's are handed on before the next is read."""
            nonlocal counts, no_ids
            packer = zstandard.ZstdCompressor(level=1).compressobj()
            for batch in chain([head], cut):
                ids, sizes = word_encoder(tokenizer).encode(batch["text"])
                ids = np.insert(ids, np.cumsum(sizes), np.uint32(end_id))
                lengths.append(sizes + 1)
                no_ids += batch["doc_id"].null_count
                known = batch["doc_id"].fill_null(0)
                doc_ids.append(known.to_numpy(zero_copy_only=False))
                found = np.bincount(ids, minlength=len(counts))
                found[: len(counts)] += counts
                counts = found
                yield packer.compress(ids.astype("<u4").tobytes())
            yield packer.flush()

        save_file(raw, _raw_name(shard), stream())
        sizes = np.concatenate(lengths).astype("<i8")
        seen = np.flatnonzero(counts)
        yield pa.record_batch(
            {
                "shard": pa.array([shard], pa.int32()),
                "no_ids": pa.array([no_ids], pa.int64()),
                "doc_ids": pa.array([np.concatenate(doc_ids).astype("<i8").tobytes()]),
                "lengths": pa.array([sizes.tobytes()]),
                "ids": pa.array([int(sizes.sum())], pa.int64()),
                "seen": pa.array([seen.tolist()], pa.list_(pa.int32())),
                "counts": pa.array([counts[seen].tolist()], pa.list_(pa.int64())),
            }
        )

    # The range bounds are sampled keys: they hold a hash, not the text.
    ordered = texts(docs).repartitionByRange("doc_id", F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    shards = written(spark, ordered.mapInArrow(tokenize, schema), "shards")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.asarray(batch["seen"].flatten())
            found = np.bincount(ids, np.asarray(batch["counts"].flatten()), len(total))
            found = found.astype(np.int64)
            found[: len(total)] += total
            total = found
        seen = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(seen, pa.int32()), "n": pa.array(total[seen])})

    # One row per id of the vocabulary and one small row per file.
    each = shards.select("seen", "counts").mapInArrow(add_up, "id int, n long")
    totals = each.groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r["id"] for r in totals], default=-1) + 1, np.int64)
    for row in totals:
        counts[row["id"]] = row["n"]
    table = Table.of(scaled_frequencies(counts))
    save_file(folder, TABLE_FILE, iter([table.to_bytes()]))
    sizes = sorted((r["shard"], r["ids"]) for r in shards.select("shard", "ids").collect())
    starts = dict(zip([s for s, _ in sizes], np.cumsum([0] + [n for _, n in sizes]).tolist()))
    packed = table.to_bytes()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Table.from_bytes(packed)
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                lengths = np.frombuffer(row["lengths"], "<i8")
                doc_ids = np.frombuffer(row["doc_ids"], "<i8")
                parts = _coded_file(
                    _raw_ids(raw, shard), row["no_ids"], doc_ids, lengths, starts[shard], own
                )
                size = save_file(folder, file_name(shard), parts)
                yield pa.record_batch(
                    {
                        "shard": pa.array([shard], pa.int32()),
                        "file": pa.array([file_name(shard)]),
                        "start": pa.array([starts[shard]], pa.int64()),
                        "ids": pa.array([row["ids"]], pa.int64()),
                        "bytes": pa.array([size], pa.int64()),
                    }
                )

    columns = shards.select("shard", "no_ids", "doc_ids", "lengths", "ids")
    spread = columns.repartitionByRange(max(1, len(sizes)), "shard")
    files = spread.mapInArrow(code, "shard int, file string, start long, ids long, bytes long")
    return written(spark, files, "files")


def read_ids(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The documents in the files: ``doc_id``, ``start``, ``n_tokens``, ``ids``.

    ``ids`` holds little-endian unsigned 32-bit integers. One task reads one
    file, from its own header and the shared table.
    """
    names = [r["file"] for r in files.select("file").orderBy("file").collect()]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        with system.open_input_stream(f"{path}/{TABLE_FILE}") as f:
            table = Table.from_bytes(f.read())
        for batch in batches:
            for shard in batch["shard"].to_pylist():
                if shard < len(names):
                    with system.open_input_stream(f"{path}/{names[shard]}") as f:
                        yield from _documents(f, table)

    schema = "doc_id long, start long, n_tokens long, ids binary"
    return one_task_each(spark, len(names)).mapInArrow(decode, schema)


def _documents(f, table: Table) -> Iterator[pa.RecordBatch]:
    if f.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a file of token ids")

    def sized() -> bytes:
        head = f.read(8)
        return f.read(struct.unpack("<Q", head)[0]) if head else b""

    header = json.loads(sized())
    if header["table_crc"] != table.crc:
        raise ValueError("the file was coded by another table")
    doc_ids = np.frombuffer(zlib.decompress(sized()), "<i8")
    lengths = np.frombuffer(zlib.decompress(sized()), "<i8")
    ends = np.cumsum(lengths)
    done, taken, rest = 0, 0, np.zeros(0, np.uint32)
    while True:
        blocks = [b for b in (sized() for _ in range(GROUP)) if b]
        if blocks:
            rest = np.concatenate([rest, *decode_blocks(blocks, table)])
        last = int(np.searchsorted(ends, taken + len(rest), "right"))
        if last > done:
            size = int(ends[last - 1]) - taken
            own = lengths[done:last]
            yield pa.record_batch(
                {
                    "doc_id": pa.array(
                        doc_ids[done:last],
                        pa.int64(),
                        # Documents without an id come first.
                        mask=np.arange(done, last) < header["no_ids"],
                    ),
                    "start": pa.array(header["start"] + ends[done:last] - own),
                    "n_tokens": pa.array(own),
                    "ids": binary_rows(rest[:size].astype("<u4"), own),
                }
            )
            rest, taken, done = rest[size:], taken + size, last
        if len(blocks) < GROUP:
            break
    if done != len(lengths):
        raise ValueError("the file ends before its last document")
