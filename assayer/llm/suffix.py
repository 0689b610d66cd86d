"""Repeated passages by merged Burrows-Wheeler transforms.

Removed is each byte that lies in a string of ``LENGTH`` bytes which also starts
earlier: in a document with a smaller ``doc_id``, or before in the same one.

A window is a string of ``LENGTH`` bytes. Its anchor is the place of the least
hash of its ``GRAM``-byte strings, so that equal windows have equal anchors at
equal distances. Windows that share an anchor and lie within ``CELL`` bytes form
a unit: all of them contain the unit's core, and all lie in its reach. This is
how the work is dealt to tasks without losing a pair of equal windows:

1. Texts are cut into blocks, the shards; a block is a file in the shared folder.
2. Anchors whose hash occurs once in all blocks are dropped.
3. Of the units around the others, those whose reach is equal to that of an
   earlier unit are repeats as a whole; those whose core occurs with one reach
   only are repeats of nothing.
4. The rest, units with an equal core and different reaches, are dealt by core.
   Each task makes the transforms of its shards' reaches, merges them by
   refining their interleave for ``LENGTH`` rounds and so gets the common
   prefixes. Entries with ``LENGTH`` symbols in common are an interval of equal
   windows, and all but the earliest of it are repeats.
5. Back in their blocks, the windows that are repeats are joined to spans.

Questions to other blocks (2 and 3) are dealt by hash, and a block asks only
once for equal things, so that a passage of very many documents makes no hot
group: a group never has more rows than there are blocks. A core with more than
``HOT`` reaches would still be one large group in 4; its windows are compared
one by one instead, each dealt by its own hash.

Equality in 2 and 3 is that of 64-bit and 128-bit hashes, in 4 that of bytes.

Defined results: a null text is empty; documents of fewer than ``LENGTH`` bytes
lose nothing; among rows with equal ``doc_id`` the order is that of the written
blocks, a null ``doc_id`` comes after all others, and of equal rows all but one
are repeats; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from assayer.llm import bwt
from assayer.llm.common import (
    binary_rows,
    file_system,
    gather_ranges,
    give_back,
    pieces,
    reach_workers,
    save_file,
    written,
)
from assayer.session import new_workspace

LENGTH = 100
GRAM = 24
CELL = 20
#: Windows whose anchors are among the same ``LENGTH - GRAM + 1`` places.
SPAN = LENGTH - GRAM + 1
CORE = LENGTH - CELL + 1

BLOCK_BYTES = 8 << 20
#: Windows hashed at a time, so that the arrays stay in the processor's cache.
CHUNK = 1 << 17
#: Strings of a block hashed at a time.
HASHED = 1 << 14
#: Text of a bucket of questions, and of one of merged shards.
ASK_BYTES = 4 << 20
MERGE_BYTES = 2 << 20
LEAST_BUCKETS = 64
MOST_BUCKETS = 1 << 20
#: Text that a task takes, or its messages.
TASK_BYTES = 16 << 20
#: Bytes of reaches in a shard.
SHARD_BYTES = 1 << 16
#: Reaches of a core that are merged in one task.
HOT = 4096

_LAST = np.int64(2**63 - 1)
_MIX = [
    np.uint64(x)
    for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
]


# -- anchors -------------------------------------------------------------------------


def _mixed(word: np.ndarray) -> np.ndarray:
    word = word ^ (word >> np.uint64(32))
    word *= _MIX[0]
    word ^= word >> np.uint64(29)
    return word


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on."""
    count = len(data) - GRAM + 1
    if count <= 0:
        return np.zeros(0, np.uint64)

    def words(first: int) -> np.ndarray:
        return _mixed(np.ndarray((count,), "<u8", data, first, (1,)))

    found = words(0) * _MIX[1]
    found += words(8)
    found *= _MIX[2]
    found += words(16)
    found ^= found >> np.uint64(31)
    found *= _MIX[3]
    found ^= found >> np.uint64(32)
    return found


@dataclass(frozen=True)
class Anchors:
    """Anchors and the windows they are the anchor of: ``first`` to ``last``.

    ``hashes`` tell the anchors' strings apart.
    """

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hashes: np.ndarray


def anchors(data: np.ndarray, lengths: np.ndarray) -> Anchors:
    """The anchors of all windows of documents that lie one after another."""
    ends = np.cumsum(lengths)
    windows = np.maximum(lengths - LENGTH + 1, 0)
    stops = np.stack([ends - lengths, ends - lengths + windows], 1)[windows > 0]
    found: list[list[np.ndarray]] = [[], [], [], []]
    low = np.uint64((1 << 24) - 1)
    for begin in range(0, len(data) - LENGTH + 1, CHUNK):
        part = np.ascontiguousarray(data[begin : begin + CHUNK + LENGTH - 1])
        hashes = gram_hashes(part)
        # The leftmost of the least: a place in the low bits, below the hash.
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        reach = 1
        while 2 * reach <= SPAN:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < SPAN:
            least = np.minimum(least[: len(least) - (SPAN - reach)], least[SPAN - reach :])
        at = (least & low).astype(np.int64)
        own = stops - begin
        own = np.clip(own[(own[:, 1] > 0) & (own[:, 0] < len(at))], 0, len(at))
        place = gather_ranges(own[:, 0], own[:, 1] - own[:, 0])
        if not len(place):
            continue
        at = at[place]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (place[1:] != place[:-1] + 1)
        start = np.flatnonzero(new)
        stop = np.concatenate([start[1:], [len(at)]]) - 1
        for column, values in zip(
            found, (at[start] + begin, place[start] + begin, place[stop] + begin, hashes[at[start]])
        ):
            column.append(values)
    if not found[0]:
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, np.zeros(0, np.uint64))
    at, first, last, hashes = (np.concatenate(column) for column in found)
    # Runs that a chunk's end has cut in two.
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (first[1:] != last[:-1] + 1)
    start = np.flatnonzero(new)
    stop = np.concatenate([start[1:], [len(at)]]) - 1
    # The least of many hashes are small numbers; a product spreads them over buckets.
    return Anchors(at[start], first[start], last[stop], hashes[start] * _MIX[1])


# -- units ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Units:
    """Units of a block, by place; ``begin`` to ``stop`` is the reach.

    ``first`` to ``last`` are the windows that the unit stands for. ``core`` and
    ``reach`` are hashes.
    """

    begin: np.ndarray
    stop: np.ndarray
    first: np.ndarray
    last: np.ndarray
    row: np.ndarray
    core: np.ndarray
    reach: np.ndarray

    def __len__(self) -> int:
        return len(self.begin)


def units(data: bytes, lengths: np.ndarray, found: Anchors) -> Units:
    """The units of the windows of some anchors."""
    near, far = (found.at - found.last) // CELL, (found.at - found.first) // CELL
    count = far - near + 1
    which = np.repeat(np.arange(len(count)), count)
    cell = gather_ranges(near, count)
    at = found.at[which]
    # Windows of the cell begin CELL * cell to CELL * cell + CELL - 1 before the anchor.
    top = at - CELL * cell
    first = np.maximum(found.first[which], top - CELL + 1)
    last = np.minimum(found.last[which], top)
    ends = np.cumsum(lengths)
    row = np.searchsorted(ends, first, "right")
    begin = np.maximum(top - CELL + 1, (ends - lengths)[row])
    stop = np.minimum(top + LENGTH, ends[row])
    # The seeds keep units of other anchors apart, and other places in the reach.
    core = _digests(data, top, top + CORE, cell)
    reach = _digests(data, begin, stop, CELL * cell + begin - (top - CELL + 1))
    return Units(begin, stop, first, last, row, core, reach)


def _digests(data: bytes, begin: np.ndarray, stop: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Hashes of strings of a block; Python's numbers for a part of them at a time."""
    digest = xxhash.xxh3_64_intdigest
    made = np.empty(len(begin), np.uint64)
    for a in range(0, len(begin), HASHED):
        part = slice(a, a + HASHED)
        asked = zip(begin[part].tolist(), stop[part].tolist(), seed[part].tolist())
        made[part] = np.fromiter((digest(data[b:s], c) for b, s, c in asked), np.uint64)
    return made


# -- questions and answers between blocks ---------------------------------------------

#: What a block asks: is the hash in another block (REPEATED); is the thing with
#: these two hashes earlier in another block (EARLIER); how many reaches has the
#: core in all blocks (REACHES).
REPEATED, EARLIER, REACHES = 0, 1, 2
_ASKED = {
    REPEATED: np.dtype([("key", "<u8")]),
    EARLIER: np.dtype([("key", "<u8"), ("other", "<u8"), ("doc", "<i8")]),
    REACHES: np.dtype([("key", "<u8"), ("least", "<u8"), ("most", "<u8"), ("count", "<i4")]),
}
ONE, SOME, MANY = 0, 1, 2

MESSAGE = "kind int, bucket int, block long, data binary"


def _ask(block: int, kind: int, asked: np.ndarray, bits: int) -> Iterator[dict]:
    """Messages, one per bucket; ``asked`` is in the order of its key."""
    bucket = (asked["key"] >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    for a, b in zip(edges.tolist(), edges.tolist()[1:] + [len(asked)]):
        if b > a:
            yield {
                "kind": kind, "bucket": int(bucket[a]), "block": block,
                "data": asked[a:b].tobytes(),
            }


def _answers(kind: int, blocks: np.ndarray, asked: np.ndarray, hot: int) -> np.ndarray:
    """An answer (0 to 255) to each thing asked, which is in the order asked."""
    if kind == REPEATED:
        _, which, count = np.unique(asked["key"], return_inverse=True, return_counts=True)
        return (count > 1)[which].astype(np.uint8)
    if kind == EARLIER:
        order = np.lexsort((blocks, asked["doc"], asked["other"], asked["key"]))
        one = asked[order]
        again = np.zeros(len(asked), bool)
        same = (one["key"][1:] == one["key"][:-1]) & (one["other"][1:] == one["other"][:-1])
        again[order[1:]] = same
        return again.astype(np.uint8)
    _, which = np.unique(asked["key"], return_inverse=True)
    count = np.bincount(which, asked["count"])
    least = np.full(len(count), np.uint64(2**64 - 1))
    most = np.zeros(len(count), np.uint64)
    np.minimum.at(least, which, asked["least"])
    np.maximum.at(most, which, asked["most"])
    answer = np.where(least == most, ONE, np.where(count > hot, MANY, SOME))
    return answer[which].astype(np.uint8)


def _answer_bucket(rows: pa.Table, hot: int) -> pa.Table:
    kind, bucket = rows["kind"][0].as_py(), rows["bucket"][0].as_py()
    data = rows["data"].to_pylist()
    asked = [np.frombuffer(d, _ASKED[kind]) for d in data]
    sizes = [len(a) for a in asked]
    blocks = np.repeat(rows["block"].to_numpy(), sizes)
    answers = _answers(kind, blocks, np.concatenate(asked), hot).tobytes()
    ends = np.cumsum([0] + sizes).tolist()
    return pa.table(
        {
            "kind": pa.array([kind] * len(sizes), pa.int32()),
            "bucket": pa.array([bucket] * len(sizes), pa.int32()),
            "block": rows["block"],
            "data": pa.array([answers[a:b] for a, b in zip(ends, ends[1:])], pa.binary()),
        }
    )


def _kept(rows: pa.Table, folder: str) -> pa.Table:
    """Write what has come back for a block, in the order it was asked."""
    block = rows["block"][0].as_py()
    ordered = rows.sort_by([("kind", "ascending"), ("bucket", "ascending")])
    parts: dict[int, list[bytes]] = {}
    for kind, data in zip(ordered["kind"].to_pylist(), ordered["data"].to_pylist()):
        parts.setdefault(kind, []).append(data)
    joined = [b"".join(parts.get(kind, [])) for kind in range(4)]
    head = np.array([len(j) for j in joined], "<i8").tobytes()
    size = save_file(folder, f"block-{block:016x}", iter([head + zlib.compress(b"".join(joined), 1)]))
    return pa.table({"block": pa.array([block], pa.int64()), "bytes": pa.array([size], pa.int64())})


def _come_back(spark: SparkSession, messages: DataFrame, folder: str) -> None:
    """Deal messages to their blocks, where they are written to a file each."""
    kept = messages.groupBy("block").applyInArrow(
        lambda rows: _kept(rows, folder), "block long, bytes long"
    )
    written(spark, kept, "kept")


def _read_back(folder: str, block: int) -> list[bytes]:
    """What came back for a block by kind; nothing if it has asked nothing."""
    system, path = file_system(folder)
    name = f"{path}/block-{block:016x}"
    if system.get_file_info(name).size is None:
        return [b""] * 4
    with system.open_input_stream(name, compression=None) as f:
        data = f.read()
    sizes = np.frombuffer(data, "<i8", 4)
    body = zlib.decompress(data[32:])
    ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    return [body[a:b] for a, b in zip(ends, ends[1:])]


# -- what a block works out -------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    number: int
    docs: np.ndarray  # doc_id, the largest number for null
    lengths: np.ndarray
    data: bytes

    @property
    def array(self) -> np.ndarray:
        return np.frombuffer(self.data, np.uint8)


def _each_block(
    batches: Iterator[pa.RecordBatch], folder: str
) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """The listed blocks, one at a time, and their columns."""
    for batch in batches:
        for number, name in zip(batch["block"].to_pylist(), batch["file"].to_pylist()):
            row = _load_columns(folder, name)
            yield (
                row,
                Block(
                    number,
                    row["docs"][0].values.fill_null(_LAST).to_numpy(zero_copy_only=False),
                    np.asarray(row["lengths"][0].values).astype(np.int64),
                    row["data"][0].as_py(),
                ),
            )
    give_back()


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True, return_counts=True)


def _first_questions(block: Block) -> np.ndarray:
    found = np.unique(anchors(block.array, block.lengths).hashes)
    return found.view(_ASKED[REPEATED])


def _likely(block: Block, answers: bytes) -> Units:
    """The units of anchors whose hash occurs again, in this block or another."""
    found = anchors(block.array, block.lengths)
    _, which, count = _distinct(found.hashes)
    elsewhere = np.frombuffer(answers, np.uint8)
    again = ((elsewhere > 0) | (count > 1))[which]
    chosen = Anchors(
        found.at[again], found.first[again], found.last[again], found.hashes[again]
    )
    return units(block.data, block.lengths, chosen)


@dataclass(frozen=True)
class Firsts:
    """Equal units of a block count once; ``unit`` is the earliest of them."""

    unit: np.ndarray  # in the order of (reach, core)
    whose: np.ndarray  # for every unit, its place in ``unit``


def _firsts(found: Units, docs: np.ndarray) -> Firsts:
    order = np.lexsort((found.first, docs[found.row], found.core, found.reach))
    core, reach = found.core[order], found.reach[order]
    new = np.ones(len(order), bool)
    new[1:] = (core[1:] != core[:-1]) | (reach[1:] != reach[:-1])
    whose = np.empty(len(order), np.int64)
    whose[order] = np.cumsum(new) - 1
    return Firsts(order[new], whose)


def _second_questions(block: Block, found: Units) -> dict[int, np.ndarray]:
    firsts = _firsts(found, block.docs)
    one = firsts.unit
    earlier = np.empty(len(one), _ASKED[EARLIER])
    earlier["key"], earlier["other"] = found.reach[one], found.core[one]
    earlier["doc"] = block.docs[found.row[one]]
    order = np.lexsort((found.reach[one], found.core[one]))
    core, reach = found.core[one][order], found.reach[one][order]
    starts = np.flatnonzero(np.concatenate([[True], core[1:] != core[:-1]])[: len(core)])
    reaches = np.empty(len(starts), _ASKED[REACHES])
    if len(starts):
        stops = np.concatenate([starts[1:], [len(core)]])
        reaches["key"], reaches["least"] = core[starts], reach[starts]
        reaches["most"], reaches["count"] = reach[stops - 1], stops - starts
    return {EARLIER: earlier, REACHES: reaches}


@dataclass(frozen=True)
class Sorted:
    """The units of a block by what is known of them."""

    repeats: np.ndarray  # repeats as a whole
    merge: np.ndarray  # to be merged with those of an equal core
    single: np.ndarray  # to be compared window by window


def _sort_units(block: Block, found: Units, answers: list[bytes]) -> Sorted:
    firsts = _firsts(found, block.docs)
    again = np.frombuffer(answers[EARLIER], np.uint8) > 0
    cores, which = np.unique(found.core, return_inverse=True)
    reaches = np.frombuffer(answers[REACHES], np.uint8)[which]
    is_first = np.zeros(len(found), bool)
    is_first[firsts.unit] = True
    repeats = ~is_first | again[firsts.whose]
    return Sorted(
        np.flatnonzero(repeats),
        np.flatnonzero(~repeats & (reaches == SOME)),
        np.flatnonzero(~repeats & (reaches == MANY)),
    )


def _single_windows(block: Block, found: Units, single: np.ndarray) -> tuple[np.ndarray, ...]:
    """All windows of some units: where, two hashes of each, and the order by hash."""
    at = gather_ranges(found.first[single], found.last[single] - found.first[single] + 1)
    data, places = block.data, at.tolist()
    digest = xxhash.xxh3_128_intdigest
    both = [digest(data[p : p + LENGTH]) for p in places]
    key = np.array([b >> 64 for b in both], np.uint64)
    other = np.array([b & (2**64 - 1) for b in both], np.uint64)
    row = np.searchsorted(np.cumsum(block.lengths), at, "right")
    return at, key, other, block.docs[row], np.lexsort((at, block.docs[row], other, key))


def _window_questions(block: Block, found: Units, single: np.ndarray) -> np.ndarray:
    at, key, other, docs, order = _single_windows(block, found, single)
    new = np.ones(len(order), bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (other[order[1:]] != other[order[:-1]])
    one = order[new[: len(order)]]
    asked = np.empty(len(one), _ASKED[EARLIER])
    asked["key"], asked["other"], asked["doc"] = key[one], other[one], docs[one]
    return asked


def _repeated_windows(
    block: Block, found: Units, single: np.ndarray, answers: bytes
) -> np.ndarray:
    at, key, other, _, order = _single_windows(block, found, single)
    new = np.ones(len(order), bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (other[order[1:]] != other[order[:-1]])
    again = np.frombuffer(answers, np.uint8) > 0
    whose = np.cumsum(new) - 1
    return at[order[~new | again[whose]]] if len(order) else at


# -- merging --------------------------------------------------------------------------

#: Units sent to be merged; their bytes follow. ``place`` is where the reach begins.
_SENT = np.dtype([("doc", "<i8"), ("place", "<i8"), ("length", "<i4")])
MERGE = 3


def _to_merge(block: Block, found: Units, merge: np.ndarray, bits: int) -> Iterator[dict]:
    """Messages with the reaches of units, by bucket of their core."""
    order = merge[np.argsort(found.core[merge], kind="stable")]
    bucket = (found.core[order] >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)])
    for a, b in zip(edges.tolist(), edges.tolist()[1:] + [len(order)]):
        some = order[a:b]
        sent = np.empty(len(some), _SENT)
        sent["doc"], sent["place"] = block.docs[found.row[some]], found.begin[some]
        sent["length"] = found.stop[some] - found.begin[some]
        text = b"".join(
            block.data[x:y] for x, y in zip(found.begin[some].tolist(), found.stop[some].tolist())
        )
        head = len(some).to_bytes(8, "little")
        yield {
            "kind": MERGE, "bucket": int(bucket[a]), "block": block.number,
            "data": head + sent.tobytes() + text,
        }


def _shards(data: np.ndarray, lengths: np.ndarray) -> list[bwt.Shard]:
    """Shards of about ``SHARD_BYTES``."""
    ends = np.cumsum(lengths)
    made, first = [], 0
    while first < len(lengths):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + SHARD_BYTES, "right")))
        made.append(bwt.shard(data[before : int(ends[last - 1])], lengths[first:last]))
        first = last
    return made


def _merge_bucket(rows: pa.Table) -> pa.Table:
    """The places of windows that are repeats, to each of the blocks."""
    shards: list[bwt.Shard] = []
    sent, blocks = [], []
    for block, data in zip(rows["block"].to_pylist(), rows["data"].to_pylist()):
        count = int.from_bytes(data[:8], "little")
        head = np.frombuffer(data, _SENT, count, 8)
        text = np.frombuffer(data, np.uint8, -1, 8 + head.nbytes)
        shards += _shards(text, head["length"].astype(np.int64))
        sent.append(head)
        blocks.append(np.full(count, block))
    told, owner = np.concatenate(sent), np.concatenate(blocks)
    merged = bwt.merge(shards, LENGTH)
    string, group = merged.string, merged.group
    place = told["place"][string] + merged.offset
    whose = owner[string]
    order = np.lexsort((place, whose, told["doc"][string], group))
    group, whose, place = group[order], whose[order], place[order]
    # The first of its group is the earliest. A window may lie in the reach of two
    # units; it is no repeat of itself.
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    earliest = np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))
    again = (whose != whose[earliest]) | (place != place[earliest])
    found, whose = place[again], whose[again]
    back = []
    for block in np.unique(whose).tolist():
        places = np.unique(found[whose == block])
        back.append((block, places.astype("<i8").tobytes()))
    return pa.table(
        {
            "kind": pa.array([MERGE] * len(back), pa.int32()),
            "bucket": pa.array([rows["bucket"][0].as_py()] * len(back), pa.int32()),
            "block": pa.array([b for b, _ in back], pa.int64()),
            "data": pa.array([d for _, d in back], pa.binary()),
        }
    )


# -- all of it --------------------------------------------------------------------------


def _messages(rows: Iterator[dict]) -> pa.RecordBatch:
    schema = pa.schema(
        [("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("data", pa.binary())]
    )
    return pa.RecordBatch.from_pylist(list(rows), schema)


def _sending(work: Callable[[Block], Iterator[dict]], folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in _each_block(batches, folder):
            batch = _messages(work(block))
            if batch.num_rows:
                yield batch

    return run


LISTED = "block long, bytes long, file string"


def _blocks(chosen: DataFrame, folder: str, block_bytes: int) -> list[Row]:
    """The blocks, each in a file of the shared folder; the column ``carried``, if
    there is one, travels in the file too.

    Tasks read the files themselves. As rows of a table, blocks would be held
    many at once: Parquet's writer looks at the size of its rows after 100 rows
    for the first time, and its reader takes all rows of a row group together.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(pieces(batches, limit=block_bytes)):
            raw = [t.encode() for t in batch["text"].to_pylist()]
            columns = {
                "docs": _one_list(batch["doc_id"]),
                "lengths": _one_list(pa.array([len(t) for t in raw], pa.int64())),
                "data": pa.array([b"".join(raw)], pa.binary()),
            }
            if "carried" in batch.schema.names:
                columns["carried"] = _one_list(batch["carried"])
            # Another attempt of the task writes other files, should its rows come
            # in another order.
            name = f"block-{base + number:016x}-{uuid.uuid4().hex}"
            save_file(folder, name, iter([_packed(pa.record_batch(columns))]))
            listed = [[base + number], [sum(map(len, raw))], [name]]
            yield pa.record_batch(
                [pa.array(c) for c in listed], names=["block", "bytes", "file"]
            )

    return chosen.mapInArrow(make, LISTED).collect()


def _packed(columns: pa.RecordBatch) -> pa.Buffer:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3), use_threads=False)
    with pa.ipc.new_stream(sink, columns.schema, options=options) as out:
        out.write_batch(columns)
    return sink.getvalue()


def _load_columns(folder: str, name: str) -> pa.RecordBatch:
    system, path = file_system(folder)
    with system.open_input_stream(f"{path}/{name}", compression=None) as f:
        options = pa.ipc.IpcReadOptions(use_threads=False)
        return pa.ipc.open_stream(f, options=options).read_next_batch()


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _bits(size: int, each: int) -> int:
    """Bits of a number of buckets that follows the size of the input."""
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, size // each)).bit_length() - 1


def _dealt(messages: DataFrame, size: int) -> DataFrame:
    """Messages dealt by bucket to tasks whose number follows the size of the input."""
    return messages.repartition(_tasks(size), "kind", "bucket")


def _tasks(size: int) -> int:
    return max(1, size // TASK_BYTES)


def repeated_spans(
    docs: DataFrame,
    carry: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
    hot: int = HOT,
    as_text: bool = False,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``begins``, ``ends`` (the spans to be removed, in
    bytes) and ``kept`` (the bytes that remain).

    With ``as_text``, ``kept`` is a string: a character that loses one of its
    bytes goes as a whole. The columns named in ``carry`` come along in a struct,
    ``carried``.
    """
    spark = docs.sparkSession
    carry = carry or []
    reach_workers(spark)
    text = F.coalesce("text", F.lit("")).alias("text")
    others = [F.struct(*carry).alias("carried")] if carry else []
    chosen = docs.select("doc_id", text, *others)
    texts = new_workspace(spark, "llm-blocks")
    made = _blocks(chosen, texts, block_bytes)
    size = sum(row["bytes"] for row in made)
    # From one partition they are dealt in turn, so that all tasks get as many.
    listed = spark.createDataFrame(made, LISTED).coalesce(1).repartition(_tasks(size))
    bits = _bits(size, ASK_BYTES)
    merge_bits = _bits(size, MERGE_BYTES)
    one, two, three = (new_workspace(spark, f"llm-answers{k}") for k in (1, 2, 3))

    def ask_first(block: Block) -> Iterator[dict]:
        yield from _ask(block.number, REPEATED, _first_questions(block), bits)

    def ask_second(block: Block) -> Iterator[dict]:
        found = _likely(block, _read_back(one, block.number)[REPEATED])
        for kind, asked in _second_questions(block, found).items():
            yield from _ask(block.number, kind, asked, bits)

    def known(block: Block) -> tuple[Units, Sorted]:
        found = _likely(block, _read_back(one, block.number)[REPEATED])
        return found, _sort_units(block, found, _read_back(two, block.number))

    def send(block: Block) -> Iterator[dict]:
        found, known_ = known(block)
        yield from _to_merge(block, found, known_.merge, merge_bits)
        asked = _window_questions(block, found, known_.single)
        yield from _ask(block.number, EARLIER, asked, bits)

    def reply(rows: pa.Table) -> pa.Table:
        if rows["kind"][0].as_py() == MERGE:
            return _merge_bucket(rows)
        return _answer_bucket(rows, hot)

    def answered(work: Callable[[Block], Iterator[dict]]) -> DataFrame:
        asked = _dealt(listed.mapInArrow(_sending(work, texts), MESSAGE), size)
        return asked.groupBy("kind", "bucket").applyInArrow(reply, MESSAGE)

    _come_back(spark, answered(ask_first), one)
    _come_back(spark, answered(ask_second), two)
    _come_back(spark, answered(send), three)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in _each_block(batches, texts):
            found, known_ = known(block)
            last = _read_back(three, block.number)
            single = _repeated_windows(block, found, known_.single, last[EARLIER])
            merged = np.frombuffer(last[MERGE], "<i8")
            first = np.concatenate([found.first[known_.repeats], single, merged])
            stop = np.concatenate([found.last[known_.repeats], single, merged]) + LENGTH
            columns = _cut(block, first, stop)
            columns["doc_id"] = row["docs"][0].values
            if as_text:
                kept = (data.decode("utf-8", "ignore") for data in columns["kept"].to_pylist())
                columns["kept"] = pa.array(kept, pa.string())
            if carry:
                columns["carried"] = row["carried"][0].values
            yield pa.record_batch({name: columns[name] for name in names})

    names = ["doc_id", "n_bytes", "begins", "ends", "kept"]
    schema = "doc_id long, n_bytes long, begins array<long>, ends array<long>, kept "
    schema += "string" if as_text else "binary"
    if carry:
        names.append("carried")
        schema += f", carried {dict(chosen.dtypes)['carried']}"
    return listed.mapInArrow(finish, schema)


def _cut(block: Block, first: np.ndarray, stop: np.ndarray) -> dict[str, pa.Array]:
    """The spans covered by some windows, by document, and what is left."""
    size = len(block.data)
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, stop, -1)
    gone = np.cumsum(edge[:-1], dtype=np.int32, out=edge[:-1]) > 0
    del edge
    ends = np.cumsum(block.lengths)
    starts = ends - block.lengths
    opens = np.zeros(size + 1, bool)
    opens[starts[block.lengths > 0]] = True  # a span ends with its document
    opens = opens[:-1]
    before = np.concatenate([[False], gone[:-1]])
    begin = np.flatnonzero(gone & (~before | opens))
    after = np.concatenate([gone[1:], [False]])
    next_opens = np.concatenate([opens[1:], [True]])
    end = np.flatnonzero(gone & (~after | next_opens)) + 1
    row = np.searchsorted(ends, begin, "right")
    count = np.bincount(row, minlength=len(ends))
    lists = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32())
    lost = np.zeros(len(ends), np.int64)
    np.add.at(lost, row, end - begin)
    return {
        "n_bytes": pa.array(block.lengths),
        "begins": pa.ListArray.from_arrays(lists, pa.array(begin - starts[row])),
        "ends": pa.ListArray.from_arrays(lists, pa.array(end - starts[row])),
        "kept": binary_rows(block.array[~gone], block.lengths - lost),
    }
