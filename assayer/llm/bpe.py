"""Byte-level byte-pair encoding and decoding from a file of ranks.

A text is split by a pattern; each match is encoded by itself. The distinct
matches of a batch are sorted into buckets by their length and laid out as
padded numpy matrices, one row per match. In each round every row merges its
leftmost pair of least rank; the merged column is closed up, so that a matrix
loses a column per round, and rows with nothing left to merge leave it. The
rank of a pair is looked up in a hash table of all pairs of the vocabulary.

A match of more than ``LONG`` bytes (rare: a text without spaces) is merged
from a heap of its pairs instead, in the same order, since rounds over a matrix
would take time that grows with the square of its length.

Defined results: a null text is an empty text without ids; an empty table gives
no rows; equal rows give equal results.
"""

from __future__ import annotations

import base64
import heapq
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from assayer.llm.common import binary_rows, gather_ranges, per_piece, texts

NONE = np.int32(2**31 - 1)
LONG = 512
#: Cells of a matrix.
CELLS = 1 << 18
#: Upper ends of the length buckets.
BUCKETS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 20, 24, 32, 48, 64, 128, 256, LONG)

_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Pairs of ids and the id they merge to, in an open-addressing hash table."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        keys = self._key(left, right)
        self._bits = max(4, int(4 * len(keys)).bit_length())
        size = 1 << self._bits
        self._keys = np.full(size, np.uint64(2**64 - 1), np.uint64)
        self._merged = np.full(size, NONE, np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            free = self._keys[at[todo]] == np.uint64(2**64 - 1)
            place, first = np.unique(at[todo[free]], return_index=True)
            chosen = todo[free][first]
            self._keys[place] = keys[chosen]
            self._merged[place] = merged[chosen]
            todo = todo[self._keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & (size - 1)
            self.probes += 1

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        high = left.astype(np.uint32).astype(np.uint64)  # -1 becomes 2**32 - 1
        return (high << np.uint64(32)) | right.astype(np.uint32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> np.uint64(64 - self._bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair, ``NONE`` for pairs that don't merge."""
        shape = left.shape
        keys = self._key(left.ravel(), right.ravel())
        at = self._slot(keys)
        there = self._keys[at]
        found = np.where(there == keys, self._merged[at], NONE)
        empty = np.uint64(2**64 - 1)
        open_ = np.flatnonzero((there != keys) & (there != empty))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(self._keys) - 1)
            there = self._keys[at[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self._merged[at[open_[hit]]]
            open_ = open_[~hit & (there != empty)]
        return found.reshape(shape)


class BytePairs:
    """An encoding made of the ranks in a file and a splitting pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self._find = regex.compile(pattern).findall
        self._byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        rank = self.ranks.get
        for token, number in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = rank(token[:cut]), rank(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(number)
        self._pairs = PairTable(*(np.array(x, np.int32) for x in (left, right, merged)))
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, number in self.ranks.items():
            tokens[number] = token
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self._starts = np.cumsum(self._sizes) - self._sizes

    # -- encoding ----------------------------------------------------------------

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and the number of ids of each row."""
        found = [self._find(text) for text in column.to_pylist()]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        if not counts.sum():
            return np.zeros(0, np.uint32), counts
        matches = pa.array(itertools.chain.from_iterable(found), pa.string())
        del found
        coded = matches.dictionary_encode()
        use = np.asarray(coded.indices)
        ids, sizes = self._encode_distinct(coded.dictionary)
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[use]
        flat = ids[gather_ranges(starts[use], lengths)]
        before = np.concatenate([[0], np.cumsum(lengths)])
        return flat, np.diff(before[np.concatenate([[0], np.cumsum(counts)])])

    def _encode_distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw = words.cast(pa.binary())
        sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset :]
        starts = offsets[: len(raw)].astype(np.int64)
        data = np.frombuffer(raw.buffers()[2], np.uint8)
        whose, what = [], []
        lower = 0
        for upper in BUCKETS:
            rows = np.flatnonzero((sizes > lower) & (sizes <= upper))
            lower = upper
            step = max(1, CELLS // upper)
            for first in range(0, len(rows), step):
                some = rows[first : first + step]
                cells = np.minimum(starts[some, None] + np.arange(upper), len(data) - 1)
                matrix = self._byte[data[cells]]
                matrix[np.arange(upper) >= sizes[some, None]] = -1
                for done, ids in self._merge(matrix):
                    kept = ids >= 0
                    whose.append(np.repeat(some[done], kept.sum(1)))
                    what.append(ids[kept])
        for row in np.flatnonzero(sizes > LONG):
            ids = self._merge_long(raw[int(row)].as_py())
            whose.append(np.full(len(ids), row))
            what.append(ids)
        owner = np.concatenate(whose)
        order = np.argsort(owner, kind="stable")
        ids = np.concatenate(what)[order].astype(np.uint32)
        return ids, np.bincount(owner, minlength=len(sizes))

    def _merge(self, ids: np.ndarray):
        """Rows and their ids as they are finished. Unused cells hold -1."""
        row = np.arange(len(ids))
        rank = self._pairs(ids[:, :-1], ids[:, 1:])
        while rank.shape[1]:
            each = np.arange(len(ids))
            at = rank.argmin(1)  # the first of equal ranks: the leftmost pair
            best = rank[each, at]
            going = best != NONE
            if not going.all():
                yield row[~going], ids[~going]
                if not going.any():
                    return
                row, ids, rank = row[going], ids[going], rank[going]
                at, best, each = at[going], best[going], each[: len(row)]
            width = ids.shape[1] - 1
            gap = np.arange(width) > at[:, None]
            ids = np.where(gap, ids[:, 1:], ids[:, :-1])
            ids[each, at] = best
            gap = gap[:, 1:] | (np.arange(width - 1) == at[:, None])
            rank = np.where(gap, rank[:, 1:], rank[:, :-1])
            has = np.flatnonzero(at > 0)
            if len(has):
                rank[has, at[has] - 1] = self._pairs(ids[has, at[has] - 1], best[has])
            has = np.flatnonzero(at < width - 1)
            if len(has):
                rank[has, at[has]] = self._pairs(best[has], ids[has, at[has] + 1])
        yield row, ids

    def _merge_long(self, word: bytes) -> np.ndarray:
        """The same merges, least rank first and leftmost among equals, by a heap."""
        size = len(word)
        part = [word[i : i + 1] for i in range(size)]
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        rank = self.ranks.get
        heap = []
        for i in range(size - 1):
            number = rank(word[i : i + 2])
            if number is not None:
                heap.append((number, i, 2))
        heapq.heapify(heap)
        while heap:
            number, i, length = heapq.heappop(heap)
            j = after[i]
            # Entries of pairs that have since been merged are out of date.
            if not part[i] or j >= size or len(part[i]) + len(part[j]) != length:
                continue
            part[i] += part[j]
            part[j] = b""
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < size:
                    pair = part[a] + part[b]
                    number = rank(pair)
                    if number is not None:
                        heapq.heappush(heap, (number, a, len(pair)))
        return np.array([self.ranks[p] for p in part if p], np.int32)

    # -- decoding ----------------------------------------------------------------

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all rows one after another, and the size of each row."""
        sizes = self._sizes[ids]
        flat = self._bytes[gather_ranges(self._starts[ids], sizes)]
        before = np.concatenate([[0], np.cumsum(sizes)])
        return flat, np.diff(before[np.concatenate([[0], np.cumsum(lengths)])])


_ENCODINGS: dict[tuple[str, str], BytePairs] = {}


def byte_pairs(path: str, pattern: str) -> BytePairs:
    """The encoding of a file, one per Python worker."""
    if (path, pattern) not in _ENCODINGS:
        _ENCODINGS[path, pattern] = BytePairs(path, pattern)
    return _ENCODINGS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, lengths = byte_pairs(path, pattern).encode(batch["text"])
        return pa.record_batch(
            {"doc_id": batch["doc_id"], "ids": binary_rows(ids.astype("<u4"), lengths)}
        )

    return texts(docs).mapInArrow(per_piece(run), "doc_id long, ids binary")


def _ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), "<u4"), sizes // 4


def decode_documents(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``decoded`` (bytes) of what ``encode_documents`` gives."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, sizes = byte_pairs(path, pattern).decode(*_ids_of(batch["ids"]))
        return pa.record_batch(
            {"doc_id": batch["doc_id"], "decoded": binary_rows(data, sizes)}
        )

    return coded.select("doc_id", "ids").mapInArrow(
        per_piece(run, "ids"), "doc_id long, decoded binary"
    )


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``: both ways in one task."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoding = byte_pairs(path, pattern)
        column = binary_rows(*(lambda i, n: (i.astype("<u4"), n))(*encoding.encode(batch["text"])))
        data, sizes = encoding.decode(*_ids_of(column))
        return pa.record_batch(
            {"doc_id": batch["doc_id"], "ids": column, "decoded": binary_rows(data, sizes)}
        )

    return texts(docs).mapInArrow(
        per_piece(run), "doc_id long, ids binary, decoded binary"
    )
