"""Best-fit packing of documents into sequences of bounded length.

Bounded-space online best fit: pieces are placed one after another into the
open sequence that they fill best; there are never more than ``open_bins`` open
sequences, and when a new one is needed the fullest is closed. Open sequences
are kept in lists by their free space, and a bit set (a Python integer) marks
which lists are not empty, so that the best fit is its lowest bit at or above
the length of the piece.

Defined results: a null text is an empty text, whose only id is the end id; an
empty table gives no rows; rows with equal or null ``doc_id`` are packed like
any others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import binary_rows, gather_ranges, per_piece, texts, written
from assayer.llm.tokens import TEXT_BYTES, word_encoder

#: Open sequences per task.
OPEN_BINS = 1024
#: Pieces that one task packs, on average.
PIECES_PER_TASK = 500_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(
    docs: DataFrame, tokenizer: str, max_tokens: int = 2048, end_id: int = 0
) -> DataFrame:
    """Every document's ids, the end id behind them, cut into pieces.

    Only documents of more than ``max_tokens`` ids are cut, into full pieces
    and a last one that may be shorter. ``ids`` holds little-endian unsigned
    32-bit integers; ``start`` counts the document's ids before the piece.
    """

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, lengths = word_encoder(tokenizer).encode(batch["text"])
        ends = np.cumsum(lengths)
        ids = np.insert(ids, ends, np.uint32(end_id))
        lengths = lengths + 1
        counts = -(-lengths // max_tokens)
        row = np.repeat(np.arange(len(lengths)), counts)
        piece = gather_ranges(np.zeros(len(counts), np.int64), counts)
        start = piece * max_tokens
        length = np.minimum(lengths[row] - start, max_tokens)
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"].take(pa.array(row)),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids": binary_rows(ids, length),
            }
        )

    return texts(docs).mapInArrow(per_piece(cut, limit=TEXT_BYTES), PIECE_SCHEMA)


class OpenBins:
    """The open sequences of one task."""

    def __init__(self, capacity: int, limit: int) -> None:
        self._capacity = capacity
        self._limit = limit
        self._by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._levels = 0  # bit f is set while a sequence has f free places
        self._open = 0
        self._made = 0

    def place(self, length: int) -> tuple[int, int]:
        """The sequence that takes a piece of this length, and the place in it."""
        fitting = self._levels >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self._open == self._limit:
                self._take((self._levels & -self._levels).bit_length() - 1)
            free, number = self._capacity, self._made
            self._made += 1
        left = free - length
        if left:
            self._by_free[left].append(number)
            self._levels |= 1 << left
            self._open += 1
        return number, self._capacity - free

    def _take(self, free: int) -> int:
        level = self._by_free[free]
        number = level.pop()
        if not level:
            self._levels ^= 1 << free
        self._open -= 1
        return number


def pack(
    pieces: DataFrame,
    capacity: int = 2048,
    open_bins: int = OPEN_BINS,
    tasks: int = 1,
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset`` added.

    ``pieces`` has ``doc_id``, ``piece`` and ``length`` (1 to ``capacity``)
    among its columns. Each task packs its share by itself. Its pieces come in
    a fixed order, so that a repeated task gives the same sequences. Columns that
    have the names of the added ones are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    # The hash is that of the whole row, so that rows without an id spread too.
    shared = pieces.repartition(max(1, tasks), "doc_id", "piece", "length")
    shared = shared.sortWithinPartitions("doc_id", "piece", "length")
    schema = f"{pieces.schema.simpleString()[7:-1]},sequence_id:bigint,offset:bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            placed = [bins.place(n) for n in batch["length"].to_pylist()]
            numbers = np.array(placed, np.int64).reshape(-1, 2)
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["sequence_id"] = pa.array(base + numbers[:, 0])
            columns["offset"] = pa.array(numbers[:, 1])
            yield pa.record_batch(columns)

    return shared.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    max_tokens: int = 2048,
    end_id: int = 0,
    open_bins: int = OPEN_BINS,
) -> DataFrame:
    """Every piece of every document with its checksum and its place.

    The pieces are tokenized once and written without their ids; what is packed
    then is some 30 bytes per piece, dealt to as many tasks as there are half
    millions of pieces. A task's sequences that stay open at its end are the
    only ones that more tasks would add.
    """
    cut = token_pieces(docs, tokenizer, max_tokens, end_id)
    digest = cut.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    table = written(docs.sparkSession, digest, "pieces")
    tasks = -(-table.count() // PIECES_PER_TASK)
    return pack(table, max_tokens, open_bins, tasks)
