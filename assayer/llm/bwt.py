"""Burrows-Wheeler transforms of shards of strings, and their merging.

A shard is a collection of strings, each with a terminator of its own behind
it. Shards are merged as Holt and McMillan do: the merged transform is described
by an interleave, the order in which its entries are taken from the shards. The
interleave starts as one shard after the other. Each round walks the transforms
in the order of the interleave and deals the entries out by their symbol, which
sorts them by one more symbol; suffixes are not sorted again. Entries that have
not been told apart by then form an interval: their common prefix is as long as
there were rounds.

Two kinds of entries leave the interleave early: those that are alone in their
interval, since they are settled, and those whose suffix is too near the begin
of its string to become, in the rounds that remain, one of the wanted length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols: 0 is the terminator, byte b is b + 1.
END = 0


@dataclass(frozen=True)
class Shard:
    """The transform of a shard and, by entry, where the suffix begins."""

    transform: np.ndarray  # uint16
    strings: int
    string: np.ndarray  # the suffix's string
    offset: np.ndarray  # and its place in it


def shard(data: np.ndarray, lengths: np.ndarray) -> Shard:
    """The transform of strings that lie one after another in ``data``."""
    count, total = len(lengths), int(lengths.sum()) + len(lengths)
    ends = np.cumsum(lengths + 1) - 1
    symbols = np.zeros(total, np.uint16)
    plain = np.ones(total, bool)
    plain[ends] = False
    symbols[plain] = data.astype(np.uint16) + 1
    # Terminators differ: that of an earlier string is smaller.
    rank = symbols.astype(np.int64) + count
    rank[ends] = np.arange(count)
    step, longest = 1, int(lengths.max(initial=0)) + 1
    while True:
        follow = np.zeros(total, np.int64)
        follow[: max(0, total - step)] = rank[step:]
        pair = rank * (total + 257 + count) + follow
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        rank = np.empty(total, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        step *= 2
        if step >= longest or rank[order[-1]] == total - 1:
            break
    string = np.repeat(np.arange(count), lengths + 1)
    offset = np.arange(total) - np.repeat(ends - lengths, lengths + 1)
    before = np.where(offset[order] > 0, symbols[order - 1], END)
    return Shard(before.astype(np.uint16), count, string[order], offset[order])


def _walk(part: Shard) -> np.ndarray:
    """Where the walk goes from each entry: to the suffix that is one symbol longer.

    From the entry of a whole string it goes nowhere (-1).
    """
    order = np.argsort(part.transform, kind="stable")
    to = np.empty(len(order), np.int64)
    to[order] = np.arange(len(order))
    to[order[: part.strings]] = -1
    return to


@dataclass(frozen=True)
class Merged:
    """Intervals of suffixes that have ``depth`` symbols in common.

    ``string`` (counted over all shards), ``offset`` and ``group`` of each of
    their entries, in merged order. ``shared`` has, for the strings' suffixes in
    the order of the shards' transforms, in how many rounds they were in an
    interval with others: the longest prefix that they share, as far as it was
    followed.
    """

    string: np.ndarray
    offset: np.ndarray
    group: np.ndarray
    shared: np.ndarray


def merge(shards: list[Shard], depth: int) -> Merged:
    """Refine the interleave of the shards for ``depth`` rounds."""
    base = np.cumsum([0] + [len(s.transform) for s in shards])
    symbols = np.concatenate([s.transform for s in shards])
    offset = np.concatenate([s.offset for s in shards])
    to = np.concatenate([_walk(s) + b for s, b in zip(shards, base)])
    strings = np.cumsum([0] + [s.strings for s in shards])
    string = np.concatenate([s.string + n for s, n in zip(shards, strings)])
    shared = np.zeros(len(symbols), np.int64)
    entry = np.flatnonzero(offset >= depth)
    group = np.zeros(len(entry), np.int64)
    for length in range(1, depth + 1):
        symbol = symbols[entry]
        order = np.argsort(symbol, kind="stable")
        order = order[np.searchsorted(symbol[order], 1) :]  # no symbol before: END
        symbol, before, entry = symbol[order], group[order], to[entry[order]]
        new = np.ones(len(entry) + 1, bool)
        new[1:-1] = (symbol[1:] != symbol[:-1]) | (before[1:] != before[:-1])
        together = ~(new[:-1] & new[1:])
        entry, group = entry[together], np.cumsum(new[:-1])[together]
        shared[entry] = length
    return Merged(string[entry], offset[entry], group, shared)
