"""Token ids by the ``tokenizers`` library, one encoding per distinct word.

The tokenizers this is meant for (``word_bpe_49k.json``) drop white space and
split a text there before anything else. So the ids of a text are those of its
words, one after another, and every distinct word of a batch needs to be
encoded only once. Two more steps leave the ids as they are:

* ASCII capitals are lowered in words of Latin letters, since the tokenizer
  lowers them itself. (Words with combining marks are left alone: there the
  order of lowering and composing matters; words that hold the string of a special
  token, in any case, too.)
* Punctuation at the end of a word, after a Latin letter or a digit, is a
  token run of its own and is encoded apart.

Words seen more than once in a batch stay in a cache of bounded size that lives
as long as the Python worker.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from assayer.llm.common import gather_ranges, split_words

#: Entries of the cache; 300,000 words take about 60 MB.
CACHE_WORDS = 300_000
#: Bytes of text encoded at a time: the more, the fewer words are encoded again.
TEXT_BYTES = 16 << 20
#: Distinct words that are encoded as one text.
WORDS_AT_ONCE = 512
#: Separates them. It is a word of its own to the tokenizer.
SEPARATOR = "\ue000"

_LATIN = r"^[\x21-\x{24f}]*$"
_TAIL = r"^(?P<core>[\x21-\x{24f}]*[0-9A-Za-zÀ-ÖØ-öø-ÿ])(?P<tail>[.,!?;:|]+)$"


class WordEncoder:
    """Encodes string columns; ids come back as unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder().values()
        #: Strings that the library takes for a token as they stand.
        self._special = [token.content for token in added]
        self._cache: dict[str, bytes] = {}
        self._mark = np.array(self._ids([SEPARATOR])[0], np.uint32)

    def _ids(self, words: list[str]) -> list[list[int]]:
        encode = self._tokenizer.encode_batch_fast
        return [e.ids for e in encode(words, add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and the number of ids of each row."""
        words, ends = split_words(column)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        coded = words.dictionary_encode()
        use = np.asarray(coded.indices)
        core, tail = _parts(coded.dictionary, self._special)
        flat, counts, starts = self._dictionary(core, np.bincount(use))
        tail_flat, tail_counts, tail_starts = self._dictionary(tail, None)
        # Ids of the distinct words: those of the core, then those of the tail.
        c, t = np.asarray(core.indices), np.asarray(tail.indices)
        table = np.concatenate([flat, tail_flat])
        first = np.stack([starts[c], tail_starts[t] + len(flat)], 1).ravel()
        size = np.stack([counts[c], tail_counts[t]], 1).ravel()
        table = table[gather_ranges(first, size)]
        size = counts[c] + tail_counts[t]
        first = np.cumsum(size) - size
        lengths = size[use]
        ids = table[gather_ranges(first[use], lengths)]
        before = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(before[ends])

    def _dictionary(self, coded: pa.DictionaryArray, used: np.ndarray | None):
        words = coded.dictionary.to_pylist()
        found = list(map(self._cache.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            fresh = self._encode_words([words[i] for i in missing])
            for i, ids in zip(missing, fresh):
                found[i] = ids
            if used is not None:
                often = np.bincount(np.asarray(coded.indices), used) > 1
                some = np.array(missing)[often[missing]][: CACHE_WORDS - len(self._cache)]
                for i in some.tolist():
                    self._cache[words[i]] = found[i]
        flat = np.frombuffer(b"".join(found), np.uint32)
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return flat, counts, np.cumsum(counts) - counts

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as bytes."""
        out: list[bytes] = []
        groups = [words[i : i + WORDS_AT_ONCE] for i in range(0, len(words), WORDS_AT_ONCE)]
        joined = f"\n{SEPARATOR}\n"
        for i in range(0, len(groups), 64):
            batch = groups[i : i + 64]
            for group, ids in zip(batch, self._ids([joined.join(g) for g in batch])):
                out += self._cut(group, np.array(ids, np.uint32))
        return out

    def _cut(self, group: list[str], ids: np.ndarray) -> list[bytes]:
        width = len(self._mark)
        hits = np.ones(max(0, len(ids) - width + 1), bool)
        for k, mark in enumerate(self._mark):
            hits &= ids[k : len(hits) + k] == mark
        at = np.flatnonzero(hits)
        if len(at) != len(group) - 1 or any(SEPARATOR in word for word in group):
            return [np.array(x, np.uint32).tobytes() for x in self._ids(group)]
        firsts = np.concatenate([[0], at + width]).tolist()
        lasts = np.concatenate([at, [len(ids)]]).tolist()
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(firsts, lasts)]


def _parts(
    words: pa.Array, special: list[str]
) -> tuple[pa.DictionaryArray, pa.DictionaryArray]:
    """Each word as a core and the punctuation behind it, dictionary encoded."""
    latin = pc.match_substring_regex(words, _LATIN)
    for token in special:  # lowered, other words could become one
        alike = pc.match_substring(words, token, ignore_case=True)
        latin = pc.and_(latin, pc.invert(alike))
    lowered = pc.if_else(latin, pc.ascii_lower(words), words)
    parts = pc.extract_regex(lowered, _TAIL)
    split = pc.is_valid(parts)
    core = pc.if_else(split, pc.struct_field(parts, "core"), lowered)
    tail = pc.if_else(split, pc.struct_field(parts, "tail"), "")
    return core.dictionary_encode(), tail.dictionary_encode()


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The encoder of a tokenizer file, one per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
