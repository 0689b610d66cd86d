"""The operators' results worked out plainly, in Python, for small tables.

Each function takes rows (dictionaries with ``doc_id`` and ``text``) and returns
one tuple per row, in the order of the rows.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import regex
import xxhash

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def text_of(row: dict) -> str:
    return row["text"] or ""


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def as_u32(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def crc_mod(doc_id, divisor: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % divisor


def byte_ids(texts: list[str]) -> list[list[int]]:
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coding = tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return [coding.encode_ordinary(t) for t in texts]


def word_ids(texts: list[str]) -> list[list[int]]:
    from tokenizers import Tokenizer

    coding = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [e.ids for e in coding.encode_batch(texts, add_special_tokens=False)]


def simhash(text: str, width: int = 4) -> int:
    words = WORD.findall(lowered(text))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def components(prints: list[int], distance: int = 4) -> list[int]:
    """The number of each print's component: the place of its first member."""
    parent = list(range(len(prints)))

    def root(a: int) -> int:
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                one, two = sorted((root(i), root(j)))
                parent[two] = one
    return [root(i) for i in range(len(prints))]


def smallest_reachable(rows: list[dict], prints: list[int]) -> list[int | None]:
    groups = components(prints)
    least: dict[int, int] = {}
    for row, group in zip(rows, groups):
        if row["doc_id"] is not None:
            least[group] = min(row["doc_id"], least.get(group, row["doc_id"]))
    return [least.get(g) for g in groups]


def base_rules(text: str) -> tuple:
    words = WORD.findall(text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        duplicates,
        len(covered),
        failed,
    )


# The line rules, written down once more: results must not hang on one list.
MENU = (
    "home", "menu", "login", "log in", "logout", "log out", "sign in", "sign up", "register",
    "search", "contact", "contact us", "about", "about us", "next", "previous", "back", "top",
    "share", "print", "sitemap", "site map", "faq", "help", "blog", "shop", "cart",
    "skip to content", "read more", "load more", "go to top",
)
NOTICES = (
    "all rights reserved", "licensed under", "released under the", "copyright (c)",
    "copyright ©", *(f"copyright {d}" for d in range(10)), "terms of use", "terms of service",
    "privacy policy", "cookie policy", "use cookies", "uses cookies",
    "enable javascript", "subscribe to our", "subscribe to the", "click here", "lorem ipsum",
)
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")


def only_menu_words(line: str) -> bool:
    low, end = lowered(line), len(line)
    reached, words = {0}, 0
    while reached:
        at = min(reached)
        reached.remove(at)
        while at < end and line[at] not in LETTERS:
            at += 1
        if at == end:
            return words > 0
        for word in MENU:
            after = at + len(word)
            if low.startswith(word, at) and (after == end or line[after] not in LETTERS):
                reached.add(after)
                words += 1
    return False


def has_notice(line: str) -> bool:
    low = lowered(line)
    for notice in NOTICES:
        at = low.find(notice)
        while at >= 0:
            if at == 0 or low[at - 1] not in LETTERS:
                return True
            at = low.find(notice, at + 1)
    at = low.find("powered by ")
    while at >= 0:
        after = low[at + 11 : at + 12]
        if after in LETTERS and after and (at == 0 or low[at - 1] not in LETTERS):
            return True
        at = low.find("powered by ", at + 1)
    return False


def line_passes(line: str) -> bool:
    if not WORD.search(line):
        return True
    marks = sum(line.count(c) for c in "#*$%&|<>!{}=~^\\_")
    separators = sum(line.count(c) for c in "|»›•·")
    last = line.strip(" \t\n\x0b\f\r")[-1]
    unended = last not in ".!?:;,…\"'”’»)]" and len(WORD.findall(line)) < 5
    return not (
        not regex.search(r"\p{L}", line)
        or (marks >= 3 and marks * 100 > len(line) * 8)
        or (separators >= 3 and separators * 40 >= len(line))
        or only_menu_words(line)
        or has_notice(line)
        or unended
    )


def cleaned(text: str) -> tuple[str, bool]:
    """The text without its bad lines, and whether the document is kept."""
    lines = text.split("\n")
    good = [line for line in lines if line_passes(line)]
    clean = text if len(good) == len(lines) else "\n".join(good)
    whole = sum(map(len, WORD.findall(text)))
    lost = whole - sum(map(len, WORD.findall(clean)))
    return clean, not base_rules(text)[-1] and 100 * lost <= 40 * whole


def repeated_bytes(rows: list[dict], length: int = 100) -> list[np.ndarray]:
    """Which bytes of each text are removed; rows with equal ids in their order."""
    order = sorted(
        range(len(rows)),
        key=lambda i: (rows[i]["doc_id"] is None, rows[i]["doc_id"] or 0, i),
    )
    seen: set[bytes] = set()
    gone: list[np.ndarray] = [np.zeros(0, bool)] * len(rows)
    for i in order:
        data = text_of(rows[i]).encode()
        marks = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                marks[p : p + length] = True
            seen.add(window)
        gone[i] = marks
    return gone


def span_digest(text: str, gone: np.ndarray) -> tuple:
    edges = np.concatenate([[False], gone])
    spans = int((edges[1:] & ~edges[:-1]).sum())
    kept = np.frombuffer(text.encode(), np.uint8)[~gone].tobytes()
    return (len(gone), int(gone.sum()), spans, sha256(kept))


def unigrams(rows: list[dict]) -> list[tuple]:
    """held_out, n_tokens, n_known, train_tokens and the base score."""
    tokens = [WORD.findall(lowered(text_of(r))) + [None] for r in rows]
    out = [crc_mod(r["doc_id"], 7) == 2 for r in rows]
    counts: Counter = Counter()
    for t, held in zip(tokens, out):
        if not held:
            counts.update(t)
    total, kinds = sum(counts.values()), len(counts)
    return [
        (
            held,
            len(t),
            sum(counts[w] > 0 for w in t),
            total,
            sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in t),
        )
        for t, held in zip(tokens, out)
    ]


def grams(text: str) -> list[int]:
    """Buckets of all runs of one to three characters that have a letter."""
    shown = [c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()]
    found = []
    for n in (1, 2, 3):
        for at in range(len(shown) - n + 1):
            run = shown[at : at + n]
            if run == [" "] * n:
                continue
            code = 0
            for k, c in enumerate(run, 1):
                code = (code * 0x100000001B3 + ord(c) + k) % 2**64
            found.append(code * 0x9E3779B97F4A7C15 % 2**64 >> 48)
    return found


def languages(rows: list[dict], smoothing: float = 0.1) -> list[tuple[str, float]]:
    """Language and posterior of every row, by naive Bayes over ``grams``."""
    counts: dict[str, Counter] = {}
    documents: Counter = Counter()
    for r in rows:
        if r["lang"] is not None and crc_mod(r["doc_id"], 4) != 2:
            found = grams(text_of(r))
            if found:
                counts.setdefault(r["lang"], Counter()).update(found)
                documents[r["lang"]] += 1
    known = sorted(counts)
    totals = {x: sum(counts[x].values()) + smoothing * 2**16 for x in known}
    results = []
    for r in rows:
        found = grams(text_of(r))
        if not found or not known:
            results.append(("und", 0.0))
            continue
        scores = [
            math.log(documents[x] / sum(documents.values()))
            + sum(math.log((counts[x][g] + smoothing) / totals[x]) for g in found)
            for x in known
        ]
        best = max(scores)
        share = 1 / sum(math.exp(s - best) for s in scores)
        results.append((known[scores.index(best)], share))
    return results


def mix_targets(rows: list[dict], weights=(5, 2, 1), most: int = 3) -> dict:
    """Size and target of each source, the excess reshared step by step."""
    sizes: Counter = Counter()
    for r in rows:
        sizes[r["source"]] += len(WORD.findall(text_of(r)))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    excess, open_ = float(sum(sizes.values())), list(order)
    while open_ and excess > 1e-9:
        share = excess / sum(weight[s] for s in open_)
        excess = 0.0
        for s in open_:
            target[s] += share * weight[s]
            if target[s] > most * sizes[s]:
                excess += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
        open_ = [s for s in open_ if target[s] < most * sizes[s]]
    return {s: (sizes[s], target[s]) for s in order}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(rows: list[dict], items: list[tuple], k: int = 10) -> list[tuple]:
    """item_id, rank, doc_id and score of the best documents of each item."""
    docs = [(r["doc_id"], Counter(TERM.findall(lowered(text_of(r))))) for r in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df: Counter = Counter(t for _, c in docs for t in c)
    found = []
    for item_id, text in items:
        terms = set(TERM.findall(lowered(text or "")))
        scored = []
        for doc_id, counts in docs:
            m = 100 - 90 + (90 * sum(counts.values()) * n_docs) // total
            score = 0
            for t in terms:
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                tf = counts[t]
                score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        best = enumerate(scored[:k], 1)
        found += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in best]
    return found


def whitened(vectors: list[tuple], most: int = 32):
    """Ids, deviations, eigenvalues, shares and whitened vectors of the usable rows."""
    fits = [
        (i, v)
        for i, v in vectors
        if v and all(c is not None and math.isfinite(c) and abs(c) <= 2**56 for c in v)
    ]
    lengths = Counter(len(v) for _, v in fits)
    dims = max(lengths, key=lambda n: (lengths[n], n))
    fits = [(i, v) for i, v in fits if len(v) == dims]
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in fits]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    varies = (values > 1e-11 * values.max()) & (np.arange(len(values)) < most)
    white = centred @ vectors_[:, varies] / np.sqrt(values[varies])
    return [i for i, _ in fits], deviations, values[varies] / values.sum(), white
