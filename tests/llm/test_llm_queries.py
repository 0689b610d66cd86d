"""Every registered query against plain Python: given rows, edge rows, none."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from compare import differences
from edges import edge_items, edge_vectors
from plain import SMALL

from assayer.llm.oracle import ORACLE
from assayer.llm.queries import QUERIES


@pytest.fixture(params=["small", "edge"])
def given(request, tables, small_rows, edge_rows):
    if request.param == "small":
        return SMALL, small_rows
    return tables["edge"], edge_rows


def run(spark, name: str, folder: str) -> list[dict]:
    full = next(q for q in QUERIES if q.startswith(name))
    return [r.asDict() for r in QUERIES[full](spark, folder).collect()]


def same(rows: list[dict], names: tuple, wanted: list[tuple]) -> None:
    """Equal as multisets: ids may repeat."""
    found = Counter(tuple(r[n] for n in names) for r in rows)
    expected = Counter(wanted)
    assert found == expected, list((found - expected).items())[:3]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, tables, name):
    assert QUERIES[name](spark, tables["empty"]).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, QUERIES[name], ORACLE[name], SMALL) == []


def test_byte_bpe(spark, given):
    folder, rows = given
    texts = [plain.text_of(r) for r in rows]
    wanted = [
        (r["doc_id"], len(ids), plain.sha256(plain.as_u32(ids)), plain.sha256(t.encode()))
        for r, t, ids in zip(rows, texts, plain.byte_ids(texts))
    ]
    same(run(spark, "op1_", folder), ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), wanted)


def test_packing(spark, given):
    folder, rows = given
    found = run(spark, "op2_", folder)
    wanted = []
    for row, ids in zip(rows, plain.word_ids([plain.text_of(r) for r in rows])):
        ids = ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            crc = zlib.crc32(plain.as_u32(part))
            wanted.append((row["doc_id"], piece, start, len(part), crc))
    same(found, ("doc_id", "piece", "start", "length", "ids_crc32"), wanted)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(r["length"] for r in found)
    assert len(sequences) <= -(-total // 2048) + 3


def test_warc(spark, tables):
    found = run(spark, "op3_", tables["edge"])
    first: dict[str, int] = {}
    for page_id, _, html, *_ in sorted(tables["pages"], key=lambda p: (p[0] is None, p[0] or 0)):
        if page_id is not None:
            first.setdefault(html or "", page_id)
    wanted = []
    for page_id, _, html, *_ in tables["pages"]:
        data = (html or "").encode()
        origin = first.get(html or "")
        revisit = page_id is not None and origin != page_id
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kind = "revisit" if revisit else "response"
        wanted.append((page_id, len(data), digest, kind, origin if revisit else None))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    same(found, names, wanted)


def test_simhash(spark, given):
    folder, rows = given
    prints = [plain.simhash(plain.text_of(r)) for r in rows]
    least = plain.smallest_reachable(rows, prints)
    wanted = [(r["doc_id"], f"{p:016x}", c) for r, p, c in zip(rows, prints, least)]
    same(run(spark, "op4_", folder), ("doc_id", "fingerprint", "component_id"), wanted)


def test_quality_rules(spark, given):
    folder, rows = given
    wanted = []
    for r in rows:
        text = plain.text_of(r)
        wanted.append((r["doc_id"], *plain.base_rules(text), plain.cleaned(text)[1]))
    names = (
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )
    same(run(spark, "op5_", folder), names, wanted)


def test_merkle(spark, given):
    folder, rows = given
    found = run(spark, "op6_", folder)
    ordered = sorted(
        rows,
        key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain.text_of(r).encode()),
        reverse=True,
    )
    wanted = []
    for k, r in enumerate(ordered):
        text, after = plain.text_of(r), plain.text_of(ordered[(k + 1) % len(ordered)])
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        wanted.append((r["doc_id"], len(text), plain.sha256(edited.encode())))
    same(found, ("doc_id", "n_chars", "edited_sha256"), wanted)
    by_id = {r["doc_id"]: plain.text_of(r) for r in rows}
    texts, roots = defaultdict(set), defaultdict(set)
    for r in found:
        texts[r["fingerprint"]].add(by_id[r["doc_id"]])
        roots[by_id[r["doc_id"]]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        same_root = r["fingerprint"] == r["edited_fingerprint"]
        assert same_root == (plain.sha256(by_id[r["doc_id"]].encode()) == r["edited_sha256"])
        assert (r["changed_sections"] == 0) or not same_root
        if same_root:
            assert r["near_edited"] == 1
    assert all(len(x) == 1 for x in [*texts.values(), *roots.values()])


def test_language_model(spark, given):
    folder, rows = given
    found = run(spark, "op7_", folder)
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    plain_rows = plain.unigrams(rows)
    same(found, names, [(r["doc_id"], *w[:4]) for r, w in zip(rows, plain_rows)])
    base = defaultdict(list)
    for r, w in zip(rows, plain_rows):
        base[r["doc_id"]].append(w[4])
    for r in found:
        assert any(abs(r["base_score"] - b) < 1e-6 * abs(b) for b in base[r["doc_id"]])
        assert r["score"] <= 0
    if folder == SMALL:
        out = [r for r in found if r["held_out"]]
        assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_repeated_passages(spark, given):
    folder, rows = given
    gone = plain.repeated_bytes(rows)
    wanted = [
        (r["doc_id"], *plain.span_digest(plain.text_of(r), g)) for r, g in zip(rows, gone)
    ]
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    same(run(spark, "op8_", folder), names, wanted)


def test_token_files(spark, given):
    folder, rows = given
    ordered = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    wanted, start = [], 0
    for r, ids in zip(ordered, plain.word_ids([plain.text_of(r) for r in ordered])):
        ids = ids + [1]
        wanted.append((r["doc_id"], start, len(ids), zlib.crc32(plain.as_u32(ids))))
        start += len(ids)
    same(run(spark, "op9_", folder), ("doc_id", "start", "n_tokens", "ids_crc32"), wanted)


def test_language_id(spark, given):
    folder, rows = given
    found = run(spark, "op10_", folder)
    same(
        found,
        ("doc_id", "held_out"),
        [(r["doc_id"], plain.crc_mod(r["doc_id"], 4) == 2) for r in rows],
    )
    wanted = Counter((r["doc_id"], w[0]) for r, w in zip(rows, plain.languages(rows)))
    assert Counter((r["doc_id"], r["lang_pred"]) for r in found) == wanted
    scores = {r["doc_id"]: w[1] for r, w in zip(rows, plain.languages(rows))}
    assert all(abs(r["score"] - scores[r["doc_id"]]) < 1e-3 for r in found)
    lettered = {r["doc_id"]: any(c.isalpha() for c in plain.text_of(r)) for r in rows}
    languages = {r["lang"] for r in rows}
    for r in found:
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not lettered[r["doc_id"]])
        assert r["lang_pred"] in languages | {"und"}
    if folder == SMALL:
        lang = {r["doc_id"]: r["lang"] for r in rows}
        out = [r for r in found if r["held_out"]]
        assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) > 0.97 * len(out)


def test_source_mixing(spark, given):
    folder, rows = given
    found = run(spark, "op11_", folder)
    sources = plain.mix_targets(rows)
    same(
        found,
        ("doc_id", "source", "size"),
        [(r["doc_id"], r["source"], len(plain.WORD.findall(plain.text_of(r)))) for r in rows],
    )
    taken: Counter = Counter()
    for r in found:
        size, target = sources[r["source"]]
        assert r["source_size"] == size and abs(r["target"] - target) <= 1e-9 * target
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, (_, target) in sources.items():
        largest = max(r["size"] for r in found if r["source"] == source)
        # A small source can be no nearer than its documents allow.
        assert abs(taken[source] - target) <= (largest if folder != SMALL else 0.02 * target)
    again = run(spark, "op11_", folder)
    same(again, tuple(found[0]), [tuple(r.values()) for r in found])


def test_lexical_search(spark, given):
    folder, rows = given
    items = edge_items()
    if folder == SMALL:
        table = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
        items = [(r["item_id"], r["text"]) for r in table]
    found = run(spark, "op12_", folder)
    same(found, ("item_id", "rank", "doc_id", "score"), plain.search(rows, items))


@pytest.mark.parametrize("which", ["small", "edge"])
def test_embedding_whitening(spark, tables, which):
    folder, vectors = tables["edge"], edge_vectors()
    if which == "small":
        folder = SMALL
        table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
        vectors = [(r["vec_id"], r["embedding"]) for r in table]
    found = run(spark, "op13_", folder)
    ids, deviations, explained, white = plain.whitened(vectors)
    parts = len(explained)
    assert parts == (3 if which == "edge" else 32)
    assert {r["n"] for r in found} == {len(ids)}
    assert {r["identity_error"] for r in found} <= {found[0]["identity_error"]}
    assert found[0]["identity_error"] < 1e-9
    wanted = [(i, d, c + 1) for i, d in zip(ids, deviations) for c in range(parts)]
    same(found, ("vec_id", "deviation", "component"), wanted)
    for c in range(parts):
        own = [r for r in found if r["component"] == c + 1]
        assert all(abs(r["explained"] / explained[c] - 1) < 1e-9 for r in own)
        got = sorted((r["deviation"], abs(r["whitened"])) for r in own)
        want = sorted(zip(deviations, np.abs(white[:, c]).tolist()))
        assert np.allclose(got, want, rtol=1e-7, atol=1e-9)
