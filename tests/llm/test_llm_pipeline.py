"""The corpus pipeline against its stages in plain Python."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from plain import SMALL

import corpus_pipeline


def staged(spark, docs, folder, upto):
    from assayer.llm.common import written

    for name, stage in corpus_pipeline.STAGES[:upto]:
        docs = written(spark, stage(spark, docs, folder), f"test-{name}")
    return docs


def rules(rows):
    kept = []
    for row in rows:
        text, stays = plain.cleaned(plain.text_of(row))
        if stays:
            kept.append(row | {"text": text, "n_chars": len(text)})
    return kept


def one_of_each_group(rows):
    prints = [plain.simhash(r["text"]) for r in rows]
    groups = defaultdict(list)
    for row, group in zip(rows, plain.components(prints)):
        groups[group].append(row)
    return [min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"])) for g in groups.values()]


def without_repeats(rows):
    kept = []
    for row, gone in zip(rows, plain.repeated_bytes(rows)):
        data = np.frombuffer(row["text"].encode(), np.uint8)[~gone].tobytes()
        text = data.decode("utf-8", "ignore")
        if data or not row["text"]:
            kept.append(row | {"text": text, "n_chars": len(text)})
    return kept


def test_stages_one_after_another(spark, small_rows):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    wanted = small_rows
    # The given documents all have a language: the second stage keeps them.
    for upto, step in enumerate((rules, lambda r: r, one_of_each_group, without_repeats), 1):
        wanted = step(wanted)
        if upto in (2, 4):
            found = staged(spark, docs, SMALL, upto)
            assert found.columns == docs.columns
            assert Counter(map(tuple, found.collect())) == Counter(
                tuple(row[c] for c in docs.columns) for row in wanted
            )
    assert 0 < len(wanted) < len(small_rows)
    pieces = []
    for row, ids in zip(wanted, plain.word_ids([r["text"] for r in wanted])):
        ids = ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            crc = zlib.crc32(plain.as_u32(part))
            pieces.append((row["doc_id"], piece, start, len(part), crc))
    result = corpus_pipeline.run(spark, SMALL)
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[n] for n in names) for r in result.collect()) == Counter(pieces)


@pytest.mark.parametrize("which", ["edge", "empty"])
def test_every_stage_takes_any_rows(spark, tables, which):
    folder = tables[which]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        # Each stage on the raw rows, not only on what its predecessors keep.
        found = stage(spark, docs, folder)
        if name != "best_fit_packing":
            assert found.columns == docs.columns
            assert [f.dataType for f in found.schema] == [f.dataType for f in docs.schema]
        sizes.append(found.count())
    if which == "empty":
        assert set(sizes) == {0}
    else:
        assert 0 < sizes[1] < sizes[0] and 0 < sizes[3] < sizes[0]
        assert sizes[5] >= sizes[0]
    assert corpus_pipeline.run(spark, folder).count() >= (which == "edge")


def test_near_duplicates_keep_one_row_of_repeated_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words are here now"), (None, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert Counter(map(tuple, found)) == Counter([rows[0], rows[2]])


def test_language_stage_rejects_languages_it_never_learned(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pick = np.random.default_rng(3)

    def letters(alphabet: str) -> str:
        return " ".join("".join(pick.choice(list(alphabet), 6)) for _ in range(80))

    short = docs.where("lang is not null").limit(40).selectExpr(
        "doc_id + 2000000 as doc_id", "substring_index(text, ' ', 50) as text", "lang"
    )
    foreign = [(1_000_000 + i, letters("бвгдежзиклмн"), None) for i in range(5)]
    random = [(1_000_100 + i, letters("abcdefghijklmnopqrstuvwxyz"), None) for i in range(5)]
    more = spark.createDataFrame(foreign + random, "doc_id long, text string, lang string")
    given = docs.select("doc_id", "text", "lang").union(short).union(more)
    found = {r["doc_id"] for r in corpus_pipeline.language_id(spark, given, "").collect()}
    clean = {r["doc_id"] for r in given.collect()} - {r[0] for r in foreign + random}
    assert found == clean
