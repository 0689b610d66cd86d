"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import (
    ans,
    bpe,
    cube,
    langid,
    maxent,
    merkle,
    packing,
    quality,
    search,
    simhash,
    suffix,
    warc,
    whiten,
)
from assayer.llm.common import crc_mod
from assayer.session import new_workspace

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

MAX_TOKENS = 2048


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def _hex64(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(
        _documents(spark, sf_dir), BYTE_BPE, public_tokenizers.PATTERN
    )
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), WORD_BPE, MAX_TOKENS, end_id=0)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_workspace(spark, "warc")
    archives = warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.link_documents(_documents(spark, sf_dir), width=4, distance=4)
    return linked.select(
        "doc_id", _hex64("fingerprint").alias("fingerprint"), "component_id"
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_documents(spark, sf_dir))
    names = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_bad_lines", "kept_chars",
    )
    doc_id = F.col("document.doc_id").alias("doc_id")
    return judged.select(doc_id, *[F.col(f"quality.{n}").alias(n) for n in names])


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.edited_fingerprints(_documents(spark, sf_dir))
    own, changed = F.col("own"), F.col("changed")
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        own["root"].alias("fingerprint"),
        changed["root"].alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        merkle.changed_sections(own, changed).alias("changed_sections"),
    )


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_documents(_documents(spark, sf_dir), folds=7, held_out=2)


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.repeated_spans(_documents(spark, sf_dir))
    lost = F.col("n_bytes") - F.octet_length("kept")
    return found.select(
        "doc_id",
        "n_bytes",
        lost.cast("long").alias("n_removed"),
        F.size("begins").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_workspace(spark, "tokens")
    files = ans.write_ids(_documents(spark, sf_dir), folder, WORD_BPE, end_id=1)
    return ans.read_ids(spark, folder, files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    docs = _documents(spark, sf_dir)
    model = langid.train(docs.where(~held_out))
    return langid.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = cube.mix(_documents(spark, sf_dir), weights=(5, 2, 1), most=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "benchmark")
    return search.search(_documents(spark, sf_dir), items, k=10)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(_table(spark, sf_dir, "embeddings"), most=32)


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_warc": op3_warc,
    "op4_simhash": op4_simhash,
    "op5_quality_rules": op5_quality_rules,
    "op6_merkle": op6_merkle,
    "op7_language_model": op7_language_model,
    "op8_suffix_array": op8_suffix_array,
    "op9_token_files": op9_token_files,
    "op10_language_id": op10_language_id,
    "op11_source_mixing": op11_source_mixing,
    "op12_lexical_search": op12_lexical_search,
    "op13_embedding_whitening": op13_embedding_whitening,
}
