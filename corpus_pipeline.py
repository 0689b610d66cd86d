"""A corpus pipeline of five stages over the table ``documents``.

Each stage calls one operator of ``assayer.llm`` on all that its predecessor
kept; its result is written as Parquet and read again as the next one's input.
All but the last return the columns of their input.

1. Quality rules: lines that fail are removed from the texts, and documents
   that the rules reject go.
2. Language: documents without a recognised language go, and those whose n-grams
   are far less likely in it than is usual there (a language that was never
   learned, random letters). The model is learned from the labelled documents
   outside the fold that op10 holds out; what is usual, from those in it.
3. Near-duplicates: of each group one document stays, that with the smallest id.
4. Repeated passages: every byte that the operator marks is removed; characters
   that lose a byte go as a whole, and so do documents of which nothing is left.
5. Packing: the pieces of all documents and their places in the sequences.

Defined results: the stages' operators state what becomes of nulls, empty texts
and ties. Where no language can be learned, stage 2 keeps all documents.
``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import langid, packing, quality, simhash, suffix
from assayer.llm.common import crc_mod, written
from assayer.llm.queries import MAX_TOKENS, WORD_BPE

#: A language must be at least this likely.
LEAST_SCORE = 0.5
#: The log probability of a document's n-gram may be so many deviations below the
#: mean of its language; a single n-gram deviates by about GRAM_DEVIATION. A language
#: whose few documents are much alike has LEAST_SPREAD.
DEVIATIONS = 6.0
LEAST_SPREAD = 0.3
GRAM_DEVIATION = 5.0


def _with_text(columns: list[str], source: str, text: Column) -> list[Column]:
    """The columns of a document with another text and its length."""
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return [changed.get(c, F.col(f"{source}.`{c}`")).alias(c) for c in columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = quality.judge(docs).where("quality.kept")
    return kept.select(_with_text(docs.columns, "document", F.col("quality.clean_text")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learned_from = F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(True))
    model = langid.train(docs.where(learned_from))
    if not model.languages:
        return docs
    found = langid.predict_rows(docs, model)
    known = F.col("language.lang_pred") != langid.UNKNOWN
    known &= F.col("language.score") >= LEAST_SCORE
    # Of documents not learned from, whose n-grams are as unusual as new ones'.
    fitted = langid.predict_rows(docs.where(~learned_from), model).where(
        known & (F.col("document.lang") == F.col("language.lang_pred"))
    )
    fitted = fitted.groupBy("language.lang_pred").agg(
        F.avg("language.per_gram").alias("mean"), F.stddev("language.per_gram").alias("spread")
    )
    # One row per learned language; a language with fewer than two has no bound.
    usual = F.lit(True)
    for row in fitted.where("spread is not null").collect():
        noise = F.lit(GRAM_DEVIATION**2) / F.greatest("language.grams", F.lit(1))
        spread = max(row["spread"], LEAST_SPREAD)
        bound = row["mean"] - DEVIATIONS * F.sqrt(spread**2 + noise)
        other = F.col("language.lang_pred") != row["lang_pred"]
        usual &= other | (F.col("language.per_gram") >= bound)
    kept = found.where(known & usual)
    return kept.select([F.col(f"document.`{c}`").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    linked = simhash.link_documents(docs, width=4, distance=4, carry=docs.columns)
    return linked.where("stays").select(
        [F.col(f"carried.`{c}`").alias(c) for c in docs.columns]
    )


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c != "text"]
    found = suffix.repeated_spans(docs, carry=others, as_text=True)
    left = found.where((F.octet_length("kept") > 0) | (F.col("n_bytes") == 0))
    return left.select(_with_text(docs.columns, "carried", F.col("kept")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, WORD_BPE, MAX_TOKENS, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the fingerprints nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
