from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from edges import edge_items, edge_texts, edge_vectors  # noqa: E402
from plain import SMALL  # noqa: E402

#: Columns that bear the names operators use for their own.
CLASHING = (
    "fingerprint", "component_id", "quality", "document", "language", "carried", "row",
    "sequence_id", "offset", "ids", "block", "learn", "key", "bucket", "copy", "own",
    "words", "kept", "stays", "n_tokens", "start", "digest", "refers_to", "score",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{name}` string" for name in CLASHING
)
ITEMS_SCHEMA = "item_id long, text string, item_key string, item int, rank string, score long"
VECTORS_SCHEMA = "vec_id long, embedding array<float>, label int, vector string, n long, dims int"
PAGES_SCHEMA = "page_id long, url string, html string, digest string, first_id long, file string"


@pytest.fixture(scope="session")
def edge_rows() -> list[dict]:
    rows = []
    for k, (doc_id, text) in enumerate(edge_texts()):
        row = {"doc_id": doc_id, "text": text}
        row["lang"] = None if k % 4 == 0 else ("en" if k % 2 else "de")
        row["source"] = None if k % 3 == 0 else "s"
        row["n_chars"] = None if k % 5 == 0 else len(text or "")
        row |= {name: None if k % 2 else "clash" for name in CLASHING}
        rows.append(row)
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    names = ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
    values = [tuple(row[n] for n in names) for row in edge_rows]
    return spark.createDataFrame(values, SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tables(spark, edge_docs, no_docs, tmp_path_factory):
    """Folders with the edge rows and with empty tables, as queries read them."""
    root = tmp_path_factory.mktemp("tables")
    pages = [
        (1, "http://a", "<p>x</p>", "clash", 5, None),
        (2, None, "<p>x</p>", None, None, "f"),
        (3, "http://c\r\nX: y", None, None, None, None),
        (4, "http://d", "", None, None, None),
        (5, "http://e", "é漢\r\n\r\n" * 3000, None, None, None),
        (None, "http://f", "<p>x</p>", None, None, None),
        (6, "http://g", "alone", None, None, None),
        (6, "http://g", "alone", None, None, None),
    ]
    items = [(i, text, "clash", 1, None, 5) for i, text in edge_items()]
    vectors = [(i, v, None, "clash", 3, 2) for i, v in edge_vectors()]
    for name, docs, *rest in (
        ("edge", edge_docs, pages, items, vectors),
        ("empty", no_docs, [], [], []),
    ):
        docs.write.parquet(f"{root}/{name}/documents.parquet")
        schemas = (PAGES_SCHEMA, ITEMS_SCHEMA, VECTORS_SCHEMA)
        for table, rows, schema in zip(("pages", "benchmark", "embeddings"), rest, schemas):
            frame = spark.createDataFrame(rows, schema)
            frame.write.parquet(f"{root}/{name}/{table}.parquet")
    return {"edge": f"{root}/edge", "empty": f"{root}/empty", "pages": pages}


@pytest.fixture(scope="session")
def small_rows(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]

