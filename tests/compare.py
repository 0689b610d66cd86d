"""Compare registered queries with their SQL: names, types, rows and values."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# The type of each engine under one name.
SPARK_TYPES = {
    "bigint": "int64",
    "int": "int32",
    "double": "double",
    "string": "string",
    "boolean": "bool",
    "timestamp_ntz": "timestamp",
}
DUCK_TYPES = {
    "BIGINT": "int64",
    "INTEGER": "int32",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "bool",
    "TIMESTAMP": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            connection.execute(
                f"create view {name} as select * from read_parquet('{files}')"
            )
    return connection


def spark_schema(df) -> dict[str, str]:
    return {
        f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
        for f in df.schema.fields
    }


def duck_schema(relation) -> dict[str, str]:
    return {
        name: DUCK_TYPES.get(str(t), str(t).lower().replace(" ", ""))
        for name, t in zip(relation.columns, relation.types)
    }


def sorted_rows(rows, columns: list[str], order: list[str]) -> list[tuple]:
    position = [columns.index(name) for name in order]
    picked = [tuple(row[i] for i in position) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(spark, query, sql: str, sf_dir: str) -> list[str]:
    """What differs, as text; an empty list means equal."""
    df = query(spark, sf_dir)
    relation = connect(sf_dir).sql(sql)
    found = []
    left, right = spark_schema(df), duck_schema(relation)
    if sorted(left) != sorted(right):
        return [f"columns {sorted(left)} != {sorted(right)}"]
    for name in left:
        if left[name] != right[name]:
            found.append(f"type of {name}: {left[name]} != {right[name]}")
    order = sorted(left)
    ours = sorted_rows([tuple(r) for r in df.collect()], df.columns, order)
    theirs = sorted_rows(relation.fetchall(), relation.columns, order)
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        found.append(f"{len(unequal)} unequal rows, first {order} {unequal[0]}")
    return found


if __name__ == "__main__":
    import time

    root = Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    from __spark_entry__ import oracle_sql, queries
    from assayer.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", {"spark.sql.shuffle.partitions": "8"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        if name not in oracle_sql():
            print(f"{name:28s} no SQL")
            continue
        began = time.time()
        try:
            result = differences(spark, query, oracle_sql()[name], sf_dir) or "equal"
        except Exception as error:  # noqa: BLE001 - report and go on
            result = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - began:6.2f}s {result}", flush=True)
