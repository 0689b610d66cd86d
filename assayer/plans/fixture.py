"""How the given tables are read as raw events, and tables derived from them.

``events`` becomes a feed of the Bronze shape. Every event is in it, with the
values it has; what the given table does not have is null. ``oracle.BRONZE``
says the same in SQL.
"""

from __future__ import annotations

import uuid
from datetime import timedelta
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from assayer.constants import BRONZE_SCHEMA
from assayer.functions.coercion import to_money
from assayer.operators.gold import Rollup, purchases, revenue_per_hour
from assayer.operators.silver import to_silver
from assayer.plans.layers import Layers
from assayer.session import OPEN_FILES, new_workspace, with_settings
from assayer.sources.events import parse_json
from assayer.sources.snapshots import LOAD

PROPS_SCHEMA = StructType([StructField("k", IntegerType())])
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# The feed arrives in three loads, cut at these days.
FIRST_CUT = "2024-01-11"
SECOND_CUT = "2024-01-21"

# Each landed file has events of the whole feed, which is no longer than this.
FEED_SPAN = timedelta(days=366)

# Compressed JSON can't be split, so that no file gets more rows than a task reads soon.
LANDED_ROWS = 1_000_000
LANDED_CODEC = "lz4"

# Files of the mixed feed in a micro-batch: with so few rows each, enough for many cores.
MIXED_PER_BATCH = 24

# Parquet that one task lands as JSON.
LANDED_BYTES = 128 * 2**20

# JSON files of a micro-batch. A batch does not grow with the landing folder.
FILES_PER_BATCH = 2

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
IPV4 = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"

ORDERS_PER_DAY = Rollup(
    ts="o_orderdate",
    grain="day",
    keys=("o_orderpriority",),
    amount="amount",
    row_id="o_orderkey",
    buyer="o_custkey",
)
LINEITEM_PER_DAY = Rollup(
    ts="l_shipdate",
    grain="day",
    keys=("l_returnflag",),
    amount="amount",
    row_id="l_orderkey",
    buyer="l_suppkey",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_events(
    spark: SparkSession, sf_dir: str, arrived: Column | None = None
) -> DataFrame:
    """``events`` in the Bronze shape; ``arrived`` picks a load by its ``ts``."""
    events = table(spark, sf_dir, "events")
    if arrived is not None:
        events = events.where(arrived)
    return as_bronze(events)


def as_bronze(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    ts, user = F.col("ts"), F.col("user_id").cast("string")
    # Parsed in a projection of its own, so once per row and not once per use.
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    tens = F.floor(F.col("k") / 10).cast("string")
    columns = {
        "event_id": F.col("event_id").cast("string"),
        "user_id": user,
        "session_id": F.concat(user, F.lit("-"), F.date_format(ts, "yyyyMMdd")),
        "event_type": F.col("event_type"),
        "product_id": F.col("k").cast("string"),
        "category": F.concat(F.lit("k"), tens),
        "amount": F.col("value"),
        "event_ts": F.date_format(ts, ISO_MICROS),
        "ingested_at": F.date_format(ts, ISO_MICROS),
    }
    named = [
        columns.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
        for f in BRONZE_SCHEMA.fields
    ]
    return events.select(*named, *keep)


def mixed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of several given tables in the Bronze shape, as a sender would mix them up.

    Each table is whole and its values are what they are; they are just not where the
    contract wants them, so that every one of its rules has rows that violate it:
    events as ever; orders with the customer's balance as amount (some are negative);
    line items with the ship date's microseconds as amount and quantity; parts with
    their name as time; documents with their quality label, which most do not have.
    """
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    sold = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    lines = table(spark, sf_dir, "lineitem")
    micros = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    parts = table(spark, sf_dir, "part")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    texts = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")

    def rows(frame: DataFrame, **columns: Column) -> DataFrame:
        return frame.select(
            *[
                columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in BRONZE_SCHEMA.fields
            ]
        )

    def text(time: str) -> Column:
        return F.date_format(time, ISO_MICROS)

    return reduce(
        DataFrame.unionByName,
        [
            bronze_events(spark, sf_dir),
            rows(
                sold,
                event_id=F.col("o_orderkey"),
                user_id=F.col("o_custkey"),
                event_type=F.when(F.col("o_orderstatus") == "F", F.lit("purchase")).otherwise(
                    F.col("o_orderstatus")
                ),
                category=F.col("o_orderpriority"),
                amount=F.col("c_acctbal"),
                event_ts=text("o_orderdate"),
                ingested_at=F.col("o_orderstatus"),
            ),
            rows(
                lines,
                event_id=F.concat_ws("-", "l_orderkey", "l_linenumber"),
                user_id=F.col("l_suppkey"),
                event_type=F.lit("purchase"),
                category=F.col("l_returnflag"),
                amount=F.when(F.col("l_linestatus") == "O", micros).otherwise(
                    F.col("l_extendedprice")
                ),
                quantity=F.when(F.col("l_returnflag") == "R", micros).otherwise(
                    F.col("l_quantity")
                ),
                event_ts=text("l_shipdate"),
            ),
            rows(
                parts,
                event_id=F.col("p_partkey"),
                user_id=F.col("p_brand"),
                event_type=F.lit("view"),
                amount=F.col("p_retailprice"),
                event_ts=F.col("p_name"),
            ),
            rows(
                texts,
                event_id=F.col("doc_id"),
                user_id=F.col("source"),
                event_type=F.lit("view"),
                category=F.col("lang"),
                amount=F.col("q"),
                event_ts=F.col("lang"),
            ),
        ],
    )


def mixed_landing(spark: SparkSession, sf_dir: str) -> str:
    """The mixed feed as a folder of JSON files."""
    names = ("events", "orders", "customer", "lineitem", "part", "documents", "labels")
    return _mixed_landing(spark, sf_dir, _state(spark, sf_dir, *names))


@cache
def _mixed_landing(spark: SparkSession, sf_dir: str, state: tuple) -> str:
    path = new_workspace(spark, "mixed")
    writer = mixed_feed(spark, sf_dir).write.mode("overwrite")
    writer = writer.option("compression", LANDED_CODEC)
    writer.option("maxRecordsPerFile", LANDED_ROWS).json(path)
    return path


def json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given texts that are JSON (``props`` of events) or are not (turns of
    conversations, documents, pages), as raw records."""
    sources = (
        ("events", "event_id", "props"),
        ("conversations", "conv_id", "text"),
        ("documents", "doc_id", "text"),
        ("pages", "page_id", "html"),
    )
    return reduce(
        DataFrame.unionByName,
        [
            table(spark, sf_dir, name).select(
                F.lit(name).alias("source"),
                F.col(row_id).alias("row_id"),
                F.col(text).alias("record"),
            )
            for name, row_id, text in sources
        ],
    )


def rolling_buyers(spark: SparkSession, sf_dir: str, days: int = 7) -> DataFrame:
    """What each buyer spent in the days up to each day; a day is a load."""
    day = F.to_date("event_ts")
    counted = purchases(silver_events(spark, sf_dir)).select(
        "user_id", "amount", F.explode(F.sequence(day, F.date_add(day, days - 1))).alias("day")
    )
    load = F.date_format("day", "yyyyMMdd").cast("bigint").alias(LOAD)
    return counted.groupBy(load, "user_id").agg(
        F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("purchases")
    )


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(bronze_events(spark, sf_dir))


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw JSON text of each event next to its parsed fields."""
    parsed = parse_json("props", PROPS_SCHEMA).alias("parsed")
    return table(spark, sf_dir, "events").select("event_id", "props", parsed)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = to_money(F.col("o_totalprice")).alias("amount")
    return table(spark, sf_dir, "orders").select("*", amount)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = to_money(F.col("l_extendedprice")).alias("amount")
    return table(spark, sf_dir, "lineitem").select("*", amount)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of customers, some of them negative; a market segment is a load."""
    balance = to_money(F.col("c_acctbal")).alias("total_revenue")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias(LOAD), balance
    )


def found_in_text(spark: SparkSession, sf_dir: str, pattern: str, sign: str) -> DataFrame:
    """Every match of a pattern in ``documents`` and ``pages``, one row each.

    ``sign`` is a character that no match is without: looking for it is much
    cheaper than the pattern, and most texts leave there.
    """
    sources = (("documents", "doc_id", "text"), ("pages", "page_id", "html"))

    def of(name: str, row_id: str, text: str) -> DataFrame:
        rows = table(spark, sf_dir, name).where(F.col(text).contains(sign))
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return rows.select(
            F.lit(name).alias("source"),
            F.col(row_id).alias("row_id"),
            F.explode(matches).alias("value"),
        )

    documents, pages = [of(*source) for source in sources]
    return documents.unionByName(pages)


def daily_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly revenue; the rows of a day are a load, numbered by the date."""
    gold = revenue_per_hour(silver_events(spark, sf_dir))
    day = F.date_format("hour_bucket", "yyyyMMdd").cast("bigint")
    return gold.withColumn(LOAD, day)


def new_period(load: str = LOAD) -> Column:
    """Whether a day's load begins the table anew: on the 1st, 11th, 21st, 31st."""
    return F.col(load) % 10 == 1


def loads() -> list[Column]:
    """The three loads of the feed; together they hold every event."""
    ts = F.col("ts")
    first = F.lit(FIRST_CUT).cast("timestamp_ntz")
    second = F.lit(SECOND_CUT).cast("timestamp_ntz")
    return [ts < first, (ts >= first) & (ts < second), ts >= second]


def new_layers(spark: SparkSession, purpose: str) -> Layers:
    """Layers in a folder and in databases of their own."""
    prefix = f"{purpose}_{uuid.uuid4().hex[:12]}_"
    return Layers(spark, new_workspace(spark, purpose), prefix)


def _state(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """Size and time of the files of some tables: differs when they have changed."""
    found = []
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        found += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(found)


def written_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The layers after three loads; written once per session and state of the events,
    then only read."""
    return _written_layers(spark, sf_dir, _state(spark, sf_dir, "events"))


@cache
def _written_layers(spark: SparkSession, sf_dir: str, state: tuple) -> Layers:
    layers = new_layers(spark, "layers")
    for number, arrived in enumerate(loads()):
        events = bronze_events(spark, sf_dir, arrived)
        if number:
            layers.append(events, number)
        else:
            layers.build(events)
    return layers


def json_landing(spark: SparkSession, sf_dir: str) -> str:
    """The feed as a folder of JSON files, to be read as a batch or as a stream.

    The files are split by the quarter of the hour in which an event happened,
    so that every hour, and most buyers, are spread over several micro-batches.
    No shuffle: each task writes the files of the rows it has, all open at once instead
    of one after the other from sorted rows. As many tasks as the events' size asks for,
    not as many as there are cores, so that a file, and with it a micro-batch, is worth
    its fixed costs. Written once per session and state of the events.
    """
    return _json_landing(spark, sf_dir, _state(spark, sf_dir, "events"))


@cache
def _json_landing(spark: SparkSession, sf_dir: str, state: tuple) -> str:
    path = new_workspace(spark, "landing")
    quarter = F.floor(F.minute("ts") / 15).alias("quarter")
    events = table(spark, sf_dir, "events").select("*", quarter)
    tasks = -(-sum(size for _, size, _ in state) // LANDED_BYTES)
    feed = as_bronze(events.coalesce(max(1, tasks)), keep=("quarter",))
    with with_settings(spark, {OPEN_FILES: "8"}):
        feed.write.mode("overwrite").partitionBy("quarter").json(path)
    return path
