"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them run over whole tables. Times are shown as ``timestamp_ntz`` and
sums as ``decimal(18,2)``, so that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from assayer.constants import LAYERS, SILVER_SCHEMA
from assayer.functions.masking import mask_email, mask_ip, register_sql_functions
from assayer.operators.accounting import drop_accounting, layer_summary_of
from assayer.operators.asof import join_as_of
from assayer.operators.contract import EVENT_CONTRACT, require_values
from assayer.operators.distinct import (
    SKETCH_ERROR,
    buyer_bitmaps,
    buyer_sketches,
    count_bitmaps,
    count_sketches,
    merge_bitmaps,
    merge_sketches,
)
from assayer.operators.gold import (
    MEASURES,
    Rollup,
    clean_revenue,
    negative_revenue,
    purchases,
    revenue_per_hour,
    revenue_rollup,
)
from assayer.operators.lineage import (
    bronze_rows_behind,
    trace_bronze_to_gold,
    trace_gold_to_silver,
    trace_silver_to_bronze,
)
from assayer.operators.silver import to_silver, to_strict_silver
from assayer.plans import fixture
from assayer.plans.layers import REVENUE_PER_LOAD
from assayer.session import OPEN_FILES, new_workspace, with_settings
from assayer.sources.events import (
    CORRUPT,
    ORIGIN,
    literal_rows,
    read_json_events,
    stream_json_events,
    with_origins,
)
from assayer.sources.layers import (
    APPEND,
    REPLACE,
    current_table,
    drop_loads,
    ensure_namespaces,
    save_table,
)
from assayer.sources.snapshots import (
    LOAD,
    Ledger,
    audit,
    changes,
    expirable,
    history,
    ledger_of,
    read_as_of,
    restored,
    sums_by_load,
)
from assayer.sources.variant import IS_CORRUPT, field_types, variant_field, with_variant
from assayer.streaming.gold import RevenueStream
from assayer.streaming.silver import QuarantinedSilver, start_silver

Query = Callable[[SparkSession, str], DataFrame]

SILVER_COLUMNS = [name for name in SILVER_SCHEMA.names if name != "processed_at"]
COUNTS = ("transaction_count", "unique_buyers")


def plain_time(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def plain_instant(name: str) -> Column:
    """A point in time as its UTC clock time, whatever the session zone is."""
    local = F.col(name).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local).alias(name)


def plain_sum(name: str) -> Column:
    return F.col(name).cast(DecimalType(18, 2)).alias(name)


def plain_gold(gold: DataFrame, spec: Rollup = Rollup()) -> DataFrame:
    """Group and measures of a rollup in comparable types."""
    measures = [F.col(m) if m in COUNTS else plain_sum(m) for m in MEASURES]
    return gold.select(plain_time(spec.bucket_name), *spec.keys, *measures)


def plain_silver(silver: DataFrame) -> DataFrame:
    times = ("event_ts", "ingested_at")
    return silver.select(
        *[plain_time(n) if n in times else F.col(n) for n in SILVER_COLUMNS]
    )


# -- Bronze -----------------------------------------------------------------


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.bronze_events(spark, sf_dir)


def bronze_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = fixture.event_props(spark, sf_dir)
    return parsed.select(
        "event_id",
        "props",
        F.col("parsed.k").alias("k"),
        F.col(f"parsed.{CORRUPT}").isNotNull().alias("is_corrupt"),
    )


def bronze_variant_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given texts as raw records: what is JSON has its field, the rest is corrupt."""
    parsed = with_variant(fixture.json_texts(spark, sf_dir), "record")
    return parsed.select(
        "source",
        "row_id",
        variant_field("$.k", "int").alias("k"),
        F.col(IS_CORRUPT).alias("is_corrupt"),
    )


def bronze_variant_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: records, corrupt ones, and how many fields of which types there are."""
    parsed = with_variant(fixture.json_texts(spark, sf_dir), "record")
    return field_types(parsed, "source").select(
        "source", "records", "corrupt_records", "field", "field_type", "field_records"
    )


def bronze_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_json_events(spark, fixture.json_landing(spark, sf_dir))
    return events.drop(CORRUPT, "quarter")


# -- Silver -----------------------------------------------------------------


def silver_required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = fixture.bronze_events(spark, sf_dir)
    kept = require_values(bronze, EVENT_CONTRACT.required)
    return kept.select("event_id", "user_id", "amount", "event_ts")


def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = fixture.bronze_events(spark, sf_dir).select(
        "event_id",
        *[
            EVENT_CONTRACT.typed(name).alias(name)
            for name in ("amount", "quantity", "event_ts", "ingested_at")
        ],
    )
    return typed.select(
        "event_id", "amount", "quantity", plain_time("event_ts"), plain_time("ingested_at")
    )


def silver_positive_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = EVENT_CONTRACT.typed("amount")
    typed = fixture.bronze_events(spark, sf_dir).select(
        "event_id", amount.alias("amount")
    )
    return typed.where(F.col("amount") > 0)


def silver_event_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = EVENT_CONTRACT.accepted["event_type"]
    bronze = fixture.bronze_events(spark, sf_dir).select("event_id", "event_type")
    return bronze.where(F.col("event_type").isin(*accepted))


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_silver(to_strict_silver(fixture.bronze_events(spark, sf_dir)))


def silver_processed_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row bears the time of its run, one time for all."""
    stamp = F.col("processed_at")
    return fixture.silver_events(spark, sf_dir).agg(
        F.count(stamp).alias("stamped_rows"),
        F.count_distinct(stamp).alias("times"),
        (F.max(stamp) <= F.current_timestamp()).alias("not_ahead"),
    )


def silver_drop_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_accounting(fixture.bronze_events(spark, sf_dir))


def mixed_drop_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_accounting(fixture.mixed_feed(spark, sf_dir))


def mixed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_silver(to_strict_silver(fixture.mixed_feed(spark, sf_dir)))


def mixed_required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = fixture.mixed_feed(spark, sf_dir)
    kept = require_values(mixed, EVENT_CONTRACT.required)
    return kept.select("event_id", "user_id", "amount", "event_ts")


def mixed_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw values that must change their type, next to what they become."""
    mixed = fixture.mixed_feed(spark, sf_dir)
    typed = mixed.select(
        "event_id",
        "user_id",
        F.col("quantity").alias("raw_quantity"),
        *[
            EVENT_CONTRACT.typed(name).alias(name)
            for name in ("amount", "quantity", "event_ts", "ingested_at")
        ],
    )
    return typed.select(
        "event_id", "user_id", "raw_quantity", "amount", "quantity",
        plain_time("event_ts"), plain_time("ingested_at"),
    )


def pii_email_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every e-mail address in the given texts, masked."""
    found = fixture.found_in_text(spark, sf_dir, fixture.EMAIL, "@")
    return found.select("source", "row_id", mask_email("value").alias("email_hash"))


def pii_ip_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every IPv4 address in the given texts, masked."""
    found = fixture.found_in_text(spark, sf_dir, fixture.IPV4, ".")
    return found.select("source", "row_id", mask_ip("value").alias("ip_masked"))


def pii_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both masks called from SQL text."""
    register_sql_functions(spark)
    return spark.sql(
        "SELECT source, row_id, 'email' AS kind, mask_email(value) AS masked FROM {mails} "
        "UNION ALL "
        "SELECT source, row_id, 'ipv4' AS kind, mask_ip(value) AS masked FROM {addresses}",
        mails=fixture.found_in_text(spark, sf_dir, fixture.EMAIL, "@"),
        addresses=fixture.found_in_text(spark, sf_dir, fixture.IPV4, "."),
    )


def pii_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every e-mail and IPv4 address of a document, masked, one row per match.

    The look-behind lets the pattern start at the first character of a word
    only. It finds the same matches and keeps the search linear in the text.
    """
    documents = fixture.table(spark, sf_dir, "documents")
    text = F.col("text")
    # Texts without the one character that every address has are not searched.
    mails = F.when(text.contains("@"), _matches(text, fixture.EMAIL))
    addresses = _matches(text, fixture.IPV4)
    found = documents.select(
        "doc_id",
        F.explode(F.concat(_named("email", mails), _named("ipv4", addresses))).alias("m"),
    )
    masked = F.when(F.col("m.kind") == "email", mask_email("m.value"))
    return found.select(
        "doc_id", "m.kind", masked.otherwise(mask_ip("m.value")).alias("masked")
    )


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _named(kind: str, values: Column) -> Column:
    """An array of structs with the kind of each value; none for null."""
    known = F.coalesce(values, F.array().cast("array<string>"))
    return F.transform(known, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


# -- Gold -------------------------------------------------------------------


def gold_revenue_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = revenue_per_hour(fixture.silver_events(spark, sf_dir))
    return plain_gold(gold).orderBy("hour_bucket", "category")


def _distinct_buyers(
    rows: DataFrame, number: Column, spec: Rollup, grain: str, keys: tuple[str, ...]
) -> DataFrame:
    """Distinct buyers of a coarser grain from sets per hour: exact, and whether the
    estimate of the sketches is within four standard errors of it."""
    group = [f"{grain}_bucket", *keys]
    bitmaps = merge_bitmaps(buyer_bitmaps(rows, number, spec), grain, keys, spec)
    sketches = merge_sketches(buyer_sketches(rows, spec), grain, keys, spec)
    exact, about = count_bitmaps(bitmaps, group), count_sketches(sketches, group)
    error = F.abs(F.col("estimated_buyers") - F.col("unique_buyers"))
    allowed = F.greatest(F.lit(1.0), 4 * SKETCH_ERROR * F.col("unique_buyers"))
    return exact.join(about, group).select(
        plain_time(group[0]), *keys, "unique_buyers", (error <= allowed).alias("sketch_is_near")
    )


def gold_buyers_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases(fixture.silver_events(spark, sf_dir))
    return _distinct_buyers(rows, F.col("user_id"), Rollup(), "day", ("category",))


def gold_buyers_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Across categories, from the same sets."""
    rows = purchases(fixture.silver_events(spark, sf_dir))
    return _distinct_buyers(rows, F.col("user_id"), Rollup(), "month", ())


def order_buyers_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per month and priority, from sets per day."""
    rows = fixture.orders(spark, sf_dir)
    spec = fixture.ORDERS_PER_DAY
    return _distinct_buyers(rows, F.col("o_custkey"), spec, "month", spec.keys)


def orders_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = fixture.ORDERS_PER_DAY
    return plain_gold(revenue_rollup(fixture.orders(spark, sf_dir), spec), spec)


def lineitem_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = fixture.LINEITEM_PER_DAY
    return plain_gold(revenue_rollup(fixture.lineitem(spark, sf_dir), spec), spec)


def gold_total_clean_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sum of the balances that are not negative."""
    accounts = fixture.accounts(spark, sf_dir)
    return clean_revenue(accounts).select(plain_sum("total_revenue"))


def gold_negative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balances an audit objects to."""
    bad = negative_revenue(fixture.accounts(spark, sf_dir))
    return bad.select("c_custkey", plain_sum("total_revenue"))


def gold_negative_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, negative rows and change in rows of every snapshot of the accounts."""
    accounts = fixture.accounts(spark, sf_dir)
    negative = F.count_if(F.col("total_revenue") < 0)
    return audit(ledger_of(accounts), sums_by_load([accounts], negative_rows=negative))


def layer_summary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = layer_summary_of(fixture.bronze_events(spark, sf_dir))
    return report.withColumn("total_revenue", plain_sum("total_revenue"))


def layer_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: all three layers written, then summed up from the tables."""
    layers = fixture.new_layers(spark, "build")
    layers.build(fixture.bronze_events(spark, sf_dir))
    return layers.summary().withColumn("total_revenue", plain_sum("total_revenue"))


def layer_build_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of the mixed feed's build, from what was counted during the writes."""
    counts = fixture.new_layers(spark, "counts").build(fixture.mixed_feed(spark, sf_dir))
    return counts.summary().withColumn("total_revenue", plain_sum("total_revenue"))


def layer_build_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why rows of the mixed feed were left out, counted during the write of Bronze."""
    return fixture.new_layers(spark, "drops").build(fixture.mixed_feed(spark, sf_dir)).drops()


def layer_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codec of every file of the written layers, and the rows in such files."""
    layers = fixture.written_layers(spark, sf_dir)
    codec = F.regexp_extract("_metadata.file_name", r"\.([a-z0-9]+)\.parquet$", 1)
    found = [
        layers.read(layer).select(F.lit(layer).alias("layer"), codec.alias("codec"))
        for layer in LAYERS
    ]
    together = reduce(DataFrame.unionByName, found)
    return together.groupBy("layer", "codec").agg(F.count(F.lit(1)).alias("rows"))


def layer_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold by its name in the catalog, after two replaces and an append."""
    first, second, third = fixture.loads()
    layers = fixture.new_layers(spark, "tables")
    layers.build(fixture.bronze_events(spark, sf_dir))
    layers.build(fixture.bronze_events(spark, sf_dir, first | second))
    layers.append(fixture.bronze_events(spark, sf_dir, third), 1)
    return plain_gold(spark.table(layers.name("gold")), REVENUE_PER_LOAD)


# -- Versions ---------------------------------------------------------------

# A snapshot in the middle of the feed, which a later one goes back to.
MIDDLE = 14


def _daily_ledger(daily: DataFrame) -> Ledger:
    return ledger_of(daily, fixture.new_period(), time="hour_bucket")


def _restored_ledger(daily: DataFrame) -> Ledger:
    return restored(_daily_ledger(daily), MIDDLE, after=timedelta(days=1))


def _plain_snapshots(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        "snapshot_id",
        plain_instant("committed_at"),
        "operation",
        "added_records",
        "total_records",
    )


def snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table right after the last append."""
    daily = fixture.daily_gold(spark, sf_dir)
    return plain_gold(read_as_of(daily, _daily_ledger(daily)))


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was in the middle of the feed."""
    daily = fixture.daily_gold(spark, sf_dir)
    return plain_gold(read_as_of(daily, _daily_ledger(daily), MIDDLE))


def snapshot_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current rows after a restore."""
    daily = fixture.daily_gold(spark, sf_dir)
    return plain_gold(read_as_of(daily, _restored_ledger(daily)))


def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_snapshots(history(_restored_ledger(fixture.daily_gold(spark, sf_dir))))


def snapshot_history_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest snapshots and the rows they leave, asked for in SQL."""
    daily = fixture.daily_gold(spark, sf_dir)
    ledger = _restored_ledger(daily)
    return spark.sql(
        """
        SELECT snapshot_id, operation, total_records,
          (SELECT count(*) FROM {current}) AS current_rows
        FROM {ledger}
        ORDER BY committed_at DESC, snapshot_id DESC LIMIT 5
        """,
        current=read_as_of(daily, ledger),
        ledger=ledger.snapshots,
    )


def snapshot_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that could go a week after the newest snapshot's loads came."""
    ledger = _daily_ledger(fixture.daily_gold(spark, sf_dir))
    now = F.max("committed_at").over(Window.partitionBy())
    return expirable(ledger, now).select(
        LOAD, plain_instant("committed_at"), "added_records"
    )


#: A batch of Gold as somebody typed it in: times as text, amounts as floats, and revenue
#: below zero, which no healthy row has.
INCIDENT = (
    ("2024-02-01T00:00:00", "k1", -50.0, 1, -50.0, -50.0, -50.0, 1),
    ("2024-02-01T00:00:00", "k2", -200.0, 2, -100.0, -50, "-150.00", 2),
)


def _incident(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold as a table to which the batch was appended."""
    work = new_workspace(spark, "incident")
    base = f"incident_{uuid.uuid4().hex[:12]}"
    ensure_namespaces(spark, work, [base])
    name = f"`{base}`.gold"
    gold = revenue_per_hour(fixture.silver_events(spark, sf_dir))
    load = F.lit(0).cast("bigint")
    save_table(gold.withColumn(LOAD, load), "gold", name, REPLACE, split_by=LOAD)
    typed = literal_rows(spark, INCIDENT, gold.schema).withColumn(LOAD, load + 1)
    save_table(typed, "gold", name, APPEND, split_by=LOAD)
    return spark.table(name)


def incident_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the append did to the number of rows, and the negative ones it brought."""
    table = _incident(spark, sf_dir)
    negative = F.count_if(F.col("total_revenue") < 0)
    sums = sums_by_load([table], negative_rows=negative, revenue=F.sum("total_revenue"))
    return audit(ledger_of(table), sums).withColumn("revenue", plain_sum("revenue"))


def incident_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows in which the table differs from the good snapshot."""
    table = _incident(spark, sf_dir)
    found = changes(table, ledger_of(table), 0, 1, ["hour_bucket", "category"])
    return found.select(
        plain_time("hour_bucket"), "category", plain_sum("total_revenue"), "change", "times"
    )


def incident_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows after going back to the good snapshot."""
    table = _incident(spark, sf_dir)
    ledger = restored(ledger_of(table), 0, after=timedelta(hours=1))
    return plain_gold(read_as_of(table, ledger))


def snapshot_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a table of daily loads once retention has been applied."""
    work = new_workspace(spark, "retention")
    base = f"retention_{uuid.uuid4().hex[:12]}"
    ensure_namespaces(spark, work, [base])
    name = f"`{base}`.daily"
    save_table(fixture.daily_gold(spark, sf_dir), "gold", name, REPLACE, split_by=LOAD)
    table = spark.table(current_table(spark, name))
    ledger = _daily_ledger(table)
    newest = F.max("committed_at").over(Window.partitionBy())
    gone = [r[LOAD] for r in expirable(ledger, newest).collect()]
    drop_loads(spark, name, LOAD, gone)
    return plain_gold(spark.table(name), REVENUE_PER_LOAD)


def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers whose spending of a week differs between two days, row by row."""
    rolling = fixture.rolling_buyers(spark, sf_dir)
    ledger = ledger_of(rolling, replaces=F.lit(True))
    found = changes(rolling, ledger, MIDDLE, MIDDLE + 4, ["user_id"])
    return found.withColumn("revenue", plain_sum("revenue"))


def events_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the snapshot of daily Gold that was the newest at its time."""
    ledger = _daily_ledger(fixture.daily_gold(spark, sf_dir))
    states = ledger.snapshots.select("committed_at", "snapshot_id", "total_records")
    events = fixture.table(spark, sf_dir, "events")
    events = events.select("event_id", F.col("ts").cast("timestamp").alias("at"))
    found = join_as_of(events, "at", states, "committed_at", span="day")
    return found.select(
        "event_id", plain_time("at"), plain_time("committed_at"), "snapshot_id", "total_records"
    )


def events_after_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the newest purchase of the same user up to then."""
    events = fixture.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    bought = fixture.table(spark, sf_dir, "events").where("event_type = 'purchase'")
    bought = bought.select(
        "user_id", F.col("ts").alias("bought_at"), F.col("event_id").alias("purchase_id")
    )
    return join_as_of(events, "ts", bought, "bought_at", keys=["user_id"], span="day")


# -- Lineage, on written tables -------------------------------------------------


def lineage_gold_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = fixture.written_layers(spark, sf_dir)
    traced = trace_gold_to_silver(
        layers.read("gold"), layers.read("silver"), REVENUE_PER_LOAD
    )
    return traced.select(
        plain_time("hour_bucket"),
        "category",
        LOAD,
        plain_sum("total_revenue"),
        "transaction_count",
        "event_id",
        "amount",
    )


def lineage_gold_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events behind all Gold rows, unchanged, with their load."""
    layers = fixture.written_layers(spark, sf_dir)
    sold = trace_gold_to_silver(
        layers.read("gold"), layers.read("silver"), REVENUE_PER_LOAD, carry=ORIGIN
    )
    return bronze_rows_behind(sold, with_origins(layers.read("bronze"))).drop(*ORIGIN)


def lineage_bronze_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold rows that the raw events of the last load went into."""
    layers = fixture.written_layers(spark, sf_dir)
    bronze = with_origins(layers.read("bronze").where(F.col(LOAD) == 2))
    touched = trace_bronze_to_gold(
        bronze, layers.read("silver"), layers.read("gold"), REVENUE_PER_LOAD
    )
    measures = [F.col(m) if m in COUNTS else plain_sum(m) for m in MEASURES]
    return touched.select(plain_time("hour_bucket"), "category", LOAD, *measures, "bronze_rows")


def lineage_silver_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many Silver rows of each load have how many rows of origin."""
    layers = fixture.written_layers(spark, sf_dir)
    keys = [LOAD, *ORIGIN]
    counted = trace_silver_to_bronze(
        layers.read("silver"), with_origins(layers.read("bronze")), keys
    )
    return counted.groupBy(LOAD, "silver_rows", "bronze_rows").agg(
        F.count(F.lit(1)).alias("origins")
    )


# -- Streams ----------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixture.json_landing(spark, sf_dir)
    return stream_json_events(spark, path, files_per_batch=fixture.FILES_PER_BATCH)


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "stream-silver")
    events = _event_stream(spark, sf_dir)
    start_silver(events, f"{work}/silver", f"{work}/checkpoint").awaitTermination()
    return plain_silver(spark.read.schema(SILVER_SCHEMA).parquet(f"{work}/silver"))


def _quarantined(spark: SparkSession, sf_dir: str) -> QuarantinedSilver:
    work = new_workspace(spark, "quarantine")
    landing = fixture.mixed_landing(spark, sf_dir)
    feed = stream_json_events(spark, landing, files_per_batch=fixture.MIXED_PER_BATCH)
    silver = QuarantinedSilver(f"{work}/silver")
    with with_settings(spark, {OPEN_FILES: "8"}):
        silver.start(feed, f"{work}/checkpoint").awaitTermination()
    return silver


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a stream has set aside, as they came, with the reason."""
    rejected = _quarantined(spark, sf_dir).read_quarantine(spark)
    columns = ("event_id", "user_id", "event_type", "category", "amount", "event_ts")
    return rejected.select("reason", *columns, "quantity")


def stream_quarantine_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows the same stream has kept."""
    return plain_silver(_quarantined(spark, sf_dir).read_silver(spark))


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after several micro-batches, each of which touches all hours.

    Hours stay open for as long as the feed's files may be behind each other.
    """
    work = new_workspace(spark, "stream-gold")
    revenue = RevenueStream(work, keep=fixture.FEED_SPAN)
    events = to_silver(_event_stream(spark, sf_dir))
    revenue.start(events, f"{work}/checkpoint").awaitTermination()
    return plain_gold(revenue.read_gold(spark))


QUERIES: dict[str, Query] = {
    "bronze_events": bronze_events,
    "bronze_json_fields": bronze_json_fields,
    "bronze_json_events": bronze_json_events,
    "silver_required_fields": silver_required_fields,
    "silver_typed": silver_typed,
    "silver_positive_amount": silver_positive_amount,
    "silver_event_enum": silver_event_enum,
    "silver_events": silver_events,
    "silver_drop_accounting": silver_drop_accounting,
    "pii_email_hash": pii_email_hash,
    "pii_ip_mask": pii_ip_mask,
    "pii_sql_functions": pii_sql_functions,
    "pii_documents": pii_documents,
    "gold_revenue_per_hour": gold_revenue_per_hour,
    "gold_total_clean_revenue": gold_total_clean_revenue,
    "gold_negative_rows": gold_negative_rows,
    "gold_negative_audit": gold_negative_audit,
    "orders_per_day": orders_per_day,
    "lineitem_per_day": lineitem_per_day,
    "layer_summary": layer_summary_report,
    "layer_build": layer_build,
    "layer_tables": layer_tables,
    "snapshot_append": snapshot_append,
    "snapshot_history": snapshot_history,
    "snapshot_history_sql": snapshot_history_sql,
    "snapshot_as_of": snapshot_as_of,
    "snapshot_restore": snapshot_restore,
    "snapshot_expire": snapshot_expire,
    "lineage_gold_to_silver": lineage_gold_to_silver,
    "lineage_gold_to_bronze": lineage_gold_to_bronze,
    "lineage_silver_to_bronze": lineage_silver_to_bronze,
    "lineage_bronze_to_gold": lineage_bronze_to_gold,
    "stream_silver": stream_silver,
    "stream_gold": stream_gold,
    "stream_quarantine": stream_quarantine,
    "stream_quarantine_silver": stream_quarantine_silver,
    "mixed_drop_accounting": mixed_drop_accounting,
    "mixed_silver": mixed_silver,
    "mixed_required_fields": mixed_required_fields,
    "mixed_typed": mixed_typed,
    "bronze_variant_fields": bronze_variant_fields,
    "bronze_variant_drift": bronze_variant_drift,
    "layer_codecs": layer_codecs,
    "silver_processed_at": silver_processed_at,
    "incident_audit": incident_audit,
    "incident_changes": incident_changes,
    "incident_recovery": incident_recovery,
    "layer_build_counts": layer_build_counts,
    "layer_build_drops": layer_build_drops,
    "gold_buyers_per_day": gold_buyers_per_day,
    "gold_buyers_per_month": gold_buyers_per_month,
    "order_buyers_per_month": order_buyers_per_month,
    "snapshot_retention": snapshot_retention,
    "snapshot_changes": snapshot_changes,
    "events_as_of": events_as_of,
    "events_after_purchase": events_after_purchase,
}
