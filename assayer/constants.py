"""Fixed values of the data contract.

Every value in this module must equal the published definition of the
layers, because results depend on it. They are stated once, here.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

TEXT = StringType()
TIME = TimestampType()
# Types of the money columns: an amount, and a sum of amounts.
MONEY = DecimalType(12, 2)
MONEY_TOTAL = DecimalType(22, 2)

# --- fixed values: raw events (Bronze) -------------------------------------
BRONZE_SCHEMA = (
    StructType()
    .add("event_id", TEXT)
    .add("user_id", TEXT)
    .add("session_id", TEXT)
    .add("event_type", TEXT)
    .add("product_id", TEXT)
    .add("product_name", TEXT)
    .add("category", TEXT)
    .add("amount", DoubleType())
    .add("currency", TEXT)
    .add("quantity", LongType())
    .add("email", TEXT)
    .add("ip_address", TEXT)
    .add("user_agent", TEXT)
    .add("country", TEXT)
    .add("event_ts", TEXT)
    .add("ingested_at", TEXT)
)

# --- fixed values: cleaned events (Silver) ---------------------------------
SILVER_SCHEMA = (
    StructType()
    .add("event_id", TEXT, nullable=False)
    .add("user_id", TEXT, nullable=False)
    .add("session_id", TEXT)
    .add("event_type", TEXT, nullable=False)
    .add("product_id", TEXT)
    .add("product_name", TEXT)
    .add("category", TEXT)
    .add("amount", MONEY, nullable=False)
    .add("currency", TEXT)
    .add("quantity", IntegerType())
    .add("email_hash", TEXT)
    .add("ip_masked", TEXT)
    .add("country", TEXT)
    .add("event_ts", TIME, nullable=False)
    .add("ingested_at", TIME)
    .add("processed_at", TIME, nullable=False)
)
REQUIRED_FIELDS = ("user_id", "amount", "event_id", "event_ts")
EVENT_TYPES = ("purchase", "add_to_cart", "view", "wishlist", "checkout")
MASKED_IP_TAIL = ".x.x.x"
MASKED_IP_UNKNOWN = "x.x.x.x"

# --- fixed values: revenue (Gold) ------------------------------------------
REVENUE_EVENT = "purchase"
REVENUE_GRAIN = "hour"

# --- fixed values: storage -------------------------------------------------
LAYERS = ("bronze", "silver", "gold")
LAYER_CODECS = {"bronze": "snappy", "silver": "zstd", "gold": "zstd"}
HISTORY_LENGTH = 5
RETENTION_DAYS = 7
