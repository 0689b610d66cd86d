"""Event layers for Spark: raw events, cleaned events, hourly revenue.

Transforms are functions from DataFrame to DataFrame, built from Spark's own
expressions.
"""

from assayer.functions.masking import mask_email, mask_ip, register_sql_functions
from assayer.operators.accounting import drop_accounting, layer_summary
from assayer.operators.asof import join_as_of
from assayer.operators.contract import EVENT_CONTRACT, Contract, conform
from assayer.operators.gold import (
    Rollup,
    clean_revenue,
    negative_revenue,
    revenue_per_hour,
    revenue_rollup,
)
from assayer.operators.lineage import trace_gold_to_silver, trace_silver_to_bronze
from assayer.operators.silver import to_silver, to_strict_silver
from assayer.session import build_session
from assayer.sources.events import read_json_events, read_parquet_events
from assayer.sources.layers import current_table, drop_loads, ensure_namespaces, save_table
from assayer.sources.snapshots import (
    Ledger,
    audit,
    changes,
    expirable,
    ledger_of,
    read_as_of,
    sums_by_load,
)
from assayer.streaming.gold import RevenueStream
from assayer.streaming.silver import QuarantinedSilver

__all__ = [
    "Contract",
    "EVENT_CONTRACT",
    "Ledger",
    "QuarantinedSilver",
    "RevenueStream",
    "Rollup",
    "audit",
    "build_session",
    "changes",
    "clean_revenue",
    "conform",
    "current_table",
    "drop_accounting",
    "drop_loads",
    "ensure_namespaces",
    "expirable",
    "join_as_of",
    "layer_summary",
    "ledger_of",
    "mask_email",
    "mask_ip",
    "negative_revenue",
    "read_as_of",
    "read_json_events",
    "read_parquet_events",
    "register_sql_functions",
    "revenue_per_hour",
    "revenue_rollup",
    "save_table",
    "sums_by_load",
    "to_silver",
    "to_strict_silver",
    "trace_gold_to_silver",
    "trace_silver_to_bronze",
]
