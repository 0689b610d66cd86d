"""Masking of personal data with built-in expressions only.

Both masks stay inside whole-stage code generation: no Python worker is
started, and a filter next to them can still move down to the scan. Each rule is
stated once, as SQL text over its argument.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from assayer.constants import MASKED_IP_TAIL, MASKED_IP_UNKNOWN

# The address is hashed as it is: no trimming and no change of case.
EMAIL_RULE = "sha2({value}, 256)"
# The parts are not checked to be numbers. Everything that does not have four
# parts (IPv6 and the empty string too) is masked as a whole. Limit -1 keeps
# trailing empty parts: "1.2.3." has four parts.
IP_RULE = (
    "CASE WHEN size(split({value}, '[.]', -1)) = 4 "
    f"THEN concat(substring_index({{value}}, '.', 1), '{MASKED_IP_TAIL}') "
    f"WHEN {{value}} IS NOT NULL THEN '{MASKED_IP_UNKNOWN}' END"
)


def mask_email(email: str) -> Column:
    """SHA-256 of the address in a column as lower-case hex; null stays null."""
    return F.expr(EMAIL_RULE.format(value=email))


def mask_ip(ip: str) -> Column:
    """Keep the first of exactly four dot-separated parts; null stays null."""
    return F.expr(IP_RULE.format(value=ip))


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``mask_email`` and ``mask_ip`` callable from SQL text.

    They are SQL functions, which Catalyst inlines into the calling plan.
    """
    for name, argument, rule in (
        ("mask_email", "email", EMAIL_RULE),
        ("mask_ip", "ip", IP_RULE),
    ):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument} STRING) "
            f"RETURNS STRING RETURN {rule.format(value=argument)}"
        )
