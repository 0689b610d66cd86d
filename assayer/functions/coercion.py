"""Type coercions that never fail a job on bad input.

Under ANSI mode a plain cast raises on the first bad row. Each function here
gives null instead, and the contract then decides whether null is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegerType, TimestampType

from assayer.constants import MONEY, MONEY_TOTAL


def coerce(value: Column, to: DataType) -> Column:
    """``value`` as type ``to``, or null where it does not fit."""
    if isinstance(to, TimestampType):
        return F.try_to_timestamp(value)
    if isinstance(to, IntegerType):
        return F.when(_may_fit(value, 2**31 + 1), value.try_cast(to))
    if isinstance(to, DecimalType):
        return F.when(_may_fit(value, 10 ** (to.precision - to.scale)), value.try_cast(to))
    return value.try_cast(to)


def _may_fit(value: Column, bound: int) -> Column:
    """False for numbers that can't fit, by their size alone.

    The cast throws and catches an exception for each of them, which costs twenty times
    what the comparison does. What is no number is left to the cast.
    """
    return F.coalesce(F.abs(value.try_cast("double")) <= float(bound), F.lit(True))


def to_money(value: Column) -> Column:
    """Amount with two decimals, rounded half up; null when out of range."""
    return coerce(value, MONEY)


def bucket(ts: Column, grain: str) -> Column:
    """Start of the ``grain`` (hour, day, ...) that holds ``ts``."""
    return F.date_trunc(grain, ts)


def exact_average(total: Column, count: Column) -> Column:
    """``total / count`` rounded half up to six and then to two decimals.

    This is what ``round(avg(amount), 2)`` gives for a decimal(12,2) column,
    but computed from a sum and a count, which can be merged. All of it is
    division of whole numbers, so that there is no group too large for it. A
    group without amounts has the average null.
    """
    whole = DecimalType(19, 0)
    # Null instead of a division by zero.
    n = F.nullif(count, F.lit(0)).cast(whole)
    cents = (F.abs(total.cast(MONEY_TOTAL)) * 100).cast(DecimalType(24, 0))
    quotient, rest = _div(cents, n), cents % n
    # Four more digits, then half up; away from zero, as the sign comes last.
    millionths = quotient * 10_000 + _div(rest * 20_000 + n, n * 2)
    rounded = _div(millionths + 5_000, F.lit(10_000))
    signed = F.when(total < 0, -rounded).otherwise(rounded)
    return (signed.cast(DecimalType(16, 0)) / F.lit(100)).cast(DecimalType(13, 2))


def _div(part: Column, whole: Column) -> Column:
    """The integral part of a quotient, as a bigint."""
    return F.call_function("div", part, whole)
