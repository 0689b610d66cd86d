"""The data contract of a cleaned table: rules, reasons and exact schema."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    FloatType,
    NumericType,
    StructField,
    StructType,
    TimestampType,
)

from assayer.constants import EVENT_TYPES, REQUIRED_FIELDS, SILVER_SCHEMA
from assayer.functions.coercion import coerce

OK = "ok"
MISSING_REQUIRED = "missing_required"


@dataclass(frozen=True)
class Contract:
    """What a raw row must satisfy to be kept.

    ``required`` are raw columns that must hold a value, ``positive`` must be
    above zero once they have their final type, and ``accepted`` lists the
    values a column may take. ``schema`` is the exact result.
    """

    schema: StructType
    required: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def typed(self, name: str) -> Column:
        """Raw column ``name`` in its contract type, null where it does not fit."""
        return coerce(F.col(name), self.schema[name].dataType)

    def _coerced_names(self, raw: DataFrame) -> list[str]:
        """Required columns whose raw type differs from the contract type."""
        return [
            f.name
            for f in self.schema.fields
            if f.name in self.required
            and raw.schema[f.name].dataType != f.dataType
        ]

    def reasons(self, raw: DataFrame) -> list[tuple[str, Column]]:
        """(reason, is violated) in the order in which they are judged.

        Each condition is true or false, never null.
        """
        missing = reduce(
            lambda a, b: a | b,
            [is_missing(raw, name) for name in self.required],
            F.lit(False),
        )
        rules = [(MISSING_REQUIRED, missing)]
        by_time_first = sorted(
            self._coerced_names(raw),
            key=lambda n: not isinstance(self.schema[n].dataType, TimestampType),
        )
        for name in by_time_first:
            numeric = isinstance(self.schema[name].dataType, NumericType)
            reason = f"{name}_out_of_range" if numeric else f"bad_{name}"
            rules.append((reason, self.typed(name).isNull()))
        for name in self.positive:
            is_positive = F.coalesce(self.typed(name) > 0, F.lit(False))
            rules.append((f"non_positive_{name}", ~is_positive))
        for name, values in self.accepted.items():
            known = F.col(name).isin(*values)
            rules.append((f"bad_{name}", F.col(name).isNull() | ~known))
        return rules

    def reason_names(self, raw: DataFrame) -> list[str]:
        """All reasons in order, ending with ``ok``."""
        return [reason for reason, _ in self.reasons(raw)] + [OK]

    def first_reason(self, raw: DataFrame) -> Column:
        """The first violated rule of a row, or ``ok``."""
        (reason, violated), *rest = self.reasons(raw)
        chain = F.when(violated, F.lit(reason))
        for reason, violated in rest:
            chain = chain.when(violated, F.lit(reason))
        return chain.otherwise(F.lit(OK))

    def keep(self, raw: DataFrame) -> DataFrame:
        """Rows that violate nothing, still with raw types.

        Says the same as ``first_reason(raw) == "ok"``, but as separate
        conditions: the null checks, the accepted values and the sign of a raw
        number reach the Parquet scan, where they skip whole row groups.
        """
        kept = require_values(raw, self.required)
        for name, values in self.accepted.items():
            kept = kept.where(F.col(name).isin(*values))
        for name in self.positive:
            if isinstance(raw.schema[name].dataType, NumericType):
                # A raw value of zero or less cannot round to more than zero.
                kept = kept.where(F.col(name) > 0)
            # Null after the cast covers NaN and overflow as well.
            kept = kept.where(self.typed(name) > 0)
        for name in self._coerced_names(raw):
            if name not in self.positive:
                kept = kept.where(self.typed(name).isNotNull())
        return kept


EVENT_CONTRACT = Contract(
    schema=SILVER_SCHEMA,
    required=REQUIRED_FIELDS,
    positive=("amount",),
    accepted={"event_type": EVENT_TYPES},
)


def is_missing(raw: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating-point column."""
    column = F.col(name)
    if isinstance(raw.schema[name].dataType, (DoubleType, FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def require_values(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Rows in which all ``names`` hold a value (neither null nor NaN)."""
    for name in names:
        df = df.where(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            df = df.where(~F.isnan(name))
    return df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns, order, types and nullability of ``schema``.

    Extra columns are dropped and missing nullable columns become null. A null
    in a non-null column fails the job: the contract is checked, not assumed.
    """
    present = set(df.columns)
    checked = df.select(
        *[
            _never_null(f, df.schema[f.name].dataType)
            if not f.nullable and df.schema[f.name].nullable
            else F.col(f.name)
            for f in schema.fields
            if f.name in present
        ]
    )
    return checked.to(schema)


def checked(column: Column, f: StructField) -> Column:
    """A column that fails the job where it is null and the contract forbids that."""
    if f.nullable:
        return column
    fail = F.raise_error(F.lit(f"contract: null in non-null column {f.name}"))
    return F.coalesce(column, fail.cast(f.dataType))


def _never_null(f: StructField, actual: DataType) -> Column:
    fail = F.raise_error(F.lit(f"contract: null in non-null column {f.name}"))
    # The last argument is never reached. It only tells the analyzer that the
    # result cannot be null.
    unreached = _placeholder(actual)
    return F.coalesce(F.col(f.name), fail.cast(actual), unreached).alias(f.name)


def _placeholder(of: DataType) -> Column:
    name = of.simpleString()
    if name == "timestamp":
        return F.expr("timestamp'1970-01-01 00:00:00'")
    if name == "timestamp_ntz":
        return F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    if name == "date":
        return F.expr("date'1970-01-01'")
    if name == "string":
        return F.lit("")
    if isinstance(of, NumericType):
        return F.lit(0).cast(of)
    if name == "boolean":
        return F.lit(False)
    raise TypeError(f"no placeholder for a non-null column of type {name}")
