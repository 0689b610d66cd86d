"""As-of join: for each row the last one of another table up to its time.

By union and windows over sorted keys, not by a join on a range. Time is cut into
spans, so that a key with very many rows, or the lack of any key, is no single group:
what a span inherits from the spans before it is found from one row per key and span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SPAN, _TIME, _SIDE, _FOUND, _ROW = "_span", "_time", "_side", "_found", "_row"


def join_as_of(
    rows: DataFrame,
    time: str,
    states: DataFrame,
    state_time: str,
    keys: Sequence[str] = (),
    span: str = "hour",
) -> DataFrame:
    """``rows`` with the columns of the last row of ``states`` at or before their time.

    ``keys`` are columns of both that must be equal (null to null); the other
    columns of ``states`` are added. Of two states of the same time the one with the
    greater values counts. Rows without a time, or before the first state, keep nulls;
    every row stays exactly once, repeated ones too.
    """
    names = [c for c in states.columns if c not in keys]
    held = F.struct(state_time, *[c for c in names if c != state_time])
    # From the state with the greatest time of those of a span.
    dated = states.where(F.col(state_time).isNotNull())
    changes = dated.select(
        *keys,
        F.date_trunc(span, state_time).alias(_SPAN),
        F.col(state_time).alias(_TIME),
        held.alias(_FOUND),
    )
    left = rows.select(
        *keys,
        F.date_trunc(span, time).alias(_SPAN),
        F.col(time).alias(_TIME),
        F.struct(*rows.columns).alias(_ROW),
    )

    # What was the state when a span began: one row per key and span on either side.
    last = changes.groupBy(*keys, _SPAN).agg(F.max(_FOUND).alias(_FOUND))
    wanted = left.select(*keys, _SPAN).distinct().withColumn(_FOUND, _none(changes, _FOUND))
    both = last.unionByName(wanted).groupBy(*keys, _SPAN).agg(F.max(_FOUND).alias(_FOUND))
    earlier = Window.partitionBy(*keys).orderBy(_SPAN)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    inherited = both.select(
        *keys,
        _SPAN,
        F.col(_SPAN).cast(changes.schema[_TIME].dataType).alias(_TIME),
        F.last(_FOUND, ignorenulls=True).over(earlier).alias(_FOUND),
    ).where(F.col(_FOUND).isNotNull())

    def side(frame: DataFrame, number: int) -> DataFrame:
        for name, other in ((_FOUND, changes), (_ROW, left)):
            if name not in frame.columns:
                frame = frame.withColumn(name, _none(other, name))
        return frame.withColumn(_SIDE, F.lit(number))

    # At equal times: what is inherited, the states, the rows.
    together = side(inherited, 0).unionByName(side(changes, 1)).unionByName(side(left, 2))
    order = Window.partitionBy(*keys, _SPAN).orderBy(
        F.col(_TIME), F.col(_SIDE), F.col(_FOUND)
    )
    state = F.last(_FOUND, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    dated_row = F.col(f"{_ROW}.{time}").isNotNull()
    joined = together.withColumn(_FOUND, F.when(dated_row, state)).where(F.col(_SIDE) == 2)
    return joined.select(f"{_ROW}.*", *[F.col(f"{_FOUND}.{c}").alias(c) for c in names])


def _none(frame: DataFrame, name: str) -> Column:
    return F.lit(None).cast(frame.schema[name].dataType)
