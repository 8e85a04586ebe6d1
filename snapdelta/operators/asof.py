"""As-of join: beside each row the latest row of another frame that is not later, per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdelta.schema import TIME

_PERIOD, _MARKS, _CARRIED = "_period", "_marks", "_carried"


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    columns: Sequence[str],
    *,
    time: str = TIME,
    right_time: str = TIME,
    period: str = "month",
) -> DataFrame:
    """``left`` with ``columns`` of the latest ``right`` row of its group at or before its time; null where there is none.

    Rows of ``left`` are neither multiplied nor sorted by time. ``right`` is packed into one list per group and ``period``
    (a unit of ``date_trunc``; choose it so that a list stays short), with the last row before the period carried in; a row
    of ``left`` looks into the list of its own period. So a group of any size is dealt out by periods, and what every task
    needs beside a row is one list. Groups match null-safe. Of ``right`` rows with equal times the largest ``columns`` count;
    rows with a null time are none, on the left they match nothing. Columns of ``left`` with the names are replaced.
    """
    by, columns = list(by), list(columns)
    left = left.select(*[c for c in left.columns if c not in columns])
    place = lambda c: F.date_trunc(period, F.col(c).cast("timestamp"))
    mark = F.struct(F.col(right_time).alias("at"), *[F.col(c) for c in columns])
    marked = right.where(F.col(right_time).isNotNull()).select(*by, place(right_time).alias(_PERIOD), mark.alias("_mark"))
    packed = marked.groupBy(*by, _PERIOD).agg(F.sort_array(F.collect_set("_mark")).alias(_MARKS))
    # Periods in which only the left has rows need what is carried into them.
    asked = left.where(F.col(time).isNotNull()).select(*by, place(time).alias(_PERIOD)).distinct()
    empty = F.lit(None).cast(packed.schema[_MARKS].dataType).alias(_MARKS)
    periods = packed.unionByName(asked.select("*", empty)).groupBy(*by, _PERIOD).agg(F.max(_MARKS).alias(_MARKS))
    before = Window.partitionBy(*by).orderBy(_PERIOD).rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.element_at(_MARKS, -1), ignorenulls=True).over(before)
    lists = periods.select(*[F.col(c).alias(f"_of_{c}") for c in by], F.col(_PERIOD).alias("_of_period"), _MARKS, carried.alias(_CARRIED))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by] + [F.col(_PERIOD) == F.col("_of_period")]
    joined = left.withColumn(_PERIOD, place(time)).join(lists, reduce(lambda a, b: a & b, same), "left")
    # Not later than the row's time: of the period's list, else what was carried in.
    seen = F.filter(F.col(_MARKS), lambda m: m["at"] <= F.col(time))
    found = F.when(F.size(seen) > 0, F.element_at(seen, -1)).otherwise(F.col(_CARRIED))
    return joined.withColumn("_found", found).select(*left.columns, *[F.col("_found").getField(c).alias(c) for c in columns])
