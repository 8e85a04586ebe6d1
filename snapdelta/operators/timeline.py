"""When a slowly changing value took which value."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import whole_seconds
from snapdelta.operators.delta import previous_row
from snapdelta.schema import TIME


def change_points(
    df: DataFrame,
    values: Sequence[str],
    keys: Sequence[str],
    *,
    time: str = TIME,
    slice_seconds: int | None = None,
) -> DataFrame:
    """Rows at which an entity's values differ from its row before, its first row included. A return to an earlier
    value is a change; null counts as a value. (key, time) must be unique."""
    looked_back = previous_row(df.select(*keys, time, *values), values, keys, time, slice_seconds)
    differs = reduce(lambda a, b: a | b, [~F.col(v).eqNullSafe(F.col(f"prev_{v}")) for v in values])
    changed = looked_back.where(~F.col("has_prev") | differs)
    return changed.select(*keys, whole_seconds(time).alias("change_time"), *values)


def first_seen(df: DataFrame, value: str, keys: Sequence[str], *, time: str = TIME) -> DataFrame:
    """First time of each value, for entities that had more than one; null counts as a value."""
    seen = df.groupBy(*keys, value).agg(whole_seconds(F.min(time)).alias("change_time"))
    changing = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_values")).where(F.col("_values") > 1).select(*keys)
    return seen.join(changing, list(keys), "left_semi")


def first_state(df: DataFrame, value: str, keys: Sequence[str], *, time: str = TIME) -> DataFrame:
    """The earliest row's time and value per entity."""
    return df.groupBy(*keys).agg(
        whole_seconds(F.min(time)).alias("change_time"), F.min_by(value, time).alias(value)
    )
