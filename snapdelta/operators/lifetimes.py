"""Lives of entities: the stretches between a reset, or a drop and a new creation, in which a counter only counts up.

A life is an island of equal marks in an entity's timeline: a table's ``relid`` changes when it is dropped and created again
under its name, a database's ``stats_reset`` when its counters are set back. Deltas that cross from one life to the next are
no activity; ``lives`` of ``counter_delta``, ``counter_increase`` and ``period_summaries`` names the marks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.operators.asof import as_of_join
from snapdelta.operators.delta import _ENTITY, _window, any_null
from snapdelta.schema import SCOPE, TIME

RESET = "life_since"


def _numbered(df: DataFrame, marks: Sequence[str], keys: Sequence[str], time: str) -> DataFrame:
    """Rows with ``life``: how many times their entity's marks had changed, plus one. Rows move once, by entity."""
    placed = df.withColumn(_ENTITY, F.xxhash64(*keys)).repartition(_ENTITY)
    over = _window([_ENTITY, *keys], time)
    same = " and ".join(f"lag(`{m}`) over {over} <=> `{m}`" for m in marks)
    changed = placed.withColumn("_new", F.expr(f"case when row_number() over {over} = 1 or not ({same}) then 1L else 0L end"))
    return changed.withColumn("life", F.expr(f"sum(_new) over {over}")).drop("_new")


def lifetimes(df: DataFrame, marks: Sequence[str], keys: Sequence[str], *, time: str = TIME) -> DataFrame:
    """One row per life: the keys, ``life`` (from 1, in order of time), its marks, ``first_time``, ``last_time``, ``snapshots``.

    A mark that comes back opens a new life; null is a mark like others. An entity has one row per snapshot. Rows with a null
    key are no entity and have no lives; an empty frame has none.
    """
    entities = df.where(~any_null(keys)).select(*keys, time, *[m for m in marks if m not in keys])
    lives = _numbered(entities, marks, keys, time).groupBy(_ENTITY, *keys, "life")
    kept = [m for m in marks if m not in keys]
    out = lives.agg(
        *[F.any_value(m).alias(m) for m in kept], F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.count(F.lit(1)).alias("snapshots")
    )
    return out.drop(_ENTITY)


def database_resets(databases: DataFrame, *, scope: Sequence[str] = SCOPE, database: str | None = None, reset: str = "stats_reset") -> DataFrame:
    """The times at which the counters of each scope's current database were reset, as far as snapshots tell."""
    rows = databases
    if {"datid", "datname"} <= set(rows.columns):
        current = F.lit(database) if database is not None else F.col("database")
        rows = rows.where((F.col("datid") != 0) & (F.col("datname") == current))
    return rows.where(F.col(reset).isNotNull()).select(*scope, F.col(reset).alias(RESET)).distinct()


def since_reset(df: DataFrame, resets: DataFrame, *, scope: Sequence[str] = SCOPE, time: str = TIME) -> DataFrame:
    """Adds ``life_since``, the latest of its scope's resets at or before a row's time: a mark for the rows of any statistic.

    Snapshots of different statistics are taken at different times; the reset itself has a time, so rows are put into lives by that.
    """
    return as_of_join(df, resets.withColumn("_at", F.col(RESET)), scope, [RESET], time=time, right_time="_at")
