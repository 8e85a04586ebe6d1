"""Day summaries beside the lake: made while days land, read by reports over long windows.

Layout: ``stat=/snapshot_date=/`` of one row per entity (``operators.summaries``). A window's whole days come from there; the
rest of its first and last day is summarised from the snapshots themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdelta.operators.quality import DataQualityError
from snapdelta.operators.summaries import FIELDS, FIRST, LAST, PERIOD, period_summaries
from snapdelta.plans.tables import DEAD_ROWS
from snapdelta.schema import SCOPE, STATS, with_exec_time
from snapdelta.sources.lake import _in_scope, _open, as_utc, conformed, require_utc

DAY = timedelta(days=1)


def summarised(df: DataFrame, stat: str, *, fold: bool = True) -> DataFrame:
    """Day summaries of a statistic's snapshots, with all its counters that they have; ``fold=False`` where no entity has several
    rows in one snapshot."""
    spec = STATS[stat]
    if not spec.counters:
        raise ValueError(f"{stat} counts nothing")
    rows = with_exec_time(df) if stat == "pg_stat_statements" else df
    gauges = set(spec.gauges) <= set(rows.columns) and stat == "table_stats"
    return period_summaries(
        rows,
        spec.present(rows, spec.counters),
        [*SCOPE, *spec.keys],
        duplicates=spec.duplicates if fold else None,
        sums={name: F.expr(sql) for name, sql in DEAD_ROWS.items()} if gauges else None,
    )


def land_days(df: DataFrame, root: str, stat: str, *, fold: bool = True) -> None:
    """Summarise whole days and put them in place of what was there for these days; other days stay."""
    require_utc(df.sparkSession)
    days = summarised(conformed(df, stat), stat, fold=fold)
    dated = days.select("*", F.lit(stat).alias("stat"), F.to_date(PERIOD).alias("snapshot_date"))
    order = [c for c in (*SCOPE, *STATS[stat].keys)]
    (
        dated.hint("rebalance", "snapshot_date", "host")
        .sortWithinPartitions("snapshot_date", *order)
        .write.partitionBy("stat", "snapshot_date")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(root)
    )


def day_schema(stat: str) -> T.StructType:
    """The row type of a statistic's day summaries, with all counters it may have."""
    spec = STATS[stat]
    kinds = {field.name: field.dataType for field in spec.schema}
    struct = lambda kind: T.StructType([T.StructField(f, kind) for f in FIELDS])
    return T.StructType(
        [T.StructField(c, kinds.get(c, T.StringType())) for c in (*SCOPE, *spec.keys)]
        + [T.StructField(c, T.TimestampType()) for c in (PERIOD, FIRST, LAST)]
        + [T.StructField("snapshots", T.LongType())]
        + [T.StructField(c, struct(kinds[c])) for c in spec.counters]
        + [T.StructField(c, T.LongType()) for c in (DEAD_ROWS if stat == "table_stats" else ())]
        + [T.StructField("stat", T.StringType()), T.StructField("snapshot_date", T.DateType())]
    )


def whole_days(start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """The first midnight and the one after the last whole day of a window that holds the seconds of both its ends."""
    first = as_utc(start).replace(microsecond=0)
    after = as_utc(end).replace(microsecond=0) + timedelta(seconds=1)
    midnight = lambda t: t.replace(hour=0, minute=0, second=0)
    return midnight(first) if first == midnight(first) else midnight(first) + DAY, midnight(after)


def read_days(
    spark: SparkSession, root: str, stat: str, start: datetime, end: datetime, *, hosts: Sequence[str] | None = None, databases: Sequence[str] | None = None
) -> DataFrame:
    """Summaries of the whole days of a window; a counter that the servers did not have is null."""
    first, after = whole_days(start, end)
    rows = _open(spark.read.format("parquet").option("basePath", root).schema(day_schema(stat)), f"{root}/stat={stat}", stat)
    rows = rows.where((F.col("snapshot_date") >= F.lit(first.date())) & (F.col("snapshot_date") < F.lit(after.date())))
    return _in_scope(rows, hosts, databases).drop("stat", "snapshot_date")


def window_summaries(
    spark: SparkSession,
    root: str,
    stat: str,
    start: datetime,
    end: datetime,
    raw: Callable[[datetime, datetime], DataFrame],
    *,
    fold: bool = True,
    hosts: Sequence[str] | None = None,
    databases: Sequence[str] | None = None,
) -> DataFrame:
    """All of a window as summaries: its whole days as they were landed, what lies before and after them from snapshots.

    ``raw(start, end)`` gives the snapshots of a stretch (both ends included, by the second), for example with ``read_compacted``; a stretch
    without any may raise ``DataQualityError``. Give the result to a plan, or to ``build_report`` as one of its ``summaries``.
    """
    first, after = whole_days(start, end)
    if first >= after:
        stretches, frames = [(as_utc(start), as_utc(end))], []
    else:
        second = timedelta(seconds=1)
        stretches = [(as_utc(start), first - second)] if as_utc(start) < first else []
        stretches += [(after, as_utc(end))] if as_utc(end) >= after else []
        try:
            frames = [read_days(spark, root, stat, start, end, hosts=hosts, databases=databases)]
        except DataQualityError:
            frames = []
    for a, b in stretches:
        try:
            rows = conformed(_in_scope(raw(a, b), hosts, databases), stat)
        except DataQualityError:
            continue
        frames.append(summarised(rows, stat, fold=fold))
    if not frames:
        raise DataQualityError(f"no snapshots of {stat} in the window")
    whole = frames[0]
    for more in frames[1:]:
        whole = whole.unionByName(more, allowMissingColumns=True)
    return whole
