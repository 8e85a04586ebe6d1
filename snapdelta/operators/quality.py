"""Checks on the data a report rests on. Over a fleet each gives a status row per host and database."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import major_version
from snapdelta.schema import SCOPE, TIME

# Fixed value: a delta needs two snapshots.
MIN_SNAPSHOTS = 2


class DataQualityError(ValueError):
    """The window cannot give a report."""


def require_rows(df: DataFrame, what: str = "snapshots") -> DataFrame:
    """The frame itself, or an error when the window holds nothing."""
    if df.isEmpty():
        raise DataQualityError(f"no {what} in the window")
    return df


def snapshot_count(df: DataFrame, *, scope: Sequence[str] = SCOPE, time: str = TIME) -> DataFrame:
    """Distinct snapshots per scope and whether they are enough."""
    counted = df.groupBy(*scope).agg(F.countDistinct(time).alias("snapshots"))
    return counted.withColumn("ok", F.col("snapshots") >= MIN_SNAPSHOTS)


def snapshot_minutes(df: DataFrame, *, scope: Sequence[str] = SCOPE, time: str = TIME) -> DataFrame:
    """The minutes in which each scope has snapshots, as bitmaps: ``bucket`` and ``minutes``, 32,768 minutes a row.

    A task sends one bitmap per scope and bucket, however many rows it has read. Bitmaps of several lots of rows are put together
    by ``merge_minutes``, and ``count_minutes`` counts them.
    """
    minute = F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / 60).cast("long")
    placed = df.where(F.col(time).isNotNull()).select(*scope, F.bitmap_bucket_number(minute).alias("bucket"), F.bitmap_bit_position(minute).alias("_bit"))
    return placed.groupBy(*scope, "bucket").agg(F.bitmap_construct_agg("_bit").alias("minutes"))


def merge_minutes(bitmaps: DataFrame, *, scope: Sequence[str] = SCOPE) -> DataFrame:
    """One bitmap per scope and bucket of those of several lots of rows, which may share minutes."""
    return bitmaps.groupBy(*scope, "bucket").agg(F.bitmap_or_agg("minutes").alias("minutes"))


def count_minutes(bitmaps: DataFrame, *, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Distinct snapshots per scope, from merged bitmaps, and whether they are enough: captures are at least a minute apart."""
    counted = bitmaps.groupBy(*scope).agg(F.sum(F.bitmap_count("minutes")).alias("snapshots"))
    return counted.withColumn("ok", F.col("snapshots") >= MIN_SNAPSHOTS)


def stats_reset(df: DataFrame, *, scope: Sequence[str] = SCOPE, reset: str = "stats_reset") -> DataFrame:
    """Distinct reset times per scope (a null is none) and whether the counters ran through."""
    counted = df.groupBy(*scope).agg(F.countDistinct(reset).alias("resets"))
    return counted.withColumn("ok", F.col("resets") <= 1)


def database_stats_reset(df: DataFrame, *, scope: Sequence[str] = SCOPE, database: str | None = None) -> DataFrame:
    """``stats_reset`` for the database each capture was connected to."""
    current = F.lit(database) if database is not None else F.col("database")
    return stats_reset(df.where((F.col("datid") != 0) & (F.col("datname") == current)), scope=scope)


def one_engine(versions: DataFrame, *, scope: Sequence[str] = ()) -> DataFrame:
    """Engine kinds and major versions in use, and whether there is one of each."""
    kind = F.col("aurora_version").isNotNull() if "aurora_version" in versions.columns else F.lit(False)
    counted = versions.groupBy(*scope).agg(
        F.countDistinct(kind).alias("engines"),
        F.countDistinct(major_version("version")).alias("major_versions"),
    )
    return counted.withColumn("ok", (F.col("engines") <= 1) & (F.col("major_versions") <= 1))


def require_ok(status: DataFrame, message: str) -> DataFrame:
    """The status frame itself, or an error naming the first scope that fails."""
    failed = status.where(~F.col("ok")).first()
    if failed is not None:
        raise DataQualityError(f"{message}: {failed.asDict()}")
    return status
