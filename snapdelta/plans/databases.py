"""Snapshot, cluster and database-level reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import (
    BLOCK_SIZE,
    blocks_to_bytes,
    hit_ratio,
    human_bytes,
    percent_of,
    role_text,
    version_label,
)
from snapdelta.operators.share import with_totals
from snapdelta.operators.summaries import increase
from snapdelta.operators.timeline import change_points, first_state
from snapdelta.plans.findings import LOW_HIT_RATIO, finding, on_hosts
from snapdelta.schema import SCOPE, STATS, TIME

SPEC = STATS["pg_stat_database"]
# Fixed value: the id under which the server counts objects shared by all databases.
SHARED_OBJECTS = 0


def snapshot_summary(df: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Number of snapshots, the first and the last one."""
    return df.groupBy(*scope).agg(
        F.countDistinct(TIME).alias("total_snapshots"),
        F.min(TIME).alias("first_snapshot"),
        F.max(TIME).alias("last_snapshot"),
    )


def cluster_versions(versions: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Every server version seen in the window."""
    kept = [c for c in ("aurora_version",) if c in versions.columns]
    return versions.select(*scope, version_label("version").alias("version"), *kept).distinct()


def aurora_hosts(versions: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Scopes whose engine reports the second version; without a scope one row if any does."""
    places = list(scope) or [F.lit(True).alias("any")]
    if "aurora_version" not in versions.columns:
        return versions.where(F.lit(False)).select(*places)
    return versions.where(F.col("aurora_version").isNotNull()).select(*places).distinct()


def _roles(databases: DataFrame, scope: Sequence[str]) -> DataFrame:
    own = databases.where(F.col("datid") != SHARED_OBJECTS)
    return own.groupBy(*scope, TIME).agg(F.max("standby").alias("standby"))


def role_change_points(databases: DataFrame, scope: Sequence[str] = SCOPE, **options) -> DataFrame:
    """When each server became primary or standby."""
    changes = change_points(_roles(databases, scope), ["standby"], list(scope), **options)
    return changes.withColumn("standby", role_text("standby"))


def role_at_start(databases: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """The role in the first snapshot of the window."""
    return first_state(_roles(databases, scope), "standby", list(scope)).withColumn("standby", role_text("standby"))


def database_increase(
    databases: DataFrame, *, scope: Sequence[str] = SCOPE, block_size: int = BLOCK_SIZE, **increase_options
) -> DataFrame:
    """I/O per database with its share of all reads of the scope (shared objects count in the total)."""
    increase_options.setdefault("gaps", "lag")
    grown = increase(databases, SPEC.counters, [*scope, *SPEC.keys], **increase_options)
    sized = grown.select(
        *scope,
        "datname",
        "datid",
        hit_ratio("increase_blks_read", "increase_blks_hit").alias("hit_ratio"),
        blocks_to_bytes("increase_blks_read", block_size).alias("read_bytes"),
        blocks_to_bytes("increase_blks_hit", block_size).alias("hit_bytes"),
    )
    shared = with_totals(sized, {"_read": F.sum("read_bytes")}, scope)
    return shared.where(F.col("datid") != SHARED_OBJECTS).select(
        *sized.columns,
        human_bytes("read_bytes").alias("read_text"),
        human_bytes("hit_bytes").alias("hit_text"),
        percent_of("_read", "read_bytes").alias("io_percent"),
    )


def _current(database: str | None, scope: Sequence[str] = SCOPE) -> Column:
    if database is None and "database" not in scope:
        raise ValueError("name the current database: the scope has no database column")
    return F.col("datname") == (F.lit(database) if database is not None else F.col("database"))


def _by_share(df: DataFrame, scope: Sequence[str]) -> DataFrame:
    order = [F.desc("io_percent"), F.desc("read_bytes"), F.desc("hit_bytes"), F.asc("datname")]
    return df.orderBy(*scope, *order)


def database_io(increase: DataFrame, database: str | None = None, scope: Sequence[str] = SCOPE) -> DataFrame:
    """The database the capture was connected to (the ``database`` column unless one is named)."""
    return _by_share(increase.where(_current(database, scope)), scope)


def remainder_io(increase: DataFrame, database: str | None = None, scope: Sequence[str] = SCOPE) -> DataFrame:
    """The other databases of the server, by their share of reads."""
    return _by_share(increase.where(~_current(database, scope)), scope)


def database_findings(
    io: DataFrame, aurora: DataFrame | None = None, scope: Sequence[str] = SCOPE
) -> DataFrame:
    """A low cache-hit ratio of the current database, on the hosts in ``aurora`` (all when unset)."""
    low = on_hosts(io.where(F.col("hit_ratio") < LOW_HIT_RATIO), aurora, scope)
    return finding(
        low, "database", "The cache-hit ratio is below 99%; review the buffer size and the statements that read most.", scope
    )

