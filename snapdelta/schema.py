"""Row types of the statistics, and how each one is turned into per-entity increases."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCOPE = ("host", "database")
TIME = "snapshot_time"

_TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "wide": T.DecimalType(38, 0),
}


def _fields(kind: str, names: str) -> list[T.StructField]:
    return [T.StructField(name, _TYPES[kind]) for name in names.split()]


@dataclass(frozen=True)
class StatSpec:
    """One statistic.

    ``duplicates`` says how several rows of one entity in one snapshot become one: ``sum`` for rows that split an
    entity's work, ``max`` for rows that repeat it, ``None`` where the source cannot produce them.
    ``nullable`` names the counters the server may leave null for a time.
    """

    name: str
    columns: tuple[T.StructField, ...]
    keys: tuple[str, ...] = ()
    counters: tuple[str, ...] = ()
    gauges: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()
    duplicates: str | None = None
    leading: tuple[T.StructField, ...] = field(
        default=(
            T.StructField(TIME, T.TimestampType()),
            T.StructField("capture_version", T.StringType()),
        )
    )

    @property
    def schema(self) -> T.StructType:
        return T.StructType(list(self.leading) + list(self.columns))

    def present(self, df: DataFrame, names: tuple[str, ...]) -> list[str]:
        return [name for name in names if name in df.columns]


_STATEMENT_COLUMNS = (
    _fields("string", "username")
    + _fields("bigint", "userid queryid shared_blks_read shared_blks_hit shared_blks_written shared_blks_dirtied")
    + _fields("bigint", "temp_blks_read temp_blks_written")
    + _fields("double", "blk_read_time blk_write_time")
    + _fields("bigint", "rows")
    + _fields("double", "min_time max_time stddev_time")
    + _fields("bigint", "plans")
    + _fields("double", "min_exec_time max_exec_time stddev_exec_time min_plan_time max_plan_time stddev_plan_time")
    + _fields("bigint", "calls")
    + _fields("double", "total_time total_exec_time total_plan_time")
    + _fields("bigint", "wal_records wal_fpi")
    + _fields("wide", "wal_bytes")
    + _fields("string", "query")
)

# The nine statistics with the column names the server's catalog gives them.
STATS: dict[str, StatSpec] = {
    spec.name: spec
    for spec in (
        StatSpec(
            "pg_stat_database",
            tuple(
                _fields("boolean", "standby")
                + _fields("bigint", "oldest_transaction_age datid")
                + _fields("string", "datname")
                + _fields("bigint", "blks_read blks_hit")
                + _fields("timestamp", "stats_reset")
            ),
            keys=("datname", "datid"),
            counters=("blks_read", "blks_hit"),
        ),
        StatSpec(
            "pg_stat_activity",
            tuple(
                _fields("string", "wait_event wait_event_type")
                + _fields("bigint", "datid")
                + _fields("string", "datname query")
            ),
        ),
        StatSpec(
            "pg_stat_bgwriter",
            tuple(
                _fields("bigint", "checkpoints_timed checkpoints_req buffers_checkpoint buffers_clean buffers_backend")
                + _fields("timestamp", "stats_reset")
            ),
            keys=("stats_reset",),
            counters=(
                "checkpoints_timed",
                "checkpoints_req",
                "buffers_checkpoint",
                "buffers_clean",
                "buffers_backend",
            ),
        ),
        StatSpec("pg_settings", tuple(_fields("string", "name setting context category short_desc")), keys=("name",)),
        StatSpec(
            "pg_stat_progress_vacuum",
            tuple(
                _fields("string", "schemaname relname")
                + _fields("bigint", "pid datid")
                + _fields("string", "datname")
                + _fields("bigint", "relid")
                + _fields("string", "phase")
                + _fields("bigint", "heap_blks_total heap_blks_scanned heap_blks_vacuumed")
            ),
            keys=("relid",),
        ),
        StatSpec(
            "pg_stat_statements",
            tuple(_STATEMENT_COLUMNS),
            keys=("username", "queryid", "query"),
            counters=(
                "shared_blks_read",
                "shared_blks_hit",
                "shared_blks_written",
                "shared_blks_dirtied",
                "calls",
                "total_exec_time",
                "temp_blks_read",
                "temp_blks_written",
                "blk_read_time",
                "blk_write_time",
                "rows",
                "wal_records",
                "wal_fpi",
                "wal_bytes",
            ),
            gauges=("min_exec_time", "max_exec_time", "stddev_exec_time"),
            nullable=("wal_records", "wal_fpi", "wal_bytes"),
            duplicates="sum",
        ),
        StatSpec(
            "table_stats",
            tuple(
                _fields("bigint", "relid")
                + _fields("string", "schemaname relname")
                + _fields("bigint", "n_live_tup n_dead_tup")
                + _fields("bigint", "vacuum_count autovacuum_count analyze_count autoanalyze_count")
                + _fields("bigint", "heap_blks_read heap_blks_hit idx_blks_read idx_blks_hit")
                + _fields("bigint", "toast_blks_read toast_blks_hit tidx_blks_read tidx_blks_hit")
            ),
            keys=("schemaname", "relname"),
            counters=(
                "heap_blks_read",
                "heap_blks_hit",
                "idx_blks_read",
                "idx_blks_hit",
                "toast_blks_read",
                "toast_blks_hit",
                "tidx_blks_read",
                "tidx_blks_hit",
                "vacuum_count",
                "autovacuum_count",
                "analyze_count",
                "autoanalyze_count",
            ),
            gauges=("n_live_tup", "n_dead_tup"),
            nullable=(
                "idx_blks_read",
                "idx_blks_hit",
                "toast_blks_read",
                "toast_blks_hit",
                "tidx_blks_read",
                "tidx_blks_hit",
            ),
        ),
        StatSpec(
            "index_stats",
            tuple(
                _fields("string", "conname schemaname")
                + _fields("bigint", "relid indexrelid")
                + _fields("string", "relname indexrelname")
                + _fields("bigint", "idx_scan idx_tup_read idx_tup_fetch idx_blks_read idx_blks_hit")
                + _fields("boolean", "indisunique indisprimary indisvalid")
                + _fields("string", "indkey")
            ),
            keys=("schemaname", "relname", "indexrelname"),
            counters=("idx_blks_read", "idx_blks_hit"),
            duplicates="max",
        ),
        StatSpec("version", tuple(_fields("string", "version aurora_version"))),
    )
}


def with_exec_time(df: DataFrame) -> DataFrame:
    """Statement rows with one set of execution-time columns, whichever server version wrote them."""
    for suffix in ("total", "min", "max", "stddev"):
        names = [n for n in (f"{suffix}_exec_time", f"{suffix}_time") if n in df.columns]
        if names:
            df = df.withColumn(f"{suffix}_exec_time", F.coalesce(*[F.col(n) for n in names]))
    return df.drop("total_time", "min_time", "max_time", "stddev_time")
