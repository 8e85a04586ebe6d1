"""The queries checked against SQL: each reads the driver's tables through the fixture views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdelta.functions.scalars import epoch_seconds, major_version, parse_report_window, report_time, truncated
from snapdelta.functions.sql_functions import register_sql_functions
from snapdelta.operators import catalog, quality
from snapdelta.operators.delta import counter_delta, counter_increase, elapsed_delta, one_row_per_snapshot
from snapdelta.operators.lifetimes import database_resets, lifetimes, since_reset
from snapdelta.operators.summaries import increase_from_summaries, merge_summaries, period_summaries
from snapdelta.plans.deltas import stat_deltas
from snapdelta.plans import bgwriter, databases, indexes, report, sessions, settings, statements, tables
from snapdelta.registry.fixtures import table, view
from snapdelta.schema import SCOPE
from snapdelta.sources import clustered, days, lake
from snapdelta.sources.shared import shared_dir
from snapdelta.streaming.deltas import DeltaStream
from snapdelta.streaming.ingest import FoldingIngest, land_stream, stream_snapshots
from snapdelta.streaming.waits import WaitCounts, land_wait_windows

Query = Callable[[SparkSession, str], DataFrame]

STATEMENT_KEYS = [*SCOPE, "username", "queryid", "query"]
CAPTURE = ["snapshot_time"]
LIMIT = 10
CURRENT_DATABASE = "NATION_7"

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def _fixture(name: str, make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(view(spark, sf_dir, name))


def _gaps(df: DataFrame) -> DataFrame:
    """Statement rows whose call counter is missing on some days."""
    missing = (F.col("queryid") % 5 == 0) & (F.dayofmonth("snapshot_time") % 7 == 3)
    return df.withColumn("calls", F.when(~missing, F.col("calls")))


# --- delta engine ---------------------------------------------------------------------------------------------------


@query
def counter_delta_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = counter_delta(view(spark, sf_dir, "fx_statements"), ["calls", "shared_blks_read", "wal_bytes"], STATEMENT_KEYS)
    return deltas.select(*STATEMENT_KEYS, "snapshot_time", "delta_calls", "delta_shared_blks_read", "delta_wal_bytes")


@query
def counter_delta_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = counter_delta(_gaps(view(spark, sf_dir, "fx_statements")), ["calls"], STATEMENT_KEYS)
    return deltas.select(*STATEMENT_KEYS, "snapshot_time", "delta_calls")


@query
def counter_delta_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = ["checkpoints_timed", "buffers_checkpoint"]
    deltas = counter_delta(view(spark, sf_dir, "fx_bgwriter"), counters, SCOPE, on_reset="restart")
    return deltas.select(*SCOPE, "snapshot_time", *[f"delta_{c}" for c in counters])


@query
def counter_delta_raw_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = counter_delta(view(spark, sf_dir, "fx_bgwriter"), ["checkpoints_timed"], SCOPE, keep_previous=True)
    first = F.coalesce("prev_checkpoints_timed", F.lit(-1)).alias("previous")
    return deltas.select(*SCOPE, "snapshot_time", first, "delta_checkpoints_timed")


@query
def counter_increase_telescoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_increase(
        view(spark, sf_dir, "fx_statements"), ["calls", "shared_blks_read", "wal_bytes"], STATEMENT_KEYS, nullable=()
    )


@query
def counter_increase_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_increase(
        _gaps(view(spark, sf_dir, "fx_statements")), ["calls", "shared_blks_read"], STATEMENT_KEYS, nullable=["calls"]
    )


@query
def counter_increase_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_increase(
        view(spark, sf_dir, "fx_bgwriter"), ["checkpoints_timed", "buffers_checkpoint"], SCOPE, on_reset="zero"
    )


@query
def elapsed_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = elapsed_delta(view(spark, sf_dir, "fx_statements"), STATEMENT_KEYS)
    return spans.select(*STATEMENT_KEYS, "snapshot_time", epoch_seconds("snapshot_time").alias("epoch"), "delta_seconds")


@query
def fold_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_row_per_snapshot(
        view(spark, sf_dir, "raw_statements"), ["calls", "shared_blks_read"], ["userid", "dbid"], "sum"
    )


@query
def increase_of_folded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_increase(
        view(spark, sf_dir, "fx_statements"), ["calls", "shared_blks_read"], [*SCOPE, "query"], duplicates="sum", nullable=()
    )


def _summarised(fixture: str, counters: list[str], keys: list[str], **options) -> Query:
    """Increases by way of summaries of weeks, put together to months first."""

    def grown(df: DataFrame) -> DataFrame:
        weeks = period_summaries(df, counters, keys, period="week")
        months = merge_summaries(weeks, counters, keys, period="month")
        return increase_from_summaries(months, counters, keys, **options)

    return _fixture(fixture, grown)


_QUERIES |= {
    f"summaries_increase_{policy}": _summarised("fx_bgwriter", ["checkpoints_timed", "buffers_checkpoint"], [*SCOPE], on_reset=policy)
    for policy in ("raw", "zero", "restart")
}
_QUERIES["summaries_increase_gaps"] = _summarised("fx_statements_gaps", ["calls", "shared_blks_read", "wal_bytes"], STATEMENT_KEYS)


@query
def lake_day_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements of a window from landed day summaries, and from snapshots at its edges."""
    rows, root = view(spark, sf_dir, "fx_statements"), shared_dir(spark, "lake")
    lake.compact_snapshots(rows, f"{root}/snapshots", "pg_stat_statements")
    days.land_days(lake.read_compacted(spark, f"{root}/snapshots", "pg_stat_statements"), f"{root}/days", "pg_stat_statements", fold=False)
    start, end = parse_report_window("01/05/2024 06:00:00", "01/20/2024 00:00:00")
    raw = lambda a, b: lake.read_compacted(spark, f"{root}/snapshots", "pg_stat_statements", a, b)
    summed = days.window_summaries(spark, f"{root}/days", "pg_stat_statements", start, end, raw, fold=False)
    base = statements.statement_base(summed)
    return statements.with_texts(base.withColumn("wal_bytes", F.col("wal_bytes").cast("bigint")))


# --- lives ----------------------------------------------------------------------------------------------------------

TABLE_KEYS = [*SCOPE, "schemaname", "relname"]


@query
def table_lifetimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifetimes(view(spark, sf_dir, "fx_tables_lives"), ["relid"], TABLE_KEYS)


def _within_lives(policy: str) -> Query:
    def grown(df: DataFrame) -> DataFrame:
        return counter_increase(df, ["heap_blks_read", "idx_blks_read"], TABLE_KEYS, on_reset=policy, lives=["relid"])

    return _fixture("fx_tables_lives", grown)


_QUERIES |= {f"table_increase_lives_{policy}": _within_lives(policy) for policy in ("raw", "zero", "restart")}


@query
def table_delta_lives(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = counter_delta(view(spark, sf_dir, "fx_tables_lives"), ["heap_blks_read"], TABLE_KEYS, lives=["relid"])
    return deltas.select(*TABLE_KEYS, "snapshot_time", "delta_heap_blks_read")


@query
def statement_increase_since_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements whose database's counters are reset each week: each row's life is that of the latest reset at its time."""
    resets = database_resets(view(spark, sf_dir, "fx_bgwriter").where(F.col("host") != "h1"))
    rows = since_reset(view(spark, sf_dir, "fx_statements"), resets)
    return counter_increase(rows, ["calls", "shared_blks_read"], STATEMENT_KEYS, lives=["life_since"])


def _all_deltas(fixture: str, stat: str, by: list[str]) -> Query:
    def narrow(df: DataFrame) -> DataFrame:
        deltas = stat_deltas(df, stat)
        return deltas.select(*SCOPE, *by, "snapshot_time", *[c for c in deltas.columns if c.startswith("delta_")])

    return _fixture(fixture, narrow)


_QUERIES |= {
    "statement_deltas": _all_deltas("fx_statements", "pg_stat_statements", ["username", "queryid", "query"]),
    "table_deltas": _all_deltas("fx_tables", "table_stats", ["schemaname", "relname"]),
    "index_deltas": _all_deltas("fx_indexes", "index_stats", ["schemaname", "relname", "indexrelname"]),
    "database_deltas": _all_deltas("fx_database", "pg_stat_database", ["datname", "datid"]),
    "bgwriter_deltas": _all_deltas("fx_bgwriter", "pg_stat_bgwriter", ["stats_reset"]),
}

# --- statements -----------------------------------------------------------------------------------------------------


def _statements(cut: Callable[[DataFrame], DataFrame], **options) -> Query:
    return _fixture("fx_statements", lambda df: cut(statements.statement_base(df, **options)))


_QUERIES |= {
    "sql_base": _statements(statements.with_texts),
    "sql_base_digest": _statements(statements.with_texts, digest_text=True),
    "sql_base_gaps": _fixture("fx_statements_gaps", lambda df: statements.with_texts(statements.statement_base(df))),
    "sql_base_missing_column": _fixture(
        "fx_statements_missing", lambda df: statements.with_texts(statements.statement_base(df, duplicates=None))
    ),
    "sql_top_reads": _statements(lambda base: statements.top_reads(base, LIMIT)),
    "sql_top_hits": _statements(lambda base: statements.top_hits(base, LIMIT)),
    "sql_top_writes": _statements(lambda base: statements.top_writes(base, LIMIT)),
    "sql_top_temp_reads": _statements(lambda base: statements.top_temp_reads(base, LIMIT)),
    "sql_top_temp_writes": _statements(lambda base: statements.top_temp_writes(base, LIMIT)),
    "sql_top_wal": _statements(lambda base: statements.top_wal(base, LIMIT)),
    "sql_top5_io": _statements(statements.top_io_findings),
    "sql_top_reads_fleet": _statements(lambda base: statements.top_reads(base, 50, scope=())),
}

# --- tables ---------------------------------------------------------------------------------------------------------


def _tables(cut: Callable[[DataFrame], DataFrame], **options) -> Query:
    return _fixture("fx_tables", lambda df: cut(tables.table_activity(df, **options)))


def _top_tables(family: str, kind: str) -> Query:
    def cut(activity: DataFrame) -> DataFrame:
        return tables.top_tables(tables.table_base(activity), family, kind, LIMIT)

    return _tables(cut, families=[family], vacuum=False)


_QUERIES |= {
    "table_base": _tables(lambda activity: tables.with_texts(tables.table_base(activity)), vacuum=False),
    "table_findings": _tables(lambda activity: tables.table_findings(tables.table_base(activity)), vacuum=False),
    "vacuum_efficiency": _tables(tables.vacuum_efficiency, families=[]),
    "vacuum_efficiency_fleet": _tables(
        lambda activity: tables.vacuum_efficiency(activity, scope=()), families=[], scope=()
    ),
}
_QUERIES |= {
    f"table_{family}_{kind}s": _top_tables(family, kind) for family in tables.FAMILIES for kind in ("read", "hit")
}

# --- indexes --------------------------------------------------------------------------------------------------------


def _indexes(cut: Callable[[DataFrame], DataFrame]) -> Query:
    return _fixture("fx_indexes", lambda df: cut(indexes.index_base(df)))


_QUERIES |= {
    "index_base": _indexes(lambda base: base),
    "index_base_gaps": _fixture("fx_indexes_gaps", indexes.index_base),
    "index_reads": _indexes(lambda base: indexes.top_indexes(base, "read", LIMIT)),
    "index_hits": _indexes(lambda base: indexes.top_indexes(base, "hit", LIMIT)),
    "unused_index_tables": _fixture(
        "fx_indexes", lambda df: indexes.unused_index_tables(indexes.unused_indexes(df), LIMIT)
    ),
    "unused_index_list": _fixture("fx_indexes", lambda df: indexes.unused_index_list(indexes.unused_indexes(df))),
    "unused_index_list_all": _fixture(
        "fx_indexes", lambda df: indexes.unused_index_list(indexes.unused_indexes(df, unused="all"))
    ),
    "index_findings": _fixture(
        "fx_indexes", lambda df: indexes.index_findings(indexes.index_base(df), indexes.unused_indexes(df))
    ),
}


def _two_lots(df: DataFrame) -> DataFrame:
    """Minutes of two lots of rows that share some of their snapshots."""
    early = df.where(F.col("datid") % 2 == 0)
    return quality.snapshot_minutes(early).unionByName(quality.snapshot_minutes(df.where(F.col("datid") % 3 != 0)))


# --- databases, versions, waits, settings, background writer --------------------------------------------------------

_QUERIES |= {
    "snapshot_summary": _fixture("fx_database", databases.snapshot_summary),
    "cluster_versions": _fixture("fx_version", databases.cluster_versions),
    "database_io": _fixture("fx_database", lambda df: databases.database_io(databases.database_increase(df))),
    "database_io_named": _fixture(
        "fx_database",
        lambda df: databases.database_io(databases.database_increase(df, scope=()), CURRENT_DATABASE, scope=()),
    ),
    "remainder_io": _fixture("fx_database", lambda df: databases.remainder_io(databases.database_increase(df))),
    "remainder_io_named": _fixture(
        "fx_database",
        lambda df: databases.remainder_io(databases.database_increase(df, scope=()), CURRENT_DATABASE, scope=()),
    ),
    "role_change_points": _fixture(
        "fx_database",
        lambda df: databases.role_change_points(df.withColumn("database", F.col("datname"))),
    ),
    "role_at_start": _fixture("fx_database", databases.role_at_start),
    "wait_events": _fixture("fx_activity", sessions.wait_events),
    "wait_event_types": _fixture("fx_activity", sessions.wait_event_types),
    "settings_current": _fixture("fx_settings", settings.settings_current),
    "settings_first_seen": _fixture("fx_settings", settings.settings_first_seen),
    "settings_change_points": _fixture("fx_settings", settings.settings_change_points),
    "bgwriter_summary": _fixture("fx_bgwriter", bgwriter.bgwriter_summary),
    "bgwriter_summary_gaps": _fixture("fx_bgwriter_gaps", bgwriter.bgwriter_summary),
    "guard_database_reset": _fixture("fx_database_resets", quality.database_stats_reset),
    "guard_snapshot_count": _fixture("fx_database", quality.snapshot_count),
    "guard_snapshot_minutes": _fixture("fx_database", lambda df: quality.count_minutes(quality.merge_minutes(_two_lots(df)))),
    "guard_stats_reset": _fixture("fx_bgwriter", quality.stats_reset),
    "guard_one_engine": _fixture("fx_version", quality.one_engine),
}


@query
def database_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    io = databases.database_io(databases.database_increase(view(spark, sf_dir, "fx_database")))
    return databases.database_findings(io, databases.aurora_hosts(view(spark, sf_dir, "fx_version"), ["host"]))


@query
def bgwriter_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    aurora = databases.aurora_hosts(view(spark, sf_dir, "fx_version"))
    return bgwriter.bgwriter_findings(bgwriter.bgwriter_summary(view(spark, sf_dir, "fx_bgwriter")), aurora)


# --- functions ------------------------------------------------------------------------------------------------------


@query
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five functions under their SQL names, on every statement row."""
    register_sql_functions(spark)
    return spark.sql(
        "select host, username, queryid, query, snapshot_time, hit_ratio(shared_blks_read, shared_blks_hit) ratio, "
        "per_unit(calls, total_exec_time) ms_per_call, percent_of(shared_blks_hit, temp_blks_read) temp_percent, "
        "blocks_to_bytes(shared_blks_read) read_bytes, human_bytes(shared_blks_hit * 100) hit_text from {rows}",
        rows=view(spark, sf_dir, "fx_statements"),
    )


@query
def scalar_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole parts of positive and negative fractions of every statement row."""
    rows = view(spark, sf_dir, "fx_statements").withColumn("part", F.expr("(calls * 10 - shared_blks_read) / 7.0D"))
    return rows.select(*STATEMENT_KEYS, "snapshot_time", truncated("part").alias("whole"))


@query
def report_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement rows between two report times given as text."""
    rows = view(spark, sf_dir, "fx_statements").select(*STATEMENT_KEYS, "snapshot_time", "calls")
    start, end = report_time(F.lit("01/05/2024 00:00:00")), report_time(F.lit("01/20/2024 00:00:00"))
    return rows.where(F.col("snapshot_time").between(start, end))


# --- catalog joins --------------------------------------------------------------------------------------------------


@query
def catalog_database_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.database_stats(view(spark, sf_dir, "raw_stat_database"), view(spark, sf_dir, "raw_databases"))


@query
def catalog_active_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.active_sessions(view(spark, sf_dir, "raw_activity"), CAPTURE)


@query
def catalog_background_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.background_writer(view(spark, sf_dir, "raw_bgwriter"))


@query
def catalog_server_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.server_settings(view(spark, sf_dir, "raw_settings"), CAPTURE)


@query
def catalog_vacuum_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.vacuum_progress(
        view(spark, sf_dir, "raw_vacuum_progress"), view(spark, sf_dir, "raw_stat_tables"), CAPTURE
    )


@query
def catalog_statement_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.statement_stats(
        view(spark, sf_dir, "raw_statements"),
        view(spark, sf_dir, "raw_users"),
        view(spark, sf_dir, "raw_databases"),
        current_database=CURRENT_DATABASE,
        capture=CAPTURE,
    )


@query
def catalog_statement_stats_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Servers before and after the split of execution times in one frame; each row keeps its own profile's time."""
    rows = view(spark, sf_dir, "raw_statements")
    earlier = F.col("userid") % 2 == 0
    mixed = rows.withColumn("total_time", F.when(earlier, F.col("total_exec_time"))).withColumn(
        "total_exec_time", F.when(~earlier, F.col("total_exec_time"))
    )
    users, names = view(spark, sf_dir, "raw_users"), view(spark, sf_dir, "raw_databases")
    return catalog.statement_stats(mixed, users, names, current_database=CURRENT_DATABASE, capture=CAPTURE)


@query
def catalog_statement_stats_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row names the database it was captured in; rows of other databases drop out."""
    raw = view(spark, sf_dir, "raw_databases")
    names = raw.select(F.col("datname").alias("database"), F.col("oid").alias("_oid"))
    rows = view(spark, sf_dir, "raw_statements")
    captured = rows.join(names, F.when(rows["queryid"] == 0, F.lit(1)).otherwise(rows["dbid"]) == names["_oid"])
    return catalog.statement_stats(
        captured.drop("_oid"), view(spark, sf_dir, "raw_users"), raw, capture=[*CAPTURE, "database"]
    )


@query
def catalog_table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.table_stats(
        view(spark, sf_dir, "raw_statio_tables"), view(spark, sf_dir, "raw_stat_tables"), CAPTURE
    )


@query
def catalog_index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index catalog and the constraints are the same for every capture here."""
    activity = view(spark, sf_dir, "raw_stat_indexes")
    captures = activity.select("snapshot_time", F.col("indexrelid").alias("_index")).distinct()
    flags = view(spark, sf_dir, "raw_index_catalog")
    names = view(spark, sf_dir, "raw_constraints")
    return catalog.index_stats(
        view(spark, sf_dir, "raw_statio_indexes"),
        flags.join(captures, flags["indexrelid"] == captures["_index"]).drop("_index"),
        activity,
        names.join(captures, names["conindid"] == captures["_index"]).drop("_index"),
        CAPTURE,
    )


@query
def catalog_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = catalog.server_version(view(spark, sf_dir, "fx_version"))
    return versions.withColumn("profile", catalog.statement_profile("version")).drop("aurora_version").where(
        major_version("version") > 0
    )


# --- lake -----------------------------------------------------------------------------------------------------------


@query
def lake_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table rows written to a lake of Parquet files and read back by the statistic's own schema."""
    rows, root = view(spark, sf_dir, "fx_tables"), shared_dir(spark, "lake")
    lake.write_snapshots(rows, root, "table_stats")
    return lake.read_snapshots(spark, root, "table_stats").select(*rows.columns)


@query
def lake_time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two hosts in a window, with the window's seconds."""
    rows, root = view(spark, sf_dir, "fx_tables"), shared_dir(spark, "lake")
    lake.write_snapshots(rows, root, "table_stats")
    start, end = parse_report_window("01/01/1996 00:00:00", "12/01/1997 00:00:00")
    window = lake.read_snapshots(spark, root, "table_stats", start, end, hosts=["h1", "h2"], databases=["app"])
    return lake.with_epoch(window).select(*SCOPE, "snapshot_time", "snapshot_timestamp", "relname", "heap_blks_read")


@query
def lake_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings written as gzipped CSV and read back; their nulls are empty fields."""
    rows, root = view(spark, sf_dir, "fx_settings"), shared_dir(spark, "lake")
    lake.write_snapshots(rows, root, "pg_settings", file_format="csv")
    return lake.read_snapshots(spark, root, "pg_settings", file_format="csv").select(*rows.columns)


@query
def lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows landed by day and read back for a window."""
    rows, root = view(spark, sf_dir, "fx_indexes"), shared_dir(spark, "lake")
    lake.compact_snapshots(rows, root, "index_stats", fold=False)
    start, end = parse_report_window("01/01/1996 00:00:00", "12/01/1997 00:00:00")
    return lake.read_compacted(spark, root, "index_stats", start, end).select(*rows.columns)


@query
def lake_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows that repeat per constraint, folded while they are landed; the report then skips the fold."""
    rows, root = view(spark, sf_dir, "fx_indexes"), shared_dir(spark, "lake")
    repeated = rows.unionByName(rows.where(F.col("conname").isNotNull()).withColumn("conname", F.lit("another")))
    lake.compact_snapshots(repeated, root, "index_stats")
    return indexes.index_base(lake.read_compacted(spark, root, "index_stats"), duplicates=None)


@query
def lake_statements_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement rows with the types a driver gives them (fractions on WAL bytes, whole numbers for times)."""
    rows, root = view(spark, sf_dir, "fx_statements"), shared_dir(spark, "lake")
    given = rows.withColumn("wal_bytes", F.col("wal_bytes").cast("decimal(38,18)"))
    lake.write_snapshots(given.withColumn("calls", F.col("calls").cast("decimal(20,0)")), root, "pg_stat_statements")
    back = lake.read_snapshots(spark, root, "pg_stat_statements")
    return back.select(*[F.col(c).cast(kind).alias(c) for c, kind in rows.dtypes])


@query
def lake_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that the schema does not know, through the lake, compaction and back."""
    rows, root = view(spark, sf_dir, "fx_tables"), shared_dir(spark, "lake")
    lake.write_snapshots(rows.withColumn("seq_scan", F.col("heap_blks_read") + 1), f"{root}/raw", "table_stats")
    raw = lake.read_snapshots(spark, f"{root}/raw", "table_stats", every_column=True)
    lake.compact_snapshots(raw, f"{root}/days", "table_stats")
    return lake.read_compacted(spark, f"{root}/days", "table_stats", every_column=True).select(*rows.columns, "seq_scan")


@query
def lake_compacted_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that are landed a second time take the place of the first landing."""
    rows, root = view(spark, sf_dir, "fx_statements"), shared_dir(spark, "lake")
    for _ in range(2):
        lake.compact_snapshots(rows, root, "pg_stat_statements")
    base = statements.statement_base(lake.read_compacted(spark, root, "pg_stat_statements"), duplicates=None)
    wal = [F.col(c).cast("bigint").alias(c) for c in ("wal_bytes",)]
    return statements.with_texts(base.select(*[c for c in base.columns if c != "wal_bytes"], *wal))


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "clustered")
    name = "statements_" + root.rsplit("-", 1)[-1]
    clustered.cluster_snapshots(view(spark, sf_dir, "fx_statements"), name, root, "pg_stat_statements", buckets=8)
    return clustered.read_clustered(spark, name, "pg_stat_statements")


@query
def lake_clustered_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement report over a bucketed table: nothing moves before the top lists."""
    base = statements.statement_base(_clustered(spark, sf_dir), duplicates=None, gaps="lag")
    return statements.with_texts(base.withColumn("wal_bytes", F.col("wal_bytes").cast("bigint")))


@query
def lake_clustered_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = counter_delta(_clustered(spark, sf_dir), ["calls", "shared_blks_read"], STATEMENT_KEYS)
    return deltas.select(*STATEMENT_KEYS, "snapshot_time", "delta_calls", "delta_shared_blks_read")


@query
def lake_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two statistics of a lake, loaded together and queried by name: waits per host beside its checkpoints."""
    root = shared_dir(spark, "lake")
    lake.compact_snapshots(view(spark, sf_dir, "fx_activity"), root, "pg_stat_activity")
    lake.compact_snapshots(view(spark, sf_dir, "fx_bgwriter"), f"{root}-days", "pg_stat_bgwriter")
    frames = lake.load_stats(spark, root, stats=["pg_stat_activity"], compacted=True) | lake.load_stats(spark, f"{root}-days", stats=["pg_stat_bgwriter"], compacted=True)
    waits, writer = lake.register_views(frames, prefix=f"v_{root.rsplit('-', 1)[-1]}_")
    return spark.sql(
        f"select w.host, w.samples, b.checkpoints from (select host, count(*) samples from {waits} where wait_event is not null group by host) w "
        f"join (select host, max(checkpoints_timed) checkpoints from {writer} group by host) b on b.host = w.host"
    )


@query
def report_fleet_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database shares of a report over the whole fleet, current database named."""
    results = report.build_report({"pg_stat_database": view(spark, sf_dir, "fx_database")}, scope=(), database=CURRENT_DATABASE)
    return results["database_io"].unionByName(results["remainder_io"])


REPORT_FIXTURES = {
    "pg_stat_database": "fx_database",
    "pg_stat_activity": "fx_activity",
    "pg_stat_bgwriter": "fx_bgwriter",
    "pg_settings": "fx_settings",
    "pg_stat_statements": "fx_statements",
    "table_stats": "fx_tables",
    "index_stats": "fx_indexes",
    "version": "fx_version",
}


def row_digest(df: DataFrame) -> Column:
    """A number from all values of a row, named and in order of their names: times as microseconds, fractions by hundredths."""

    def text(name: str, kind: str) -> Column:
        value = F.col(name)
        if kind in ("double", "float"):
            value = F.round(value * 100).cast("bigint")
        elif kind.startswith("timestamp"):
            value = F.unix_micros(value.cast("timestamp"))
        return F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("~")))

    whole = F.concat_ws("|", *[text(name, kind) for name, kind in sorted(df.dtypes)])
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 10), 16, 10).cast("bigint")


@query
def written_report_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every result of a report that was written out: rows per host and database, and a sum over all their values."""
    frames = {stat: view(spark, sf_dir, fixture) for stat, fixture in REPORT_FIXTURES.items()}
    rows = frames["pg_stat_database"]
    frames["pg_stat_database"] = rows.withColumn("stats_reset", F.lit(None).cast("timestamp"))
    paths = report.write_report(frames, shared_dir(spark, "report-out"), limit=LIMIT)

    def summed(name: str, path: str) -> DataFrame:
        result = spark.read.parquet(path)
        digested = result.withColumn("_digest", row_digest(result)).groupBy(*SCOPE)
        return digested.agg(F.count(F.lit(1)).alias("rows"), F.sum("_digest").alias("digest")).withColumn("result", F.lit(name))

    return lake.union_snapshots([summed(name, path) for name, path in paths.items()])


@query
def written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vacuum activity from a report that was written out."""
    paths = report.write_report({"table_stats": view(spark, sf_dir, "fx_tables")}, shared_dir(spark, "report-out"))
    return spark.read.parquet(paths["vacuum_stats"])


# --- streams --------------------------------------------------------------------------------------------------------


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake files streamed into the compacted layout."""
    rows, root = view(spark, sf_dir, "fx_bgwriter"), shared_dir(spark, "stream")
    lake.write_snapshots(rows, f"{root}/in", "pg_stat_bgwriter")
    arriving = stream_snapshots(spark, f"{root}/in", "pg_stat_bgwriter")
    land_stream(arriving, f"{root}/out", "pg_stat_bgwriter", f"{root}/checkpoint").awaitTermination()
    return lake.read_compacted(spark, f"{root}/out", "pg_stat_bgwriter").select(*rows.columns)


@query
def stream_folded_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows that repeat per constraint, streamed in two lots and folded while they land, then differenced by day summaries."""
    rows, root = view(spark, sf_dir, "fx_indexes"), shared_dir(spark, "stream")
    repeated = rows.unionByName(rows.where(F.col("conname").isNotNull()).withColumn("conname", F.lit("another")))
    lots = F.pmod(F.xxhash64("snapshot_time", "conname"), F.lit(2))
    for lot in range(2):
        repeated.where(lots == lot).write.mode("append").parquet(f"{root}/in")
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
    ingest = FoldingIngest(f"{root}/out", "index_stats", f"{root}/arrived", f"{root}/days")
    ingest.start(arriving, f"{root}/checkpoint").awaitTermination()
    start, end = parse_report_window("01/01/1990 00:00:00", "01/01/2010 00:00:00")
    return indexes.index_base(days.read_days(spark, f"{root}/days", "index_stats", start, end))


@query
def stream_wait_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly wait counts of all samples, in whatever order they arrive."""
    rows, root = view(spark, sf_dir, "fx_activity"), shared_dir(spark, "stream")
    rows.repartition(3, F.xxhash64("query")).write.parquet(f"{root}/in")
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    stream = WaitCounts(f"{root}/out")
    stream.start(arriving, f"{root}/checkpoint").awaitTermination()
    stream.fold(spark, 1)
    return stream.counts(spark)


@query
def stream_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deltas of statement rows that arrive in two halves of the month."""
    rows, root = view(spark, sf_dir, "fx_statements"), shared_dir(spark, "stream")
    for half in (F.dayofmonth("snapshot_time") <= 15, F.dayofmonth("snapshot_time") > 15):
        rows.where(half).repartition(*STATEMENT_KEYS).write.mode("append").parquet(f"{root}/in")
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 8).parquet(f"{root}/in")
    stream = DeltaStream(f"{root}/out", ["calls", "shared_blks_read", "wal_bytes"], STATEMENT_KEYS)
    stream.start(arriving, f"{root}/checkpoint").awaitTermination()
    return stream.deltas(spark).select(
        *STATEMENT_KEYS, "snapshot_time", "delta_calls", "delta_shared_blks_read", "delta_wal_bytes"
    )


@query
def stream_wait_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly wait counts of an event stream, as far as its windows are final."""
    root = shared_dir(spark, "stream")
    events = table(spark, sf_dir, "events")
    arriving = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    waits = arriving.select(
        F.concat(F.lit("h"), (F.col("user_id") % 3).cast("string")).alias("host"),
        F.col("ts").cast("timestamp").alias("snapshot_time"),
        F.nullif("event_type", F.lit("view")).alias("wait_event"),
        F.when(F.col("event_type") != "view", F.lit("IO")).alias("wait_event_type"),
    )
    land_wait_windows(waits, f"{root}/out", f"{root}/checkpoint", delay="10 minutes", scope=["host"]).awaitTermination()
    return spark.read.parquet(f"{root}/out")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
