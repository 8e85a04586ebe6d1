"""The whole report as named frames, over every host and database in the lake."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdelta.operators import quality
from snapdelta.operators.topk import DEFAULT_LIMIT, TOP_FINDINGS, UNUSED_INDEX_LIST
from snapdelta.plans import bgwriter, databases, indexes, sessions, settings, statements, tables
from snapdelta.schema import SCOPE
from snapdelta.sources.shared import exists, move, remove, settle, shared_dir

# The results of a report.
RESULTS = (
    "snapshot_details cluster_details database_role_timeline database_io remainder_io snapshot_details_findings "
    "wait_events wait_events_type parameters pg_setting_change_timeline sql_r_io_stats sql_h_io_stats sql_w_io_stats "
    "sql_tr_stats sql_tw_stats sql_stats_wg findings_top_io_sql bgwriter_stats bgwriter_findings index_reads index_hits "
    "index_usage index_usage_2 index_stats_findings table_heap_reads table_index_reads table_toast_reads "
    "table_toast_index_reads table_heap_hits table_index_hits table_toast_hits table_toast_index_hits vacuum_stats "
    "table_stats_findings"
).split()

Keep = Callable[[DataFrame, str], DataFrame]


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def build_report(
    frames: dict[str, DataFrame],
    *,
    limit: int = DEFAULT_LIMIT,
    findings_limit: int = TOP_FINDINGS,
    unused_limit: int = UNUSED_INDEX_LIST,
    scope: Sequence[str] = SCOPE,
    database: str | None = None,
    on_reset: str = "raw",
    unused: str = "any",
    digest_text: bool = False,
    folded: bool = False,
    summaries: Mapping[str, DataFrame] | None = None,
    keep: Keep = _as_is,
) -> dict[str, DataFrame]:
    """Results by name, for the statistics present in ``frames``.

    Frames are lazy. ``keep(frame, name)`` is applied to what several results share and to aggregates that may need
    a second pass; ``write_report`` passes one that writes them out, so that each is computed once. ``folded`` says
    that the frames hold one row per entity and snapshot, as folded compaction leaves them. ``database`` names the
    current database, which a scope without a database column needs; ``limit``, ``findings_limit`` and ``unused_limit``
    are the sizes of the top lists, of the statements among the findings and of the list of unused indexes. Increases of
    the statistics in ``summaries`` are read from there, per entity and day in place of every snapshot.
    """
    counted = {**frames, **{name: df for name, df in (summaries or {}).items() if name in frames}}
    results: dict[str, DataFrame] = {}

    def increase(name: str) -> dict:
        settled = None if keep is _as_is else lambda df: keep(df, f"{name}_increase")
        return {"on_reset": on_reset, "settle": settled if on_reset == "raw" else None}

    unfolded = {"duplicates": None} if folded else {}
    aurora = None
    if "version" in frames:
        versions = frames["version"]
        aurora = keep(databases.aurora_hosts(versions, scope), "aurora_hosts")
        results["cluster_details"] = databases.cluster_versions(versions, scope)

    if "pg_stat_database" in frames:
        rows = frames["pg_stat_database"]
        io = keep(databases.database_increase(counted["pg_stat_database"], scope=scope, **increase("database")), "database_io")
        current = databases.database_io(io, database, scope)
        results |= {
            "snapshot_details": databases.snapshot_summary(rows, scope),
            "database_role_timeline": databases.role_change_points(rows, scope),
            "database_io": current,
            "remainder_io": databases.remainder_io(io, database, scope),
            "snapshot_details_findings": databases.database_findings(
                current, aurora if aurora is not None else current.where(F.lit(False)), scope
            ),
        }

    if "pg_stat_activity" in frames:
        rows = frames["pg_stat_activity"]
        results["wait_events"] = sessions.wait_events(rows, scope)
        results["wait_events_type"] = sessions.wait_event_types(rows, scope)

    if "pg_settings" in frames:
        rows = frames["pg_settings"]
        results["parameters"] = settings.settings_current(rows, scope)
        results["pg_setting_change_timeline"] = settings.settings_first_seen(rows, scope)

    if "pg_stat_statements" in frames:
        base = statements.statement_base(
            counted["pg_stat_statements"], scope=scope, digest_text=digest_text, **unfolded, **increase("statement")
        )
        base = keep(base, "statement_base")
        if keep is _as_is:
            results |= {
                "sql_r_io_stats": statements.top_reads(base, limit, scope),
                "sql_h_io_stats": statements.top_hits(base, limit, scope),
                "sql_w_io_stats": statements.top_writes(base, limit, scope),
                "sql_tr_stats": statements.top_temp_reads(base, limit, scope),
                "sql_tw_stats": statements.top_temp_writes(base, limit, scope),
                "sql_stats_wg": statements.top_wal(base, limit, scope),
                "findings_top_io_sql": statements.top_io_findings(base, findings_limit, scope),
            }
        else:
            # All lists in one pass, kept; the single ones would each sort the base again.
            lists = keep(statements.all_lists(base, limit, findings_limit, scope), "statement_lists")
            results |= {name: statements.list_of(lists, name, base, scope) for name in (*statements.LISTS, statements.FINDINGS)}

    if "pg_stat_bgwriter" in frames:
        summary = bgwriter.bgwriter_summary(counted["pg_stat_bgwriter"], scope=scope, **increase("bgwriter"))
        summary = keep(summary, "bgwriter_summary")
        results["bgwriter_stats"] = summary
        results["bgwriter_findings"] = bgwriter.bgwriter_findings(summary, aurora, scope)

    if "index_stats" in frames:
        rows = frames["index_stats"]
        base = keep(indexes.index_base(counted["index_stats"], scope=scope, **unfolded, **increase("index")), "index_base")
        idle = keep(indexes.unused_indexes(rows, scope, unused), "unused_indexes")
        results |= {
            "index_reads": indexes.top_indexes(base, "read", limit, scope),
            "index_hits": indexes.top_indexes(base, "hit", limit, scope),
            "index_usage": indexes.unused_index_tables(idle, limit, scope),
            "index_usage_2": indexes.unused_index_list(idle, unused_limit, scope),
            "index_stats_findings": indexes.index_findings(base, idle, scope),
        }

    if "table_stats" in frames:
        activity = tables.table_activity(counted["table_stats"], scope=scope, **increase("table"))
        activity = keep(activity, "table_activity")
        base = tables.table_base(activity, scope)
        names = [(family, kind) for family in tables.FAMILIES for kind in ("read", "hit")]
        if keep is _as_is:
            results |= {f"table_{f}_{k}s": tables.top_tables(base, f, k, limit, scope) for f, k in names}
        else:
            lists = keep(tables.all_lists(base, limit, scope), "table_lists")
            results |= {f"table_{f}_{k}s": tables.list_of(lists, f, k, scope) for f, k in names}
        results["vacuum_stats"] = tables.vacuum_efficiency(activity, scope)
        results["table_stats_findings"] = tables.table_findings(base, scope)

    return {name: results[name] for name in RESULTS if name in results}


def report_status(
    frames: dict[str, DataFrame], scope: Sequence[str] = SCOPE, database: str | None = None
) -> DataFrame:
    """Per scope: are there enough snapshots, did the database's counters run through, is there one engine and version."""
    rows = frames["pg_stat_database"]
    counted = quality.snapshot_count(rows, scope=scope).withColumnRenamed("ok", "enough_snapshots")
    resets = quality.database_stats_reset(rows, scope=scope, database=database).withColumnRenamed("ok", "_ran_through")
    joined = _beside(counted, resets, scope)
    if "version" in frames:
        engines = quality.one_engine(frames["version"], scope=scope).select(*scope, F.col("ok").alias("_one_engine"))
        joined = _beside(joined, engines, scope)
    else:
        joined = joined.withColumn("_one_engine", F.lit(None).cast("boolean"))
    return joined.select(
        *scope,
        "snapshots",
        "enough_snapshots",
        F.coalesce("resets", F.lit(0)).alias("resets"),
        F.coalesce("_ran_through", F.lit(True)).alias("not_reset"),
        F.coalesce("_one_engine", F.lit(True)).alias("one_engine"),
    )


def _beside(left: DataFrame, right: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Left join on the scope, null-safe; without a scope both sides are one row."""
    named = right.select(*[F.col(c).alias(f"_of_{c}") for c in scope], *[c for c in right.columns if c not in scope])
    same = F.lit(True)
    for c in scope:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return left.join(named, same, "left").drop(*[f"_of_{c}" for c in scope])


#: The sections of a report, which do not depend on each other: the statistics each reads, and the results it gives.
SECTIONS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "details": (("pg_stat_database", "version"), tuple(RESULTS[:6])),
    "waits": (("pg_stat_activity",), ("wait_events", "wait_events_type")),
    "settings": (("pg_settings",), ("parameters", "pg_setting_change_timeline")),
    "statements": (("pg_stat_statements",), (*statements.LISTS, statements.FINDINGS)),
    "bgwriter": (("pg_stat_bgwriter", "version"), ("bgwriter_stats", "bgwriter_findings")),
    "indexes": (("index_stats",), ("index_reads", "index_hits", "index_usage", "index_usage_2", "index_stats_findings")),
    "tables": (("table_stats",), tuple(r for r in RESULTS if r.startswith("table_") or r == "vacuum_stats")),
}


def _publish(spark: SparkSession, staged: str, path: str, mode: str) -> None:
    """Move a finished result to its place; where it is appended to, or the store cannot move it, copy it."""
    if mode in ("overwrite", "error", "errorifexists"):
        if mode == "overwrite" and exists(spark, path):
            remove(spark, path)
        if move(spark, staged, path):
            return
    spark.read.parquet(staged).write.mode(mode).parquet(path)


def write_report(
    frames: dict[str, DataFrame],
    out: str,
    *,
    strict: bool = False,
    mode: str = "overwrite",
    scope: Sequence[str] = SCOPE,
    database: str | None = None,
    jobs: int = 8,
    **options,
) -> dict[str, str]:
    """Write every result as Parquet under ``out`` and return the paths.

    Shared frames are written to the cluster's shared folder first and read back; that folder is removed at the end.
    Sections run beside each other, up to ``jobs`` jobs at once, each section in a scheduler pool of its own name. Their
    results are staged next to ``out`` and moved to their places when all are there: if a section fails, nothing is published.
    With ``strict`` a scope with too few snapshots, a statistics reset or mixed versions fails the report; otherwise
    ``report_status`` tells them apart.
    """
    if not frames:
        raise quality.DataQualityError("no statistics to report on")
    spark = next(iter(frames.values())).sparkSession
    scratch, staging = shared_dir(spark, "report"), f"{out.rstrip('/')}/_staged-{uuid.uuid4().hex}"

    def pooled(section: str, job: Callable):
        def run(*args):
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", section)
            return job(*args)

        return run

    def write(name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{staging}/{name}")

    def status() -> list[Future]:
        checked = settle(report_status(frames, scope, database), f"{scratch}/status")
        if strict:
            quality.require_rows(checked)
            passed = F.col("enough_snapshots") & F.col("not_reset") & F.col("one_engine")
            quality.require_ok(checked.withColumn("ok", passed), "report not possible")
        return [writers.submit(pooled("details", write), "report_status", checked)]

    def section(name: str) -> list[Future]:
        read, wanted = SECTIONS[name]
        own = {stat: frames[stat] for stat in read if stat in frames}
        keep = lambda df, what: settle(df, f"{scratch}/{name}-{what}")
        results = build_report(own, keep=keep, scope=scope, database=database, **options)
        return [writers.submit(pooled(name, write), result, results[result]) for result in wanted if result in results]

    alone = {"details": ("pg_stat_database", "version"), "bgwriter": ("pg_stat_bgwriter",)}
    named = [name for name, (read, _) in SECTIONS.items() if any(stat in frames for stat in alone.get(name, read))]
    try:
        # Sections are planned in threads of their own; what they write is queued to others, so that none waits for itself.
        with ThreadPoolExecutor(jobs) as writers, ThreadPoolExecutor(len(named) + 1) as planners:
            if strict and "pg_stat_database" in frames:
                checks = status()
            else:
                checks = []
            planned = [planners.submit(pooled(name, section), name) for name in named]
            if not strict and "pg_stat_database" in frames:
                planned.append(planners.submit(pooled("details", status)))
            for done in [*(f for plan in planned for f in plan.result()), *checks]:
                done.result()
        names = [name for name in ("report_status", *RESULTS) if exists(spark, f"{staging}/{name}")]
        paths = {name: f"{out.rstrip('/')}/{name}" for name in names}
        with ThreadPoolExecutor(jobs) as writers:
            list(writers.map(lambda name: _publish(spark, f"{staging}/{name}", paths[name], mode), names))
    finally:
        for folder in (scratch, staging):
            remove(spark, folder)
    return {name: path for name, path in paths.items() if name != "report_status"}
