"""Statement report: I/O, time and WAL per statement, and the top lists cut from it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import BLOCK_SIZE, blocks_to_bytes, hit_ratio, human_bytes, or_zero, per_unit
from snapdelta.operators.summaries import increase, is_summarised
from snapdelta.operators.topk import DEFAULT_LIMIT, TOP_FINDINGS, one_list, top_k, top_lists
from snapdelta.schema import SCOPE, STATS, with_exec_time

SPEC = STATS["pg_stat_statements"]
BYTES = {
    "shared_written_bytes": "shared_blks_written",
    "shared_read_bytes": "shared_blks_read",
    "shared_hit_bytes": "shared_blks_hit",
    "temp_read_bytes": "temp_blks_read",
    "temp_written_bytes": "temp_blks_written",
}
WAL = ("wal_records", "wal_fpi", "wal_bytes")
NEEDED = (*BYTES.values(), "calls", "total_exec_time", "blk_read_time")
_DIGEST = "query_digest"


def statement_base(
    statements: DataFrame,
    *,
    scope: Sequence[str] = SCOPE,
    duplicates: str | None = SPEC.duplicates,
    digest_text: bool = False,
    block_size: int = BLOCK_SIZE,
    **increase_options,
) -> DataFrame:
    """One row per statement that moved any block in the window; ``statements`` are snapshots, or summaries of them.

    A counter that no server has gives 0. ``duplicates=None`` skips the fold per snapshot where the data is known to hold one row per statement.
    With ``digest_text`` the shuffles carry a 256-bit digest in place of the statement's text, and the distinct
    texts are read again and joined back to the result. That pays only where shuffling very long texts is what a job
    waits for: over rows sorted by statement, map-side combine and shuffle compression leave little to save.
    """
    summarised = is_summarised(statements)
    if summarised and digest_text:
        raise ValueError("summaries hold the texts of their statements: leave digest_text out")
    rows = statements if summarised else with_exec_time(statements)
    wal = SPEC.present(rows, WAL)
    keys = [*scope, *SPEC.keys]
    texts = None
    if digest_text:
        rows = rows.withColumn(_DIGEST, F.sha2("query", 256))
        texts = rows.select(*scope, "username", "queryid", _DIGEST, "query").distinct()
        keys = [*scope, "username", "queryid", _DIGEST]
    # Any counter may be null for a while, or on some servers throughout; what touches a null adds nothing.
    increase_options.setdefault("gaps", "lag" if duplicates else "resolve")
    if not summarised:
        needed = SPEC.present(rows, NEEDED)
        rows = rows.select("*", *[F.lit(None).cast("bigint").alias(c) for c in NEEDED if c not in needed])
    grown = increase(rows, [*NEEDED, *wal], keys, duplicates=duplicates, **increase_options)
    base = grown.select(
        *keys,
        *[blocks_to_bytes(f"increase_{c}", block_size).alias(name) for name, c in BYTES.items()],
        hit_ratio("increase_shared_blks_read", "increase_shared_blks_hit").alias("hit_ratio"),
        F.col("increase_calls").alias("calls"),
        per_unit("increase_calls", "increase_total_exec_time").alias("ms_per_call"),
        per_unit("increase_calls", "increase_shared_blks_hit").alias("shared_hit_per_call"),
        per_unit("increase_calls", "increase_shared_blks_read").alias("shared_read_per_call"),
        per_unit("increase_calls", "increase_blk_read_time").alias("read_ms_per_call"),
        per_unit("elapsed_seconds", "increase_calls").alias("calls_per_second"),
        *[F.col(f"increase_{c}").alias(c) for c in wal],
    ).where(" or ".join(f"{name} > 0" for name in BYTES))
    if texts is not None:
        named = texts.withColumnsRenamed({k: f"_text_{k}" for k in keys})
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_text_{k}")) for k in keys])
        base = base.join(named, on, "inner").drop(_DIGEST, *[f"_text_{k}" for k in keys])
    return base.withColumn("queryid", or_zero("queryid"))


def with_texts(base: DataFrame) -> DataFrame:
    """Add a display text beside each byte column."""
    sizes = [c for c in base.columns if c.endswith("_bytes")]
    return base.select("*", *[human_bytes(c).alias(c.removesuffix("_bytes") + "_text") for c in sizes])


def _top(base: DataFrame, metric: str, k: int, scope: Sequence[str], positive: bool = True) -> DataFrame:
    ties = [c for c in SPEC.keys if c not in scope]
    return with_texts(top_k(base, metric, k, ties=ties, scope=scope, positive=positive))


def top_reads(base: DataFrame, k: int = DEFAULT_LIMIT, scope: Sequence[str] = SCOPE) -> DataFrame:
    return _top(base, "shared_read_bytes", k, scope)


def top_hits(base: DataFrame, k: int = DEFAULT_LIMIT, scope: Sequence[str] = SCOPE) -> DataFrame:
    return _top(base, "shared_hit_bytes", k, scope)


def top_writes(base: DataFrame, k: int = DEFAULT_LIMIT, scope: Sequence[str] = SCOPE) -> DataFrame:
    return _top(base, "shared_written_bytes", k, scope)


def top_temp_reads(base: DataFrame, k: int = DEFAULT_LIMIT, scope: Sequence[str] = SCOPE) -> DataFrame:
    return _top(base, "temp_read_bytes", k, scope)


def top_temp_writes(base: DataFrame, k: int = DEFAULT_LIMIT, scope: Sequence[str] = SCOPE) -> DataFrame:
    return _top(base, "temp_written_bytes", k, scope)


def top_wal(base: DataFrame, k: int = DEFAULT_LIMIT, scope: Sequence[str] = SCOPE) -> DataFrame:
    """By WAL volume; empty where the servers do not count it."""
    if "wal_bytes" not in base.columns:
        base = base.withColumn("wal_bytes", F.lit(None).cast("bigint")).where(F.lit(False))
    return _top(base, "wal_bytes", k, scope)


def top_io_findings(base: DataFrame, k: int = TOP_FINDINGS, scope: Sequence[str] = SCOPE) -> DataFrame:
    """The few statements that read most, whether or not they read anything."""
    return _top(base, "shared_read_bytes", k, scope, positive=False)


#: The report's lists: name to metric.
LISTS = {
    "sql_r_io_stats": "shared_read_bytes",
    "sql_h_io_stats": "shared_hit_bytes",
    "sql_w_io_stats": "shared_written_bytes",
    "sql_tr_stats": "temp_read_bytes",
    "sql_tw_stats": "temp_written_bytes",
    "sql_stats_wg": "wal_bytes",
}
FINDINGS = "findings_top_io_sql"


def all_lists(base: DataFrame, k: int = DEFAULT_LIMIT, findings: int = TOP_FINDINGS, scope: Sequence[str] = SCOPE) -> DataFrame:
    """All lists of the report at once, rows named by ``list``; ``list_of`` takes one out."""
    if "wal_bytes" not in base.columns:
        base = base.withColumn("wal_bytes", F.lit(None).cast("bigint"))
    lists = {name: (metric, k, True) for name, metric in LISTS.items()} | {FINDINGS: ("shared_read_bytes", findings, False)}
    return top_lists(base, lists, ties=[c for c in SPEC.keys if c not in scope], scope=scope)


def list_of(lists: DataFrame, name: str, base: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """One of ``all_lists`` with display texts, as its own function gives it."""
    cut = one_list(lists, name, scope)
    if "wal_bytes" not in base.columns and name != "sql_stats_wg":
        cut = cut.drop("wal_bytes")
    return with_texts(cut)
