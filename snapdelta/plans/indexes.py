"""Index report: blocks per index, unused indexes, findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import BLOCK_SIZE, blocks_to_bytes, hit_ratio, human_bytes, qualified_name
from snapdelta.operators.summaries import increase
from snapdelta.operators.topk import DEFAULT_LIMIT, UNUSED_INDEX_LIST, top_k
from snapdelta.plans.findings import LOW_HIT_RATIO, finding
from snapdelta.schema import SCOPE, STATS

SPEC = STATS["index_stats"]
# Schemas whose indexes are never called unused, and the key text of an index on an expression.
SYSTEM_SCHEMAS = ("pg_catalog", "pg_toast")
EXPRESSION_KEY = "0"


def index_base(
    indexes: DataFrame,
    *,
    scope: Sequence[str] = SCOPE,
    duplicates: str | None = SPEC.duplicates,
    block_size: int = BLOCK_SIZE,
    **increase_options,
) -> DataFrame:
    """One row per index that moved any block."""
    increase_options.setdefault("gaps", "lag" if duplicates else "resolve")
    grown = increase(
        indexes, SPEC.counters, [*scope, *SPEC.keys], duplicates=duplicates, **increase_options
    )
    return grown.select(
        *scope,
        qualified_name(*SPEC.keys).alias("index_name"),
        blocks_to_bytes("increase_idx_blks_read", block_size).alias("index_read_bytes"),
        blocks_to_bytes("increase_idx_blks_hit", block_size).alias("index_hit_bytes"),
        hit_ratio("increase_idx_blks_read", "increase_idx_blks_hit").alias("hit_ratio"),
    ).where((F.col("index_read_bytes") > 0) | (F.col("index_hit_bytes") > 0))


def top_indexes(base: DataFrame, kind: str, k: int = DEFAULT_LIMIT, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Indexes by bytes ``read`` or ``hit``."""
    metric = f"index_{kind}_bytes"
    cut = top_k(base.select(*scope, "index_name", metric, "hit_ratio"), metric, k, ties=["index_name"], scope=scope)
    return cut.withColumn(f"index_{kind}_text", human_bytes(metric))


def unused_indexes(indexes: DataFrame, scope: Sequence[str] = SCOPE, unused: str = "any") -> DataFrame:
    """Droppable indexes without scans: no constraint rests on them, they are not unique and not on an expression.

    ``any`` takes an index that shows no scan in some snapshot of the window, ``all`` one that shows none in any.
    """
    if unused not in ("any", "all"):
        raise ValueError(f"unknown rule {unused!r}")
    droppable = indexes.where(
        (F.col("indkey").cast("string") != EXPRESSION_KEY)
        & F.col("conname").isNull()
        & ~F.col("indisunique")
        & ~F.col("schemaname").isin(*SYSTEM_SCHEMAS)
    )
    named = droppable.select(
        *scope,
        qualified_name("schemaname", "relname").alias("table_name"),
        qualified_name(*SPEC.keys).alias("index_name"),
        "idx_scan",
    )
    names = [*scope, "table_name", "index_name"]
    if unused == "any":
        return named.where(F.col("idx_scan") == 0).select(*names).distinct()
    most = named.groupBy(*names).agg(F.max("idx_scan").alias("_scans"))
    return most.where(F.col("_scans") == 0).select(*names)


def unused_index_tables(unused: DataFrame, k: int = DEFAULT_LIMIT, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Tables by their number of unused indexes."""
    counted = unused.groupBy(*scope, "table_name").agg(F.count(F.lit(1)).alias("unused_indexes"))
    return top_k(counted, "unused_indexes", k, ties=["table_name"], scope=scope)


def unused_index_list(unused: DataFrame, k: int = UNUSED_INDEX_LIST, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Unused indexes by table name."""
    return top_k(
        unused, "table_name", k, ties=["index_name"], scope=scope, positive=False, descending=False
    )


def index_findings(base: DataFrame, unused: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    poorly_cached = base.where(F.col("hit_ratio") < LOW_HIT_RATIO).select(*scope).distinct()
    return finding(
        unused.select(*scope).distinct(),
        "index",
        "There are unused indexes; dropping them saves the I/O of keeping them up to date.",
        scope,
    ).unionByName(
        finding(poorly_cached, "index", "Some indexes have a low cache-hit ratio; see the index I/O lists.", scope)
    )
