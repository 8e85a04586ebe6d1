"""Table report: blocks of the four block families, vacuum activity, findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import (
    BLOCK_SIZE,
    blocks_to_bytes,
    hit_ratio,
    human_bytes,
    is_toast,
    qualified_name,
    whole_percent_of,
)
from snapdelta.operators.share import with_totals
from snapdelta.operators.summaries import increase
from snapdelta.operators.topk import DEFAULT_LIMIT, one_list, top_k, top_lists
from snapdelta.plans.findings import LOW_HIT_RATIO, finding
from snapdelta.schema import SCOPE, STATS

SPEC = STATS["table_stats"]
FAMILIES = {"heap": "heap", "index": "idx", "toast": "toast", "toast_index": "tidx"}
#: Dead rows as additive aggregates: their sum, and that of the share of dead rows in hundredths of a percent, with the rows that have one.
_SHARE = (
    "cast(case when n_dead_tup = 0 then 0 when n_dead_tup + n_live_tup <> 0 "
    "then round(n_dead_tup * 10000.0D / (n_dead_tup + n_live_tup), 0) end as bigint)"
)
DEAD_ROWS = {
    "_dead": "sum(n_dead_tup)",
    "_dead_rows": "count(n_dead_tup)",
    "_ratio": f"sum({_SHARE})",
    "_ratio_rows": f"count({_SHARE})",
}
METRICS = [f"{family}_{kind}_bytes" for family in FAMILIES for kind in ("read", "hit")]


def table_activity(
    tables: DataFrame,
    *,
    scope: Sequence[str] = SCOPE,
    families: Sequence[str] = tuple(FAMILIES),
    vacuum: bool = True,
    block_size: int = BLOCK_SIZE,
    **increase_options,
) -> DataFrame:
    """What the table report needs, one row per table and one pass over the rows.

    Name the block ``families`` and leave ``vacuum`` out where only some of it is wanted: counters that are not
    asked for are not read. Any counter may be null; with vacuums, tables with
    nulls between values take a second pass.
    """
    blocks = [(family, FAMILIES[family], kind) for family in families for kind in ("read", "hit")]
    counters = [f"{short}_blks_{kind}" for _, short, kind in blocks]
    if not vacuum and increase_options.get("settle") is None:
        increase_options.setdefault("gaps", "lag")
    grown = increase(
        tables,
        counters + (["vacuum_count", "autovacuum_count"] if vacuum else []),
        [*scope, *SPEC.keys],
        aggregates={name: F.expr(sql) for name, sql in DEAD_ROWS.items()} if vacuum else None,
        **increase_options,
    )
    # Whole-number averages from integer sums, so their value does not depend on the order of the rows.
    vacuum_columns = {
        "manual_vacuums": "increase_vacuum_count",
        "autovacuums": "increase_autovacuum_count",
        "average_dead_rows": "case when _dead_rows > 0 then _dead div _dead_rows end",
        "dead_row_ratio": "case when _ratio_rows > 0 then _ratio div (100 * _ratio_rows) end",
    }
    return grown.select(
        *scope,
        "schemaname",
        qualified_name("schemaname", "relname").alias("table_name"),
        *[
            blocks_to_bytes(f"increase_{short}_blks_{kind}", block_size).alias(f"{family}_{kind}_bytes")
            for family, short, kind in blocks
        ],
        *[
            hit_ratio(f"increase_{FAMILIES[f]}_blks_read", f"increase_{FAMILIES[f]}_blks_hit").alias(f"{f}_hit_ratio")
            for f in families
        ],
        *([F.expr(sql).alias(name) for name, sql in vacuum_columns.items()] if vacuum else []),
    )


def table_base(activity: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Tables that moved any block of the families in ``activity``."""
    families = [f for f in FAMILIES if f"{f}_hit_ratio" in activity.columns]
    metrics = [m for m in METRICS if m in activity.columns]
    return activity.where(" or ".join(f"{m} > 0" for m in metrics)).select(
        *scope, "table_name", *metrics, *[f"{family}_hit_ratio" for family in families]
    )


def with_texts(base: DataFrame) -> DataFrame:
    sizes = [m for m in METRICS if m in base.columns]
    return base.select("*", *[human_bytes(m).alias(m.removesuffix("_bytes") + "_text") for m in sizes])


def top_tables(
    base: DataFrame, family: str, kind: str, k: int = DEFAULT_LIMIT, scope: Sequence[str] = SCOPE
) -> DataFrame:
    """Tables by bytes of one family (heap, index, toast, toast_index), ``read`` or ``hit``."""
    metric = f"{family}_{kind}_bytes"
    narrow = base.select(*scope, "table_name", metric, f"{family}_hit_ratio")
    cut = top_k(narrow, metric, k, ties=["table_name"], scope=scope)
    return cut.withColumn(f"{family}_{kind}_text", human_bytes(metric))


def all_lists(base: DataFrame, k: int = DEFAULT_LIMIT, scope: Sequence[str] = SCOPE) -> DataFrame:
    """The eight lists at once, rows named by ``list`` as ``<family>_<kind>``; ``list_of`` takes one out."""
    return top_lists(base, {m.removesuffix("_bytes"): (m, k, True) for m in METRICS}, ties=["table_name"], scope=scope)


def list_of(lists: DataFrame, family: str, kind: str, scope: Sequence[str] = SCOPE) -> DataFrame:
    """One of ``all_lists``, as ``top_tables`` gives it."""
    metric, ranks = f"{family}_{kind}_bytes", ["rank"] if scope else []
    cut = one_list(lists, f"{family}_{kind}", scope).select(*scope, "table_name", metric, f"{family}_hit_ratio", *ranks)
    return cut.withColumn(f"{family}_{kind}_text", human_bytes(metric))


def vacuum_efficiency(activity: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Vacuums per table and their share of all vacuums of the scope (toast tables count in the totals only)."""
    counted = activity.select(
        *scope, "schemaname", "table_name", "manual_vacuums", "autovacuums", "average_dead_rows", "dead_row_ratio"
    )
    shared = with_totals(counted, {"_manual": F.sum("manual_vacuums"), "_auto": F.sum("autovacuums")}, scope)
    return (
        shared.where(~is_toast("schemaname") & ((F.col("manual_vacuums") > 0) | (F.col("autovacuums") > 0)))
        .select(
            *scope,
            "table_name",
            (F.col("_manual") + F.col("_auto")).alias("total_vacuums"),
            "manual_vacuums",
            whole_percent_of("_manual", "manual_vacuums").alias("manual_vacuum_percent"),
            "autovacuums",
            whole_percent_of("_auto", "autovacuums").alias("autovacuum_percent"),
            "average_dead_rows",
            "dead_row_ratio",
        )
        .orderBy(*scope, F.desc("dead_row_ratio"), F.desc("average_dead_rows"), "table_name")
    )


def table_findings(base: DataFrame, scope: Sequence[str] = SCOPE, more_than: int = 1) -> DataFrame:
    """A row per scope where more than ``more_than`` tables of one family are served poorly from cache."""
    low = [F.count_if(F.col(f"{family}_hit_ratio") < LOW_HIT_RATIO).alias(family) for family in FAMILIES]
    found = base.groupBy(*scope).agg(*low)
    return finding(
        found.where(" or ".join(f"{family} > {int(more_than)}" for family in FAMILIES)),
        "table",
        "Several tables have a low cache-hit ratio; see the table I/O lists.",
        scope,
    )
