"""Background-writer and checkpoint report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import BLOCK_SIZE, blocks_to_bytes, hit_ratio, human_bytes, per_minute
from snapdelta.operators.summaries import increase
from snapdelta.plans.findings import LOW_TIMED_SHARE, finding, off_hosts
from snapdelta.schema import SCOPE, STATS

SPEC = STATS["pg_stat_bgwriter"]
WRITTEN = {
    "checkpoint_bytes": "buffers_checkpoint",
    "bgwriter_bytes": "buffers_clean",
    "backend_bytes": "buffers_backend",
}


def bgwriter_summary(
    bgwriter: DataFrame, *, scope: Sequence[str] = SCOPE, block_size: int = BLOCK_SIZE, **increase_options
) -> DataFrame:
    """Checkpoints and bytes written per scope, summed over the stretches between statistics resets."""
    increase_options.setdefault("gaps", "lag")
    by_reset = increase(bgwriter, SPEC.counters, [*scope, *SPEC.keys], **increase_options)
    total = by_reset.groupBy(*scope).agg(
        F.max("stats_reset").alias("last_reset"),
        F.sum("increase_checkpoints_timed").alias("checkpoints_timed"),
        F.sum("increase_checkpoints_req").alias("checkpoints_requested"),
        *[blocks_to_bytes(f"sum(increase_{c})", block_size).alias(name) for name, c in WRITTEN.items()],
        F.sum("elapsed_seconds").alias("_seconds"),
    )
    return total.select(
        *scope,
        "last_reset",
        "checkpoints_timed",
        "checkpoints_requested",
        *WRITTEN,
        *[human_bytes(name).alias(name.removesuffix("_bytes") + "_text") for name in WRITTEN],
        hit_ratio("checkpoints_requested", "checkpoints_timed").alias("timed_percent"),
        per_minute("_seconds", "checkpoints_timed + checkpoints_requested").alias(
            "checkpoints_per_minute"
        ),
    )


def bgwriter_findings(
    summary: DataFrame, aurora: DataFrame | None = None, scope: Sequence[str] = SCOPE
) -> DataFrame:
    """Too few timed checkpoints, on hosts other than those in ``aurora``."""
    low = off_hosts(summary.where(F.col("timed_percent") < LOW_TIMED_SHARE), aurora, scope)
    return finding(
        low,
        "bgwriter",
        "Under 90% of the checkpoints ran on schedule: WAL fills up before its time. Let more of it gather between two of them.",
        scope,
    )
