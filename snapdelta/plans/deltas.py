"""Deltas of everything a statistic counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from snapdelta.operators.delta import counter_delta
from snapdelta.schema import SCOPE, STATS, with_exec_time


def stat_deltas(df: DataFrame, stat: str, *, scope: Sequence[str] = SCOPE, **delta_options) -> DataFrame:
    """``delta_<column>`` for every counter and gauge of the statistic that the frame has.

    All of them share one window and one sort. Folding duplicate rows (``duplicates``) keeps the counters only.
    """
    spec = STATS[stat]
    rows = with_exec_time(df) if stat == "pg_stat_statements" else df
    gauges = () if delta_options.get("duplicates") else spec.gauges
    columns = spec.present(rows, (*spec.counters, *gauges))
    return counter_delta(rows, columns, [*scope, *spec.keys], **delta_options)
