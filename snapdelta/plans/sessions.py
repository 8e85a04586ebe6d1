"""Wait-event report: what active sessions were waiting for when sampled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import wait_or_cpu
from snapdelta.schema import SCOPE


def _samples(activity: DataFrame, columns: Sequence[str], scope: Sequence[str]) -> DataFrame:
    named = activity.select(*scope, *[wait_or_cpu(c).alias(c) for c in columns])
    counted = named.groupBy(*scope, *columns).agg(F.count(F.lit(1)).alias("total_samples"))
    return counted.orderBy(*scope, F.desc("total_samples"), *columns)


def wait_events(activity: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Samples per wait event, most frequent first."""
    return _samples(activity, ["wait_event", "wait_event_type"], scope)


def wait_event_types(activity: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Samples per type of wait, most frequent first."""
    return _samples(activity, ["wait_event_type"], scope)
