"""Largest entities by a metric, over everything or within each host and database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdelta.schema import SCOPE

# How many entities a list shows unless told otherwise, and the sizes of the two fixed lists.
DEFAULT_LIMIT = 50
TOP_FINDINGS = 5
UNUSED_INDEX_LIST = 500


def top_k(
    df: DataFrame,
    metric: str,
    k: int = DEFAULT_LIMIT,
    *,
    ties: Sequence[str],
    scope: Sequence[str] = SCOPE,
    positive: bool = True,
    descending: bool = True,
) -> DataFrame:
    """The ``k`` rows with the largest ``metric`` per ``scope`` group, with their ``rank``; ``ties`` settle equals.

    With an empty scope the list is global and no rank is added. Each task keeps at most ``k`` rows of a group
    before the shuffle in both forms, so a group that holds most of the rows does not gather them.
    """
    if positive:
        df = df.where(F.col(metric) > 0)
    order = [F.desc(metric) if descending else F.asc(metric), *[F.asc(t) for t in ties]]
    if not scope:
        return df.orderBy(*order).limit(k)
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*scope).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def top_lists(
    df: DataFrame,
    lists: Mapping[str, tuple[str, int, bool]],
    *,
    ties: Sequence[str],
    scope: Sequence[str] = SCOPE,
) -> DataFrame:
    """Several top lists of one frame in one scan and one shuffle: its rows with ``list`` and ``rank``.

    ``lists``: name to (metric, length, only positive ones). A row is spread to one row per metric, and all lists are ranked
    by one window per scope and list, which keeps as many rows of each as the longest has before the shuffle. Metrics are
    compared as whole numbers of up to 38 digits. Each list equals ``top_k`` of its metric.
    """
    wanted = [
        F.when(F.col(metric) > 0 if positive else F.lit(True), F.struct(F.lit(name).alias("list"), F.col(metric).cast("decimal(38,0)").alias("_value"), F.lit(k).alias("_k")))
        for name, (metric, k, positive) in lists.items()
    ]
    spread = df.select("*", F.explode(F.array_compact(F.array(*wanted))).alias("_entry")).select("*", "_entry.*").drop("_entry")
    within = Window.partitionBy(*scope, "list").orderBy(F.desc("_value"), *[F.asc(t) for t in ties])
    longest = max(k for _, k, _ in lists.values())
    ranked = spread.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= longest)
    return ranked.where(F.col("rank") <= F.col("_k")).drop("_value", "_k")


def one_list(lists: DataFrame, name: str, scope: Sequence[str] = SCOPE) -> DataFrame:
    """One of several top lists, as ``top_k`` gives it; a global list has no rank."""
    cut = lists.where(F.col("list") == name).drop("list")
    return cut if scope else cut.drop("rank")
