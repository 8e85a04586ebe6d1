"""Rule-based findings as rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.schema import SCOPE

# Percentages below which cache hits and timed checkpoints are remarked on.
LOW_HIT_RATIO = 99
LOW_TIMED_SHARE = 90


def finding(where: DataFrame, category: str, recommendation: str, scope: Sequence[str] = SCOPE) -> DataFrame:
    """One finding for every row of ``where``."""
    return where.select(*scope, F.lit(category).alias("category"), F.lit(recommendation).alias("recommendation"))


def _matches(df: DataFrame, hosts: DataFrame, scope: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on the scope columns both have, null-safe; without any, ``hosts`` stands for everything or nothing."""
    keys = [c for c in scope if c in hosts.columns and c in df.columns]
    if not keys:
        there = hosts.agg((F.count(F.lit(1)) > 0).alias("there")).scalar()
        return df.where(there if how == "left_semi" else ~there)
    named = hosts.select(*[F.col(c).alias(f"_of_{c}") for c in keys])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys])
    return df.join(named, same, how)


def on_hosts(df: DataFrame, hosts: DataFrame | None, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Rows of the named hosts (by the scope columns ``hosts`` has); all rows when it is unset."""
    return df if hosts is None else _matches(df, hosts, scope, "left_semi")


def off_hosts(df: DataFrame, hosts: DataFrame | None, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Rows of all other hosts; all rows when ``hosts`` is unset."""
    return df if hosts is None else _matches(df, hosts, scope, "left_anti")
