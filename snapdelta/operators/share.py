"""Totals per host and database beside the entities they are shared by."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_totals(df: DataFrame, totals: Mapping[str, Column], scope: Sequence[str]) -> DataFrame:
    """Add aggregates of the whole ``scope`` group to each of its rows, by name.

    Totals combine before they are shuffled and come back by a join that matches nulls, so no task ever holds the rows of a
    group. Both sides read ``df``, which has one row per entity: a written report settles it, so that it is computed once.
    Without a scope the totals are one scalar subquery.
    """
    if scope:
        summed = df.groupBy(*scope).agg(*[total.alias(name) for name, total in totals.items()])
        named = summed.withColumnsRenamed({c: f"_of_{c}" for c in scope})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in scope])
        return df.join(named, same, "inner").select(*df.columns, *totals)
    summed = df.agg(*[total.alias(name) for name, total in totals.items()])
    row = summed.select(F.struct(*summed.columns)).scalar().alias("_totals")
    return df.select("*", row).select("*", "_totals.*").drop("_totals")
