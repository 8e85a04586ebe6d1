"""Snapshots in bucketed tables: rows of an entity lie together, so that deltas and increases move nothing.

A table has a bucket per so many entities, by hash of ``CLUSTERED_BY``, within each day; what is grouped or windowed by a key
that holds these columns reads bucket by bucket without an exchange. The table's files lie under a path of their own; its
name stands in the session's catalog.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdelta.schema import SCOPE, STATS, TIME
from snapdelta.sources.lake import _in_scope, _not_empty, as_utc, conformed, fold_duplicates, in_window, require_utc

#: What a statistic's rows are dealt to buckets by: columns that tell most entities apart.
CLUSTERED_BY = {
    "pg_stat_statements": ("host", "queryid"),
    "table_stats": ("host", "relname"),
    "index_stats": ("host", "indexrelname"),
    "pg_stat_database": ("host", "datname"),
}
BUCKETS = 64


def cluster_snapshots(df: DataFrame, table: str, path: str, stat: str, *, buckets: int = BUCKETS, fold: bool = True) -> None:
    """Land whole days as a bucketed table under ``path``, one row per entity and snapshot, sorted by entity and time.

    The table is written anew; choose ``buckets`` so that a bucket of all days fits a task. Rows go to their buckets before they
    are written, so a day has one file per bucket.
    """
    require_utc(df.sparkSession)
    rows = conformed(df, stat)
    rows = fold_duplicates(rows, stat) if fold else rows
    by = [c for c in CLUSTERED_BY[stat] if c in rows.columns]
    order = list(dict.fromkeys(c for c in (*by, *SCOPE, *STATS[stat].keys, TIME) if c in rows.columns))
    dated = rows.withColumn("snapshot_date", F.to_date(F.col(TIME).cast("timestamp")))
    writer = dated.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*order).option("path", path).mode("overwrite")
    writer.format("parquet").saveAsTable(table)


def read_clustered(
    spark: SparkSession, table: str, stat: str, start: datetime | None = None, end: datetime | None = None, *,
    hosts: Sequence[str] | None = None, databases: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of a clustered table in a window; an error if there is none. Reports over them are ``folded`` ones."""
    require_utc(spark)
    rows = spark.table(table)
    if start is not None:
        rows = rows.where(F.col("snapshot_date") >= F.lit(as_utc(start).date()))
    if end is not None:
        rows = rows.where(F.col("snapshot_date") <= F.lit(as_utc(end).date()))
    return _not_empty(_in_scope(rows.where(in_window(start, end)), hosts, databases).drop("snapshot_date"), stat)
