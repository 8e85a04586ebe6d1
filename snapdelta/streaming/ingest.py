"""Snapshot files as they arrive, landed in the compacted layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from snapdelta.schema import SCOPE, STATS, TIME
from snapdelta.sources.days import land_days
from snapdelta.sources.lake import _FILE_FIELDS, _PARTITION_FIELDS, _parse_csv, _pattern, compact_snapshots, conformed, require_utc
from snapdelta.sources.shared import remove


def stream_snapshots(
    spark: SparkSession,
    root: str,
    stat: str,
    *,
    file_format: str = "parquet",
    schema: T.StructType | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A stream of one statistic's rows from the lake; every file is read once."""
    require_utc(spark)
    wanted = schema or STATS[stat].schema
    reader = spark.readStream.option("basePath", root)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    pattern = _pattern(root, stat)
    if file_format == "csv":
        files = reader.format("binaryFile").schema(T.StructType(_FILE_FIELDS + _PARTITION_FIELDS)).load(pattern)
        return _parse_csv(files, wanted)
    full = T.StructType(list(wanted) + _PARTITION_FIELDS)
    return reader.format(file_format).schema(full).load(pattern).select(*SCOPE, *wanted.names)


def land_stream(rows: DataFrame, target: str, stat: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to the compacted layout as it is and stop; ``FoldingIngest`` folds it on the way."""
    dated = rows.select("*", F.lit(stat).alias("stat"), F.to_date(TIME).alias("snapshot_date"))
    return (
        dated.writeStream.format("parquet")
        .partitionBy("stat", "snapshot_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )


@dataclass(frozen=True)
class FoldingIngest:
    """Lands a stream as ``compact_snapshots`` lands whole days: one row per entity and snapshot, sorted by entity.

    What arrives is kept by day and batch under ``arrived``. A batch then folds the whole of each day that it touches and puts
    it in the place of what was landed for that day, under ``target`` and, if ``summaries`` is named, as day summaries
    there. So rows of a day may arrive in any number of batches and in any order, and a batch that runs again, after an
    error at any point, gives the same days. Work grows with the days that a batch touches. Rows without a time are no
    snapshots and are left out.
    """

    target: str
    stat: str
    arrived: str
    summaries: str | None = None

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        require_utc(spark)
        rows = conformed(batch, self.stat).where(F.col(TIME).isNotNull())
        dated = rows.withColumn("snapshot_date", F.to_date(F.col(TIME).cast("timestamp"))).withColumn("batch", F.lit(batch_id).cast("long"))
        (
            dated.hint("rebalance", "snapshot_date")
            .write.partitionBy("snapshot_date", "batch")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(self.arrived)
        )
        places = [T.StructField("snapshot_date", T.DateType()), T.StructField("batch", T.LongType())]
        kept = spark.read.schema(T.StructType([*rows.schema, *places])).parquet(self.arrived)
        # As many dates as days are touched, from the names of folders.
        touched = [r[0] for r in kept.where(F.col("batch") == batch_id).select("snapshot_date").distinct().collect()]
        if not touched:
            return
        days = kept.where(F.col("snapshot_date").isin(touched)).drop("snapshot_date", "batch")
        compact_snapshots(days, self.target, self.stat)
        if self.summaries:
            land_days(days, self.summaries, self.stat)

    def forget(self, spark: SparkSession, days: list[str]) -> None:
        """Drop what had arrived for days (``yyyy-mm-dd``) that nothing more is expected of; they stay landed."""
        for day in days:
            remove(spark, f"{self.arrived}/snapshot_date={day}")

    def start(self, rows: DataFrame, checkpoint: str) -> StreamingQuery:
        """Land what has arrived and stop; run it on a schedule."""
        return rows.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
