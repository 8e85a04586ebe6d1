"""Wait-event counts per time window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snapdelta.functions.scalars import wait_or_cpu
from snapdelta.schema import SCOPE, TIME
from snapdelta.sources.shared import remove


def wait_windows(
    activity: DataFrame,
    *,
    delay: str,
    width: str = "1 hour",
    scope: Sequence[str] = SCOPE,
    time: str = TIME,
) -> DataFrame:
    """Samples per tumbling window, wait event and type; on a stream or on a plain frame.

    On a stream, a window is final once the newest sample of any host is ``delay`` past its end; samples that come later
    are not counted. There is no default: name a delay longer than any host's files lag behind the others' (with hourly
    capture, several hours), or recount from the lake, where nothing is ever late.
    """
    named = activity.select(
        F.col(time).cast("timestamp").alias(time),
        *scope,
        wait_or_cpu("wait_event").alias("wait_event"),
        wait_or_cpu("wait_event_type").alias("wait_event_type"),
    )
    counted = (
        named.withWatermark(time, delay)
        .groupBy(F.window(time, width), *scope, "wait_event", "wait_event_type")
        .agg(F.count(F.lit(1)).alias("total_samples"))
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *scope,
        "wait_event",
        "wait_event_type",
        "total_samples",
    )


def land_wait_windows(activity: DataFrame, target: str, checkpoint: str, **options) -> StreamingQuery:
    """Append the windows that have become final and stop; run it on a schedule."""
    return (
        wait_windows(activity, **options)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )


@dataclass(frozen=True)
class WaitCounts:
    """Samples per window, wait event and type of a stream whose rows may come in any order and at any time.

    Nothing is ever too late: a batch leaves its own counts as a table (``root/part/batch=N``), and the counts of a window
    are the sum of what all batches counted in it. Partial counts are small, a row per window, scope, event and type;
    ``fold`` puts those of many batches together. A batch that runs again replaces its table. Rows without a time are in no
    window.
    """

    root: str
    width: str = "1 hour"
    scope: Sequence[str] = SCOPE
    time: str = TIME

    @property
    def _keys(self) -> list[str]:
        return ["window_start", "window_end", *self.scope, "wait_event", "wait_event_type"]

    def _sum(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self._keys).agg(F.sum("total_samples").alias("total_samples"))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        named = batch.where(F.col(self.time).isNotNull()).select(
            F.window(F.col(self.time).cast("timestamp"), self.width).alias("window"),
            *self.scope,
            wait_or_cpu("wait_event").alias("wait_event"),
            wait_or_cpu("wait_event_type").alias("wait_event_type"),
            F.lit(1).cast("long").alias("total_samples"),
        )
        starts = named.select("*", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))
        self._sum(starts).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/part/batch={batch_id}")

    def _folded(self, spark: SparkSession) -> list[int]:
        """Batches up to which counts have been folded, the last one last; a fold that was cut off is none."""
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/whole")
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = files.listStatus(folder) if files.exists(folder) else []
        done = [s.getPath() for s in found if files.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted(int(p.getName().removeprefix("upto=")) for p in done)

    def _parts(self, spark: SparkSession, after: int, upto: int | None = None) -> DataFrame:
        rows = spark.read.parquet(f"{self.root}/part").where(F.col("batch") > after)
        return (rows if upto is None else rows.where(F.col("batch") <= upto)).drop("batch")

    def counts(self, spark: SparkSession) -> DataFrame:
        """The counts of all windows, as far as samples have arrived."""
        folded = self._folded(spark)
        rows = self._parts(spark, folded[-1] if folded else -1)
        if folded:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{self.root}/whole/upto={folded[-1]}"))
        return self._sum(rows)

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Put the counts of all batches up to a finished one together, then drop the fold before it. Readers see the old counts or
        the new ones, which are equal; the last batch must not be folded while it may run again."""
        folded = self._folded(spark)
        if folded and folded[-1] >= upto:
            return
        rows = self._parts(spark, folded[-1] if folded else -1, upto)
        if folded:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{self.root}/whole/upto={folded[-1]}"))
        self._sum(rows).write.mode("overwrite").parquet(f"{self.root}/whole/upto={upto}")
        for old in folded[:-1]:
            remove(spark, f"{self.root}/whole/upto={old}")

    def start(self, activity: DataFrame, checkpoint: str) -> StreamingQuery:
        """Count what has arrived and stop; run it on a schedule."""
        return activity.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
