"""Counter deltas over a stream of snapshots.

Every micro-batch is compared with the last known row of each of its entities, which is kept in tables beside the
output (``PartedState``). The batch logic is the ordinary delta operator, so all work stays in generated code. A batch that is run again overwrites what its first run wrote.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snapdelta.operators.delta import _change, any_null, one_row_per_snapshot, previous_row
from snapdelta.schema import TIME
from snapdelta.sources.shared import remove, settle
from snapdelta.streaming.state import PART, PartedState


@dataclass(frozen=True)
class DeltaStream:
    """Where a delta stream keeps its tables, and how it differences.

    Rows of one snapshot of an entity must arrive in one batch. A row that is not newer than its entity's last known
    row goes to ``late``; recomputing from the lake remains the way to take it in. The last known rows are a
    ``PartedState``: a batch reads and writes those of the parts (``parts``, ``most``, ``part_by``) that its entities are in.
    """

    root: str
    counters: Sequence[str]
    keys: Sequence[str]
    time: str = TIME
    on_reset: str = "raw"
    duplicates: str | None = None
    slice_seconds: int | None = None
    parts: int = 64
    most: int = 16
    part_by: Sequence[str] | None = None

    def _path(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch={batch_id}"

    @property
    def state(self) -> PartedState:
        return PartedState(f"{self.root}/state", list(self.keys), self.time, self.parts, self.most, self.part_by)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Write the deltas, the late rows and what is known now of one micro-batch."""
        spark = batch.sparkSession
        if self.duplicates:
            batch = one_row_per_snapshot(batch, self.counters, self.keys, self.duplicates, self.time)
        rows = settle(batch.withColumn(PART, self.state.part()), self._path("work", batch_id))
        touched = sorted(r[PART] for r in rows.select(PART).distinct().collect())
        like = rows.select(*self.keys, self.time, *self.counters)
        known = self.state.known(spark, batch_id, touched, like.schema)
        names = {c: f"_known_{c}" for c in (self.time, *self.counters)}
        joined = rows.drop(PART).join(known.withColumnsRenamed(names), list(self.keys), "left")
        # Three results are written from the joined batch: it is a table, too, of the batch's size.
        joined = settle(joined, f"{self._path('work', batch_id)}-joined")
        self._write(batch.columns, joined, batch_id)
        fresh = joined.where(~self._late()).where(~any_null(self.keys))
        self.state.put(spark, batch_id, touched, fresh.select(*like.columns))
        for path in (self._path("work", batch_id), f"{self._path('work', batch_id)}-joined"):
            remove(spark, path)

    def _late(self) -> Column:
        last = F.col(f"_known_{self.time}")
        return last.isNotNull() & (F.col(self.time) <= last)

    def _write(self, columns: Sequence[str], joined: DataFrame, batch_id: int) -> None:
        looked_back = previous_row(joined.where(~self._late()), self.counters, self.keys, self.time, self.slice_seconds)
        previous = {c: f"(case when has_prev then `prev_{c}` else `_known_{c}` end)" for c in self.counters}
        deltas = looked_back.select(
            *columns,
            *[
                F.expr(f"cast({_change(f'`{c}`', previous[c], self.on_reset)} as {kind})").alias(f"delta_{c}")
                for c, kind in joined.select(*self.counters).dtypes
            ],
        )
        deltas.write.mode("overwrite").parquet(self._path("deltas", batch_id))
        joined.where(self._late()).select(*columns).write.mode("overwrite").parquet(self._path("late", batch_id))

    def start(self, rows: DataFrame, checkpoint: str) -> StreamingQuery:
        """Difference what has arrived and stop; run it on a schedule."""
        return (
            rows.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def deltas(self, spark: SparkSession) -> DataFrame:
        """All deltas written so far."""
        return spark.read.parquet(f"{self.root}/deltas").drop("batch")

    def late(self, spark: SparkSession) -> DataFrame:
        """All rows that came too late."""
        return spark.read.parquet(f"{self.root}/late").drop("batch")
