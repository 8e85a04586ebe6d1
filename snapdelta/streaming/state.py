"""The last known row of each entity of a stream, kept as tables of which a batch writes only what it touched."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdelta.schema import SCOPE
from snapdelta.sources.shared import exists, remove

PART = "_part"
_LIVE = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("batches", T.ArrayType(T.LongType()))])


@dataclass(frozen=True)
class PartedState:
    """Rows by entity in ``parts`` parts, each a short list of tables that successive batches left.

    A batch adds one table per part that it touches, with its own entities only. A part that has gathered ``most`` tables is
    written as a whole instead, so over time a row is written again once per ``most`` batches that touch its part, and
    entities of other parts are neither read nor written. Entities are dealt to parts by ``part_by``, by default the host and database:
    what one capture brings lies in few parts. Which tables are live after a batch is written last, in ``live``; a batch
    that runs again starts from what was live before it and puts the same tables in the place of the first ones.
    """

    root: str
    keys: Sequence[str]
    time: str
    parts: int = 64
    most: int = 16
    part_by: Sequence[str] | None = None

    def part(self) -> Column:
        by = self.part_by or [c for c in SCOPE if c in self.keys] or list(self.keys)
        return F.pmod(F.xxhash64(*by), F.lit(self.parts)).cast("int")

    def _path(self, batch: int, part: int) -> str:
        return f"{self.root}/rows/batch={batch}/{PART}={part}"

    def live(self, spark: SparkSession, batch_id: int) -> dict[int, list[int]]:
        """The live tables of each part after a batch: at most ``parts`` rows."""
        if batch_id < 0:
            return {}
        rows = spark.read.schema(_LIVE).parquet(f"{self.root}/live/batch={batch_id}").collect()
        return {r["part"]: list(r["batches"]) for r in rows}

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in (*self.keys, self.time)]
        return rows.groupBy(*self.keys).agg(F.max(self.time).alias(self.time), *[F.max_by(c, self.time).alias(c) for c in values])

    def known(self, spark: SparkSession, batch_id: int, touched: Sequence[int], schema: T.StructType) -> DataFrame:
        """What was known before a batch of the entities in the parts it touches."""
        live = self.live(spark, batch_id - 1)
        paths = [self._path(batch, part) for part in touched for batch in live.get(part, [])]
        return self._newest(spark.read.schema(schema).parquet(*paths)) if paths else spark.createDataFrame([], schema)

    def put(self, spark: SparkSession, batch_id: int, touched: Sequence[int], rows: DataFrame) -> None:
        """Add the batch's entities (their newest row) to their parts, and say what is live now."""
        before = self.live(spark, batch_id - 1)
        full = [part for part in touched if len(before.get(part, [])) >= self.most]
        newest = self._newest(rows).withColumn(PART, self.part())
        if full:
            older = self.known(spark, batch_id, full, rows.schema).withColumn(PART, self.part())
            whole = self._newest(older.drop(PART).unionByName(newest.where(F.col(PART).isin(full)).drop(PART)))
            newest = newest.where(~F.col(PART).isin(full)).unionByName(whole.withColumn(PART, self.part()).select(*newest.columns))
        newest.repartition(PART).write.mode("overwrite").partitionBy(PART).parquet(f"{self.root}/rows/batch={batch_id}")
        held = {r[PART] for r in spark.read.parquet(f"{self.root}/rows/batch={batch_id}").select(PART).distinct().collect()} if touched else set()
        after = dict(before)
        for part in touched:
            if part in held:
                after[part] = [batch_id] if part in full else [*before.get(part, []), batch_id]
        spark.createDataFrame(list(after.items()), _LIVE).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/live/batch={batch_id}")
        # What the batch before had already given up is of no more use; a batch that runs again needs what was live before it.
        if batch_id >= 2 and exists(spark, f"{self.root}/live/batch={batch_id - 2}"):
            old = self.live(spark, batch_id - 2)
            for part, batches in old.items():
                for batch in batches:
                    if batch not in before.get(part, []):
                        remove(spark, self._path(batch, part))
            remove(spark, f"{self.root}/live/batch={batch_id - 2}")
