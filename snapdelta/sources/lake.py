"""The snapshot lake: partitioned files of stamped statistics rows.

Layout: ``host=/database=/stat=/year=/month=/day=/hour=/minute=/`` with plain numbers, as Parquet or as gzipped CSV.
A local path, an object store and HDFS differ only in the path. ``compact_snapshots`` re-lands a statistic by day,
sorted by entity, which is the layout to keep for long windows over many hosts.
"""

from __future__ import annotations

import csv
import gzip
import io
import re
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdelta.functions.scalars import epoch_seconds
from snapdelta.operators.quality import DataQualityError
from snapdelta.schema import SCOPE, STATS, TIME, with_exec_time

# The partition columns of the lake in their order, and the text form of times in CSV files.
CLOCK = ("year", "month", "day", "hour", "minute")
PARTITIONS = (*SCOPE, "stat", *CLOCK)
CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
UTC_NAMES = ("UTC", "Etc/UTC", "Etc/UCT", "UCT", "GMT", "Etc/GMT", "Z", "+00:00", "Zulu", "Universal")
# Fixed value: the text column in which the duplicate rows of an entity differ (the constraints on one index).
VARYING = ("conname",)
ROWS_PER_CHUNK = 50_000
FILES_PER_READ = 10_000
MOST_ALTERNATIVES = 62

_PARTITION_FIELDS = [T.StructField(c, T.StringType()) for c in (*SCOPE, "stat")] + [
    T.StructField(c, T.IntegerType()) for c in CLOCK
]
_FILE_FIELDS = [
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
]


def require_utc(spark: SparkSession) -> None:
    """The lake's clock is UTC: partition values and text times mean nothing in another session time zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


def stamp(df: DataFrame, host: str, database: str, at: datetime | None = None) -> DataFrame:
    """Put scope and snapshot time before the columns of a fresh extract: one time for the whole batch, that of the query
    which reads it unless ``at`` is named."""
    time = F.current_timestamp() if at is None else F.lit(at.astimezone(timezone.utc))
    return df.select(F.lit(host).alias("host"), F.lit(database).alias("database"), time.alias(TIME), "*")


def conformed(df: DataFrame, stat: str) -> DataFrame:
    """Rows with the statistic's columns in its types, as far as they are there, and all other columns as they are."""
    kinds = {field.name: field.dataType for field in STATS[stat].schema}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def write_snapshots(
    df: DataFrame, root: str, stat: str, *, file_format: str = "parquet", mode: str = "append"
) -> None:
    """Append rows to the lake.

    Rows are brought together by partition before writing, so each partition gets few files; a partition that is
    much larger than the others is split again at run time. Columns of the statistic are cast to its types, so that
    whatever a driver or a server version calls them reads back; other columns are written as they come.
    """
    require_utc(df.sparkSession)
    df = conformed(df, stat)
    time = F.col(TIME).cast("timestamp")
    placed = df.select(
        "*", F.lit(stat).alias("stat"), *[getattr(F, c if c != "day" else "dayofmonth")(time).alias(c) for c in CLOCK]
    )
    writer = placed.hint("rebalance", *PARTITIONS).write.partitionBy(*PARTITIONS).mode(mode)
    if file_format == "csv":
        writer = writer.options(
            header=True, compression="gzip", quote='"', escape='"', timestampFormat=CSV_TIME, nullValue="", emptyValue=""
        )
    writer.format(file_format).save(root)


def as_utc(value: datetime) -> datetime:
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def in_window(start: datetime | None, end: datetime | None, time: str = TIME) -> Column:
    """Rows from the second ``start`` falls in to the second ``end`` falls in, both included."""
    limits = [F.lit(True)]
    if start is not None:
        limits.append(F.col(time) >= F.lit(as_utc(start).replace(microsecond=0)))
    if end is not None:
        limits.append(F.col(time) < F.lit(as_utc(end).replace(microsecond=0) + timedelta(seconds=1)))
    return reduce(lambda a, b: a & b, limits)


def _partition_window(start: datetime | None, end: datetime | None) -> Column:
    """The minutes of a window, on partition columns alone."""
    minute = F.make_timestamp(*[F.col(c) for c in CLOCK], F.lit(0))
    limits = [F.lit(True)]
    if start is not None:
        limits.append(minute >= F.lit(as_utc(start).replace(second=0, microsecond=0)))
    if end is not None:
        limits.append(minute <= F.lit(as_utc(end)))
    return reduce(lambda a, b: a & b, limits)


def _alternatives(names: Sequence[str] | None) -> str:
    """Path pattern for some partition values; any value where a name cannot stand in a pattern."""
    if names and all(re.fullmatch(r"[\w.-]+", name) for name in names):
        return names[0] if len(names) == 1 else "{" + ",".join(names) + "}"
    return "*"


def _clock_pattern(start: datetime | None, end: datetime | None) -> str:
    """Path pattern for the days of a window, or its months when it is long; none when it is open or very long."""
    if start is None or end is None or start > end:
        return ""
    first, last = as_utc(start).date(), as_utc(end).date()
    days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    parts = [f"year={d.year}/month={d.month}/day={d.day}" for d in days]
    if len(parts) > MOST_ALTERNATIVES:
        parts = list(dict.fromkeys(f"year={d.year}/month={d.month}" for d in days))
    if len(parts) > MOST_ALTERNATIVES:
        return ""
    return "/" + (parts[0] if len(parts) == 1 else "{" + ",".join(parts) + "}")


def _pattern(root: str, stat: str, hosts=None, databases=None, start=None, end=None) -> str:
    scope = f"{root}/host={_alternatives(hosts)}/database={_alternatives(databases)}/stat={stat}"
    return scope + _clock_pattern(start, end)


def _in_scope(df: DataFrame, hosts, databases) -> DataFrame:
    if hosts:
        df = df.where(F.col("host").isin(*hosts))
    return df.where(F.col("database").isin(*databases)) if databases else df


def _open(reader, path: str, what: str) -> DataFrame:
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise DataQualityError(f"no snapshots of {what}") from error
        raise


def _every_column(spark: SparkSession, root: str, pattern: str, stat: str, wanted: T.StructType, places: Sequence[str]) -> T.StructType:
    """The wanted columns and whatever others the files hold."""
    found = _open(spark.read.format("parquet").options(basePath=root, mergeSchema="true"), pattern, stat).schema
    held = {*wanted.names, *places}
    return T.StructType([*wanted, *[field for field in found if field.name not in held]])


def _not_empty(rows: DataFrame, stat: str) -> DataFrame:
    """The rows, or an error when there is none: an empty window is one whatever its length and the layout."""
    if rows.isEmpty():
        raise DataQualityError(f"no snapshots of {stat} in the window")
    return rows


def read_snapshots(
    spark: SparkSession,
    root: str,
    stat: str,
    start: datetime | None = None,
    end: datetime | None = None,
    *,
    hosts: Sequence[str] | None = None,
    databases: Sequence[str] | None = None,
    file_format: str = "parquet",
    schema: T.StructType | None = None,
    every_column: bool = False,
) -> DataFrame:
    """Rows of one statistic in a window, over all hosts and databases unless some are named; an error if there is none.

    Columns are matched by name against the statistic's schema; a column a file lacks is null. With ``every_column`` the
    other columns of Parquet files come along (their footers are read for that), as re-landing them wants. Only the folders of
    the statistic, of the named hosts and databases and of the window's days (months, when it is long) are listed, and
    the window prunes partitions by minute before any file is opened.
    """
    require_utc(spark)
    wanted = schema or STATS[stat].schema
    pattern = _pattern(root, stat, hosts, databases, start, end)
    if file_format == "csv":
        files = _open(
            spark.read.format("binaryFile").option("basePath", root).schema(T.StructType(_FILE_FIELDS + _PARTITION_FIELDS)),
            pattern,
            stat,
        )
        rows = _read_csv(spark, root, _in_scope(files.where(_partition_window(start, end)), hosts, databases), wanted)
    else:
        if every_column:
            wanted = _every_column(spark, root, pattern, stat, wanted, PARTITIONS)
        full = T.StructType(list(wanted) + _PARTITION_FIELDS)
        rows = _open(spark.read.format(file_format).option("basePath", root).schema(full), pattern, stat)
        rows = _in_scope(rows.where(_partition_window(start, end)), hosts, databases)
    return _not_empty(rows.select(*SCOPE, *wanted.names).where(in_window(start, end)), stat)


def _headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files by their first line, from one pass in which every task keeps a line per file; files without a line are left out."""
    lines = spark.read.text(list(paths)).where(F.col("_metadata.file_block_start") == 0)
    numbered = lines.select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("n"))
    first = numbered.groupBy("file").agg(F.min_by("value", "n").alias("header"))
    grouped = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header")
    return {r["header"].removeprefix("\ufeff").rstrip("\r"): [unquote(f) for f in r["files"]] for r in grouped.collect()}


def _read_csv(spark: SparkSession, root: str, files: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of gzipped CSV files, each read by its own header.

    Files of one statistic differ in their columns from server version to version. They are grouped by their first line,
    and Spark's own reader takes each group by the places that its header gives the columns; quotes and line breaks in a
    text are kept. There are as many groups as headers, and the list of a window's files is all the driver holds.
    """
    groups: dict[str, list[str]] = {}
    paths = sorted(r["path"] for r in files.select("path").toLocalIterator())
    for start in range(0, len(paths), FILES_PER_READ):
        for header, named in _headers(spark, paths[start : start + FILES_PER_READ]).items():
            groups.setdefault(header, []).extend(named)
    frames = []
    for header, named in groups.items():
        columns = next(csv.reader([header]))
        placed = T.StructType([T.StructField(f"_at_{i}", T.StringType()) for i in range(len(columns))] + _PARTITION_FIELDS)
        reader = spark.read.schema(placed).options(basePath=root, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")
        at = {name: i for i, name in reversed(list(enumerate(columns)))}
        for start in range(0, len(named), FILES_PER_READ):
            rows = reader.csv(named[start : start + FILES_PER_READ])
            # An empty field is null, quoted or not; of columns with the same name the first counts.
            texts = rows.select(*SCOPE, *[F.nullif(F.col(f"_at_{at[c]}"), F.lit("")).alias(c) if c in at else F.lit(None).cast("string").alias(c) for c in schema.names])
            frames.append(texts.select(*SCOPE, *[_typed(field).alias(field.name) for field in schema]))
    if not frames:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in SCOPE] + list(schema)))
    return reduce(DataFrame.unionByName, frames)


def _parse_csv(files: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of a stream of gzipped CSV files, each read by its own header.

    The headers of files that are still to come cannot be grouped beforehand (see ``_read_csv``), so a file is the unit of
    work: tasks receive file contents and yield text columns, which Spark then casts. The size of
    a task's input is bounded by ``spark.sql.files.maxPartitionBytes``.
    """
    names = schema.names

    def parse(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for host, database, content in zip(batch["host"], batch["database"], batch["content"]):
                data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                chunks = pd.read_csv(
                    io.BytesIO(data), dtype=str, keep_default_na=False, na_values=[""], chunksize=ROWS_PER_CHUNK
                )
                for chunk in chunks:
                    rows = chunk.reindex(columns=names)
                    rows.insert(0, "database", database)
                    rows.insert(0, "host", host)
                    yield rows.astype(object).where(rows.notna(), None)

    texts = T.StructType([T.StructField(c, T.StringType()) for c in (*SCOPE, *names)])
    parsed = files.select(*SCOPE, "content").mapInPandas(parse, texts)
    return parsed.select(*SCOPE, *[_typed(field).alias(field.name) for field in schema])


def _typed(field: T.StructField) -> Column:
    """Text to the column's type; whole numbers may be written with a fraction of zero."""
    if isinstance(field.dataType, T.LongType):
        return F.col(field.name).cast("decimal(38,6)").cast("bigint")
    return F.col(field.name).cast(field.dataType)


def with_epoch(df: DataFrame, time: str = TIME) -> DataFrame:
    """Add ``snapshot_timestamp``: seconds since 1970 with milliseconds."""
    return df.withColumn("snapshot_timestamp", epoch_seconds(time))


def union_snapshots(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of several frames, columns matched by name and filled with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fold_duplicates(df: DataFrame, stat: str) -> DataFrame:
    """One row per entity and snapshot: counters by the statistic's rule, gauges by their largest value, any value of
    the other columns. Reports over folded rows need not fold again."""
    spec = STATS[stat]
    if spec.duplicates is None:
        return df
    rows = with_exec_time(df) if stat == "pg_stat_statements" else df
    fold = F.sum if spec.duplicates == "sum" else F.max
    kinds = dict(rows.dtypes)
    # Texts that describe an entity are the same in all its rows; as keys they leave the buffers of a fixed width.
    constant = [c for c, kind in rows.dtypes if kind == "string" and c not in VARYING]
    keys = list(dict.fromkeys(c for c in (*SCOPE, *spec.keys, TIME, *constant) if c in rows.columns))

    def folded(c: str) -> Column:
        if c in spec.counters:
            return fold(c).cast(kinds[c])
        return F.array_max(F.collect_set(c)) if c in VARYING else F.max(c)

    return rows.groupBy(*keys).agg(*[folded(c).alias(c) for c in rows.columns if c not in keys])


def compact_snapshots(df: DataFrame, root: str, stat: str, mode: str = "overwrite", fold: bool = True) -> None:
    """Land rows by day, sorted by scope and entity, so that a reader skips row groups of other hosts.

    Give whole days: the days that ``df`` holds are replaced, others stay, so landing a day again changes nothing
    (``mode="append"`` adds instead). Duplicate rows are folded on the way, once, instead of in every report, unless
    ``fold`` is off; pass ``folded=True`` to reports over folded rows.
    """
    require_utc(df.sparkSession)
    df = conformed(df, stat)
    df = fold_duplicates(df, stat) if fold else df
    order = [c for c in (*SCOPE, *STATS[stat].keys, TIME) if c in df.columns]
    dated = df.select("*", F.lit(stat).alias("stat"), F.to_date(F.col(TIME).cast("timestamp")).alias("snapshot_date"))
    (
        dated.hint("rebalance", "snapshot_date", "host")
        .sortWithinPartitions("snapshot_date", *order)
        .write.partitionBy("stat", "snapshot_date")
        .option("partitionOverwriteMode", "dynamic")
        .mode(mode)
        .parquet(root)
    )


def read_compacted(
    spark: SparkSession,
    root: str,
    stat: str,
    start: datetime | None = None,
    end: datetime | None = None,
    *,
    hosts: Sequence[str] | None = None,
    databases: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    every_column: bool = False,
) -> DataFrame:
    """Rows of one statistic from the compacted layout; as ``read_snapshots`` otherwise."""
    require_utc(spark)
    wanted = schema or STATS[stat].schema
    if every_column:
        wanted = _every_column(spark, root, f"{root}/stat={stat}", stat, wanted, (*SCOPE, "stat", "snapshot_date"))
    scope = [T.StructField(c, T.StringType()) for c in SCOPE]
    places = [T.StructField("stat", T.StringType()), T.StructField("snapshot_date", T.DateType())]
    reader = spark.read.format("parquet").option("basePath", root).schema(T.StructType(scope + list(wanted) + places))
    rows = _open(reader, f"{root}/stat={stat}", stat)
    if start is not None:
        rows = rows.where(F.col("snapshot_date") >= F.lit(as_utc(start).date()))
    if end is not None:
        rows = rows.where(F.col("snapshot_date") <= F.lit(as_utc(end).date()))
    return _not_empty(_in_scope(rows.where(in_window(start, end)), hosts, databases).select(*SCOPE, *wanted.names), stat)


def load_stats(
    spark: SparkSession,
    root: str,
    start: datetime | None = None,
    end: datetime | None = None,
    stats: Sequence[str] | None = None,
    *,
    compacted: bool = False,
    **options,
) -> dict[str, DataFrame]:
    """Frames of the named statistics, each of which must have rows in the window; when unset, of those of the nine that
    have, and an error if none has."""
    read = read_compacted if compacted else read_snapshots

    def loaded(stat: str) -> DataFrame | None:
        try:
            return read(spark, root, stat, start, end, **options)
        except DataQualityError:
            if stats:
                raise
            return None

    # Each looks whether its window holds anything; the looks run side by side.
    with ThreadPoolExecutor(len(STATS)) as readers:
        found = dict(zip(stats or STATS, readers.map(loaded, stats or STATS)))
    frames = {stat: df for stat, df in found.items() if df is not None}
    if not frames:
        raise DataQualityError(f"no snapshots under {root} in the window")
    return frames


def register_views(frames: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Make frames queryable by name in SQL."""
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in frames]
