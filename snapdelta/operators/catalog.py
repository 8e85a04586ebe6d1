"""Statistics rows built from raw extracts of the server's catalog views.

Each builder joins extracts of one capture; with several captures in one frame, name the columns that tell them
apart (``capture``), which join every pair of extracts. No side is marked for broadcast: small catalogs are
broadcast by their measured size, large ones are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdelta.functions.scalars import major_version

# Fixed value: the version tag the capture puts on every row.
CAPTURE_VERSION = "1.2"
ACTIVE = "active"

# The profile of statement columns starts with this server version.
SPLIT_TIME_VERSION = 13
EARLIER_STATEMENT_COLUMNS = (
    "shared_blks_read shared_blks_hit shared_blks_written shared_blks_dirtied temp_blks_read temp_blks_written "
    "blk_read_time blk_write_time rows min_time max_time stddev_time calls total_time"
).split()
SPLIT_STATEMENT_COLUMNS = (
    "shared_blks_read shared_blks_hit shared_blks_written shared_blks_dirtied temp_blks_read temp_blks_written "
    "blk_read_time blk_write_time rows plans min_exec_time max_exec_time stddev_exec_time min_plan_time "
    "max_plan_time stddev_plan_time calls total_exec_time total_plan_time wal_records wal_fpi wal_bytes"
).split()
TABLE_IO_COLUMNS = (
    "heap_blks_read heap_blks_hit idx_blks_read idx_blks_hit toast_blks_read toast_blks_hit tidx_blks_read tidx_blks_hit"
).split()


def _tagged(df: DataFrame) -> DataFrame:
    return df.withColumn("capture_version", F.lit(CAPTURE_VERSION))


def _with_renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def database_stats(counters: DataFrame, databases: DataFrame, capture: Sequence[str] = ()) -> DataFrame:
    """Database counters with name, role and transaction age from the database catalog, joined on its id."""
    catalog = _with_renamed(databases, {"oid": "datid"})
    shared = [c for c in catalog.columns if c in counters.columns and c not in ("datid", *capture)]
    return _tagged(counters.drop(*shared).join(catalog, [*capture, "datid"], "inner"))


def active_sessions(activity: DataFrame, capture: Sequence[str] = ()) -> DataFrame:
    """Sessions that were running a statement."""
    columns = ["wait_event", "wait_event_type", "datid", "datname", "query"]
    return _tagged(activity.where(F.col("state") == ACTIVE).select(*capture, *[c for c in columns if c in activity.columns]))


def background_writer(extract: DataFrame) -> DataFrame:
    """All columns of the background-writer view."""
    return _tagged(extract)


def server_settings(extract: DataFrame, capture: Sequence[str] = ()) -> DataFrame:
    columns = ["name", "setting", "context", "category", "short_desc"]
    return _tagged(extract.select(*capture, *[c for c in columns if c in extract.columns]))


def vacuum_progress(progress: DataFrame, tables: DataFrame, capture: Sequence[str] = ()) -> DataFrame:
    """Running vacuums with the names of the tables they work on."""
    names = tables.select(*capture, "relid", "schemaname", "relname")
    return _tagged(progress.join(names, [*capture, "relid"], "inner"))


def current_database_id(databases: DataFrame, name: str) -> Column:
    """Id of one database as a scalar subquery."""
    return databases.where(F.col("datname") == name).select(F.max("oid")).scalar()


def statement_stats(
    statements: DataFrame,
    users: DataFrame,
    databases: DataFrame,
    *,
    current_database: str | None = None,
    capture: Sequence[str] = (),
) -> DataFrame:
    """Statements of the connected database that ran at least once, with the name of their user.

    The connected database is ``current_database``, or the ``database`` column of the rows when unset; the latter
    needs the id of every database in ``databases``, joined like the users.
    """
    profile = statement_columns(statements.columns)
    names = _with_renamed(users, {"usesysid": "userid", "usename": "username"})
    joined = statements.where(F.col("calls") > 0).join(
        names.select(*[c for c in capture if c in names.columns], "userid", "username"),
        [*[c for c in capture if c in names.columns], "userid"],
        "inner",
    )
    if current_database is not None:
        joined = joined.where(F.col("dbid") == current_database_id(databases, current_database))
    else:
        ids = _with_renamed(databases, {"oid": "dbid", "datname": "database"})
        keys = [c for c in capture if c in ids.columns and c != "database"]
        joined = joined.join(ids.select(*keys, "dbid", "database"), [*keys, "dbid", "database"], "inner")
    return _tagged(joined.select(*capture, "username", "userid", "queryid", *profile, "query"))


def statement_columns(present: Sequence[str]) -> list[str]:
    """The counters among the columns present, of either profile: extracts of servers before and after the split of
    execution times can share one frame, where each row fills its own profile's columns."""
    return [c for c in dict.fromkeys([*SPLIT_STATEMENT_COLUMNS, *EARLIER_STATEMENT_COLUMNS]) if c in present]


def table_stats(io: DataFrame, activity: DataFrame, capture: Sequence[str] = ()) -> DataFrame:
    """Table activity with its block counters; id, schema and name must all agree."""
    keys = [*capture, "relid", "schemaname", "relname"]
    blocks = io.select(*keys, *[c for c in TABLE_IO_COLUMNS if c in io.columns])
    return _tagged(activity.join(blocks, keys, "inner"))


def index_stats(
    io: DataFrame,
    catalog: DataFrame,
    activity: DataFrame,
    constraints: DataFrame,
    capture: Sequence[str] = (),
) -> DataFrame:
    """Index activity with its block counters, catalog flags and constraint name.

    An index without a constraint is kept with a null name. Several constraints can rest on one index (foreign keys
    that refer to it), which repeats its row once for each.
    """
    blocks = io.select(
        *capture, "relid", "schemaname", "relname", "indexrelid", "indexrelname", "idx_blks_read", "idx_blks_hit"
    )
    flags = _with_renamed(catalog, {"indrelid": "relid"}).withColumn("indkey", F.col("indkey").cast("string"))
    names = _with_renamed(constraints, {"conindid": "indexrelid"}).select(*capture, "indexrelid", "conname")
    joined = (
        activity.join(blocks, [*capture, "relid", "schemaname", "relname", "indexrelid", "indexrelname"], "inner")
        .join(flags, [*capture, "relid", "indexrelid"], "inner")
        .join(names, [*capture, "indexrelid"], "left")
    )
    return _tagged(joined)


def server_version(extract: DataFrame) -> DataFrame:
    """The version text, the second one where the engine has it, and the major version number."""
    return _tagged(extract.withColumn("major_version", major_version("version")))


def statement_profile(version) -> Column:
    """Which set of statement columns a server of this version has."""
    return F.when(major_version(version) >= SPLIT_TIME_VERSION, F.lit("split")).when(
        major_version(version).isNotNull(), F.lit("earlier")
    )
