"""Reading the catalog views of running servers through Spark's JDBC source.

The servers answer plain extracts; joining them is left to ``operators.catalog``. Needs the server's JDBC driver on
the class path, and is not covered by the tests, which have no server.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from snapdelta.operators import catalog
from snapdelta.sources.lake import stamp, union_snapshots, write_snapshots

STATEMENT_TIMEOUT_MS = 10_000
IDLE_TIMEOUT_MS = 20_000
ENDPOINTS_PER_JOB = 64

_CURRENT_DATABASE = "(select oid from pg_database where datname = current_database())"

# The catalog views each statistic needs, as the server spells them.
EXTRACTS: dict[str, dict[str, str]] = {
    "pg_stat_database": {
        "counters": "select * from pg_stat_database",
        "databases": "select oid::bigint oid, datname, age(datfrozenxid)::bigint oldest_transaction_age, "
        "pg_is_in_recovery() standby from pg_database",
    },
    "pg_stat_activity": {"activity": "select * from pg_stat_activity"},
    "pg_stat_bgwriter": {"extract": "select * from pg_stat_bgwriter"},
    "pg_settings": {"extract": "select * from pg_settings"},
    "pg_stat_progress_vacuum": {
        "progress": "select * from pg_stat_progress_vacuum",
        "tables": "select relid, schemaname, relname from pg_stat_all_tables",
    },
    "pg_stat_statements": {
        "statements": f"select * from pg_stat_statements where dbid = {_CURRENT_DATABASE}",
        "users": "select usesysid, usename from pg_user",
        "databases": "select oid, datname from pg_database",
    },
    "table_stats": {
        "io": "select * from pg_statio_all_tables",
        "activity": "select * from pg_stat_all_tables",
    },
    "index_stats": {
        "io": "select * from pg_statio_all_indexes",
        "catalog": "select indexrelid, indrelid, indisunique, indisprimary, indisvalid, indkey::text indkey from pg_index",
        "activity": "select * from pg_stat_all_indexes",
        "constraints": "select conindid, conname from pg_constraint",
    },
    "version": {"extract": "select version() as version"},
}
AURORA_VERSION = "select version() as version, aurora_version() as aurora_version"


class CaptureError(RuntimeError):
    """Endpoints that could not be read; ``failed`` says why each."""

    def __init__(self, failed: dict[str, Exception]):
        self.failed = failed
        super().__init__("not captured: " + "; ".join(f"{what} ({str(why).splitlines()[0]})" for what, why in failed.items()))


@dataclass(frozen=True)
class Endpoint:
    host: str
    port: int
    database: str

    @property
    def url(self) -> str:
        return f"jdbc:postgresql://{self.host}:{self.port}/{self.database}"


def endpoints(hosts: Sequence[str], databases: Sequence[str]) -> list[Endpoint]:
    """Every database on every ``host:port``."""
    split = [host.rsplit(":", 1) for host in hosts]
    return [Endpoint(name, int(port), database) for name, port in split for database in databases]


def read_options(endpoint: Endpoint, query: str, user: str, password: str) -> dict[str, str]:
    """Options of one read: read-only, with the session limits a monitoring query should have."""
    limits = (
        "set default_transaction_read_only = on; "
        f"set statement_timeout = {STATEMENT_TIMEOUT_MS}; set idle_in_transaction_session_timeout = {IDLE_TIMEOUT_MS}"
    )
    return {
        "url": endpoint.url,
        "query": query,
        "user": user,
        "password": password,
        "sessionInitStatement": limits,
        "driver": "org.postgresql.Driver",
    }


def read_extract(spark: SparkSession, endpoint: Endpoint, query: str, user: str, password: str) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(endpoint, query, user, password)).load()


def build_stat(stat: str, extracts: dict[str, DataFrame], database: str) -> DataFrame:
    """Statistics rows from the extracts of one endpoint."""
    e = extracts
    if stat == "pg_stat_database":
        return catalog.database_stats(e["counters"], e["databases"])
    if stat == "pg_stat_activity":
        return catalog.active_sessions(e["activity"])
    if stat == "pg_stat_bgwriter":
        return catalog.background_writer(e["extract"])
    if stat == "pg_settings":
        return catalog.server_settings(e["extract"])
    if stat == "pg_stat_progress_vacuum":
        return catalog.vacuum_progress(e["progress"], e["tables"])
    if stat == "pg_stat_statements":
        return catalog.statement_stats(e["statements"], e["users"], e["databases"], current_database=database)
    if stat == "table_stats":
        return catalog.table_stats(e["io"], e["activity"])
    if stat == "index_stats":
        return catalog.index_stats(e["io"], e["catalog"], e["activity"], e["constraints"])
    if stat == "version":
        return catalog.server_version(e["extract"])
    raise ValueError(f"unknown statistic {stat!r}")


def capture(
    spark: SparkSession,
    servers: Sequence[Endpoint],
    root: str,
    user: str,
    password: str,
    stats: Sequence[str] | None = None,
    at: datetime | None = None,
    file_format: str = "parquet",
    aurora: bool = False,
) -> None:
    """Append one snapshot of the named statistics (all when unset) of every endpoint to the lake.

    The endpoints of a statistic are read as one union, so Spark queries the servers side by side. Where an endpoint fails, those
    read with it are read again one by one: each that answers is written, and what failed is raised at the end, after all
    statistics of all endpoints have had their turn.
    """
    failed: dict[str, Exception] = {}

    def extracted(stat: str, endpoint: Endpoint) -> DataFrame:
        texts = {"extract": AURORA_VERSION} if aurora and stat == "version" else EXTRACTS[stat]
        extracts = {name: read_extract(spark, endpoint, sql, user, password) for name, sql in texts.items()}
        return stamp(build_stat(stat, extracts, endpoint.database), endpoint.host, endpoint.database, at)

    for stat in stats or EXTRACTS:
        for first in range(0, len(servers), ENDPOINTS_PER_JOB):
            some = servers[first : first + ENDPOINTS_PER_JOB]
            try:
                # A job that fails has written nothing.
                write_snapshots(union_snapshots([extracted(stat, e) for e in some]), root, stat, file_format=file_format)
            except Exception as error:  # noqa: BLE001 - whatever a driver raises
                for endpoint in some:
                    try:
                        if len(some) == 1:
                            raise error
                        write_snapshots(extracted(stat, endpoint), root, stat, file_format=file_format)
                    except Exception as cause:  # noqa: BLE001
                        failed[f"{stat} of {endpoint.host}:{endpoint.port}/{endpoint.database}"] = cause
    if failed:
        raise CaptureError(failed)
