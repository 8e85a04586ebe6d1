import gzip
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from snapdelta.operators import quality
from snapdelta.sources import lake
from snapdelta.schema import STATS
from snapdelta.sources.jdbc import EXTRACTS, build_stat, endpoints, read_options
from snapdelta.sources.shared import shared_dir


def put(root, host, database, stat, when, header, rows):
    folder = root / f"host={host}" / f"database={database}" / f"stat={stat}" / f"year={when.year}"
    folder = folder / f"month={when.month}" / f"day={when.day}" / f"hour={when.hour}" / f"minute={when.minute}"
    folder.mkdir(parents=True, exist_ok=True)
    epoch = int(when.replace(tzinfo=timezone.utc).timestamp())
    with gzip.open(folder / f"{epoch}_{uuid.uuid4()}.csv.gz", "wt", newline="") as f:
        f.write("\n".join([header, *rows]) + "\n")


@pytest.fixture(scope="module")
def csv_lake(tmp_path_factory):
    """Hours 1, 2 and 10; newline and quotes in a text; empty fields; another header later on."""
    root = tmp_path_factory.mktemp("csvlake")
    early = "snapshot_time,capture_version,username,queryid,calls,total_time,query"
    late = "snapshot_time,capture_version,query,username,wal_bytes,queryid,calls,total_exec_time,datname,datname"
    for hour, calls in ((1, 10), (2, 15)):
        when = datetime(2024, 1, 2, hour, 0, 5)
        rows = [
            f'{when}.123456,1.2,app,9007199254740993,{calls},1.5,"select ""a"",\n  b"',
            f"{when}.123456,1.2,app,,{calls}.0,2.5,",
        ]
        put(root, "H", "007", "pg_stat_statements", when, early, rows)
    when = datetime(2024, 1, 2, 10, 0, 5)
    rows = [f'{when}.123456,1.2,"select ""a"",\n  b",app,77,9007199254740993,40,9.5,x,y']
    put(root, "H", "007", "pg_stat_statements", when, late, rows)
    put(root, "G", "other", "pg_stat_statements", when, late, rows)
    return str(root)


def test_csv_lake(spark, csv_lake):
    rows = lake.read_snapshots(spark, csv_lake, "pg_stat_statements", file_format="csv", hosts=["H"]).orderBy(
        "snapshot_time", "query"
    )
    got = rows.select("host", "database", "queryid", "calls", "total_time", "total_exec_time", "wal_bytes", "query").collect()
    text = 'select "a",\n  b'
    assert [tuple(r) for r in got] == [
        ("H", "007", None, 10, 2.5, None, None, None),
        ("H", "007", 9007199254740993, 10, 1.5, None, None, text),
        ("H", "007", None, 15, 2.5, None, None, None),
        ("H", "007", 9007199254740993, 15, 1.5, None, None, text),
        ("H", "007", 9007199254740993, 40, None, 9.5, 77, text),
    ]


def test_csv_window_is_inclusive_by_second(spark, csv_lake):
    def hours(start, end):
        rows = lake.read_snapshots(spark, csv_lake, "pg_stat_statements", start, end, file_format="csv", hosts=["H"])
        return sorted(r[0] for r in rows.select(F.hour("snapshot_time")).distinct().collect())

    first, last = datetime(2024, 1, 2, 1, 0, 5), datetime(2024, 1, 2, 10, 0, 5)
    assert hours(first, last) == [1, 2, 10]
    assert hours(first + timedelta(seconds=1), last) == [2, 10]
    assert hours(first, last - timedelta(seconds=1)) == [1, 2]


def test_statement_report_over_drifting_columns(spark, csv_lake):
    from snapdelta.plans import statements

    rows = lake.read_snapshots(spark, csv_lake, "pg_stat_statements", file_format="csv", hosts=["H"])
    filled = rows.select(
        *[F.col(c) if c != "shared_blks_hit" else (F.col("calls") * 2).cast(t).alias(c) for c, t in rows.dtypes]
    )
    for digest in (False, True):
        base = statements.statement_base(filled, digest_text=digest).collect()
        assert [(r["queryid"], r["calls"], r["wal_bytes"], r["ms_per_call"]) for r in base] == [
            (9007199254740993, 30, 0, round(8.0 / 30, 2))
        ]


def test_parquet_round_trip_and_pruning(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = [
        ("h1", "007", datetime(2024, m, 2, h, 5, 9), "a", v)
        for m in (1, 2, 10)
        for h, v in ((1, "on"), (2, "off"), (10, None))
    ]
    df = spark.createDataFrame(rows, "host string, database string, snapshot_time timestamp, name string, setting string")
    lake.write_snapshots(df, root, "pg_settings")
    lake.write_snapshots(df.withColumn("host", F.lit("h2")), root, "pg_settings")
    assert (tmp_path / "lake/host=h1/database=007/stat=pg_settings/year=2024/month=1/day=2/hour=1/minute=5").is_dir()
    back = lake.read_snapshots(spark, root, "pg_settings", hosts=["h1"]).select(*df.columns)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    window = lake.read_snapshots(
        spark, root, "pg_settings", datetime(2024, 1, 2, 2, 5, 9), datetime(2024, 2, 2, 1, 5, 9), hosts=["h1"]
    )
    assert window.count() == 3
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = window._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "make_timestamp" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "snapshot_time" in scan.split("PushedFilters")[1]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    named = lake.load_stats(spark, root)
    assert list(named) == ["pg_settings"]
    assert lake.register_views(named, "s_") == ["s_pg_settings"]
    assert spark.sql("select count(distinct host) from s_pg_settings").first()[0] == 2


def test_compacted(spark, tmp_path):
    root = str(tmp_path / "compact")
    df = spark.createDataFrame(
        [("h1", "d", datetime(2024, 1, d, 3), "a", str(d)) for d in range(1, 6)],
        "host string, database string, snapshot_time timestamp, name string, setting string",
    )
    lake.compact_snapshots(df, root, "pg_settings")
    window = lake.read_compacted(spark, root, "pg_settings", datetime(2024, 1, 2, 3), datetime(2024, 1, 4, 2), hosts=["h1"])
    assert sorted(r["setting"] for r in window.collect()) == ["2", "3"]


def test_missing_and_empty(spark, tmp_path, csv_lake):
    with pytest.raises(quality.DataQualityError, match="no snapshots"):
        lake.read_snapshots(spark, str(tmp_path), "version")
    with pytest.raises(quality.DataQualityError):
        lake.load_stats(spark, str(tmp_path), stats=["version"])
    later = datetime(2030, 1, 1)
    with pytest.raises(quality.DataQualityError, match="no snapshots"):
        lake.load_stats(spark, str(tmp_path))
    for days in (1, 100, 3_650, None):
        end = later + timedelta(days=days) if days else None
        with pytest.raises(quality.DataQualityError, match="no snapshots"):
            lake.read_snapshots(spark, csv_lake, "pg_stat_statements", later, end, file_format="csv")


def test_empty_windows_are_alike_in_every_layout(spark, tmp_path):
    df = spark.createDataFrame(
        [("h1", "d", datetime(2024, 1, 1, 3), "a", "1")],
        "host string, database string, snapshot_time timestamp, name string, setting string",
    )
    lake.write_snapshots(df, str(tmp_path / "raw"), "pg_settings")
    lake.compact_snapshots(df, str(tmp_path / "days"), "pg_settings")
    for start in (datetime(2024, 1, 1, 3, 30), datetime(2030, 1, 1)):
        for end in (start + timedelta(days=1), start + timedelta(days=100), start + timedelta(days=3_650), None):
            for read, place in ((lake.read_snapshots, "raw"), (lake.read_compacted, "days")):
                with pytest.raises(quality.DataQualityError, match="no snapshots"):
                    read(spark, str(tmp_path / place), "pg_settings", start, end)
                with pytest.raises(quality.DataQualityError):
                    lake.load_stats(spark, str(tmp_path / place), start, end, compacted=place == "days")


def test_stamp_and_union(spark):
    at = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    a = lake.stamp(spark.sql("select 1 x"), "h", "d", at)
    b = lake.stamp(spark.sql("select 2 y"), "h", "d", at)
    assert a.columns == ["host", "database", "snapshot_time", "x"]
    assert sorted((r["x"] or 0, r["y"] or 0) for r in lake.union_snapshots([a, b]).collect()) == [(0, 2), (1, 0)]


def test_endpoints_and_options():
    found = endpoints(["a.example:5432", "b.example:6000"], ["x", "y"])
    assert [(e.host, e.port, e.database) for e in found][3] == ("b.example", 6000, "y")
    options = read_options(found[0], "select 1", "u", "p")
    assert options["url"] == "jdbc:postgresql://a.example:5432/x"
    assert "read_only" in options["sessionInitStatement"]


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_lake_needs_utc(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            lake.read_snapshots(spark, str(tmp_path), "version")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_extracts_become_statistics(spark):
    frames = {
        "counters": spark.sql("select 5L datid, 'old' datname, 1L blks_read, 2L blks_hit"),
        "databases": spark.sql("select 5L oid, 'd' datname, 9L oldest_transaction_age, false standby"),
    }
    row = build_stat("pg_stat_database", frames, "d").first()
    assert (row["datname"], row["blks_hit"], row["standby"]) == ("d", 2, False)
    frames = {
        "statements": spark.sql("select 1L userid, 5L dbid, 3L queryid, 'q' query, 2L calls, 1.5D total_exec_time"),
        "users": spark.sql("select 1L usesysid, 'u' usename"),
        "databases": spark.sql("select 5L oid, 'd' datname"),
    }
    assert build_stat("pg_stat_statements", frames, "d").first()["username"] == "u"
    version = build_stat("version", {"extract": spark.sql("select 'PostgreSQL 14.2' as version")}, "d").first()
    assert version["major_version"] == 14
    with pytest.raises(ValueError):
        build_stat("other", {}, "d")
    assert set(EXTRACTS) == set(STATS)


def test_listing_is_limited_to_the_window():
    pattern = lake._clock_pattern
    assert pattern(None, datetime(2024, 1, 1)) == ""
    assert pattern(datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 6)) == "/year=2024/month=1/day=1"
    assert pattern(datetime(2024, 1, 31), datetime(2024, 2, 1)) == "/{year=2024/month=1/day=31,year=2024/month=2/day=1}"
    assert pattern(datetime(2023, 12, 1), datetime(2024, 3, 1)).count("month=") == 4
    assert pattern(datetime(2000, 1, 1), datetime(2024, 1, 1)) == ""


def test_csv_is_read_without_python(spark, csv_lake):
    """Spark's own reader by header, with all of its groups in one plan."""
    plan = lake.read_snapshots(spark, csv_lake, "pg_stat_statements", file_format="csv")._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "MapInArrow" not in plan and plan.count("FileScan csv") == 2


def test_csv_odd_files(spark, tmp_path):
    """A file without a line, one with a header alone, quoted empty fields, commas, line breaks of both kinds, a mark at the start."""
    when = datetime(2024, 1, 2, 1, 0, 5)
    header = "snapshot_time,name,setting,context"
    texts = ['a,"x, ""y"""', 'b,""', 'c,"two\r\nlines"', "d, padded "]
    put(tmp_path, "h a+b", "d", "pg_settings", when, header, [f"{when}.5,{t},user" for t in texts])
    put(tmp_path, "h a+b", "d", "pg_settings", when + timedelta(minutes=1), "﻿setting,snapshot_time,name", [f"on,{when}.5,e"])
    put(tmp_path, "h a+b", "d", "pg_settings", when + timedelta(minutes=2), header, [])
    put(tmp_path, "h a+b", "d", "pg_settings", when + timedelta(minutes=3), "", [])
    rows = lake.read_snapshots(spark, str(tmp_path), "pg_settings", file_format="csv", hosts=["h a+b"])
    got = sorted(map(tuple, rows.select("host", "name", "setting", "context").collect()), key=repr)
    want = [("a", 'x, "y"', "user"), ("b", None, "user"), ("c", "two\r\nlines", "user"), ("d", " padded ", "user"), ("e", "on", None)]
    assert got == sorted((("h a+b", *w) for w in want), key=repr)


def test_a_failing_endpoint_costs_only_itself(spark, tmp_path, monkeypatch):
    """One server refuses the connection, one breaks off while it is read: the others' snapshots are there, the failures are named."""
    from snapdelta.sources import jdbc

    def answer(session, endpoint, sql, user, password):
        if endpoint.host == "down":
            raise ConnectionError("refused")
        version = F.expr("cast(raise_error('broken off') as string)") if endpoint.host == "breaks" else F.lit("PostgreSQL 14.2")
        return session.range(1).select(version.alias("version"))

    monkeypatch.setattr(jdbc, "read_extract", answer)
    servers = jdbc.endpoints(["a:1", "down:1", "breaks:1", "b:1"], ["x", "y"])
    with pytest.raises(jdbc.CaptureError) as raised:
        jdbc.capture(spark, servers, str(tmp_path), "u", "p", ["version"])
    assert sorted(raised.value.failed) == [f"version of {h}:1/{d}" for h in ("breaks", "down") for d in "xy"]
    rows = lake.read_snapshots(spark, str(tmp_path), "version").collect()
    assert sorted((r["host"], r["database"]) for r in rows) == [(h, d) for h in "ab" for d in "xy"]
    with pytest.raises(jdbc.CaptureError):
        jdbc.capture(spark, servers[2:3], str(tmp_path / "none"), "u", "p", ["version"])
