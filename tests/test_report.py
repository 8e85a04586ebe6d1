from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapdelta.operators import quality
from snapdelta.plans import databases, indexes, report, statements, tables
from snapdelta.registry.fixtures import view
from snapdelta.sources import lake

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    names = {
        "pg_stat_statements": "fx_statements",
        "table_stats": "fx_tables",
        "index_stats": "fx_indexes",
        "pg_stat_database": "fx_database",
        "pg_settings": "fx_settings",
        "pg_stat_activity": "fx_activity",
        "pg_stat_bgwriter": "fx_bgwriter",
        "version": "fx_version",
    }
    made = {stat: view(spark, SF_DIR, name) for stat, name in names.items()}
    made["pg_stat_database"] = made["pg_stat_database"].withColumn("stats_reset", F.lit(datetime(2020, 1, 1)))
    return made


@pytest.fixture(scope="module")
def written(frames, tmp_path_factory):
    return report.write_report(frames, str(tmp_path_factory.mktemp("report")), limit=5)


def test_all_results_are_written(written):
    assert list(written) == report.RESULTS
    assert len(written) == 34


def test_written_equals_lazy(spark, frames, written):
    lazy = report.build_report(frames, limit=5, digest_text=True)
    for name in ("sql_r_io_stats", "table_heap_reads", "vacuum_stats", "index_usage", "bgwriter_stats", "remainder_io"):
        got = spark.read.parquet(written[name])
        assert sorted(got.columns) == sorted(lazy[name].columns)
        left, right = got.collect(), lazy[name].select(*got.columns).collect()
        assert left and sorted(left, key=repr) == sorted(right, key=repr)


def test_status(spark, frames, written):
    status = report.report_status(frames).collect()
    assert status and all(r["enough_snapshots"] and r["not_reset"] for r in status)


def test_strict_report_refuses_resets(frames, tmp_path):
    rows = frames["pg_stat_database"].withColumn("stats_reset", F.date_trunc("year", "snapshot_time"))
    rows = rows.withColumn("database", F.col("datname"))
    with pytest.raises(quality.DataQualityError, match="report not possible"):
        report.write_report({"pg_stat_database": rows}, str(tmp_path), strict=True)


def test_top_lists_are_prefixes_of_the_base(frames):
    base = statements.statement_base(frames["pg_stat_statements"])
    rows = base.where("host = 'h1' and shared_read_bytes > 0").collect()
    ranked = sorted(rows, key=lambda r: (-r["shared_read_bytes"], r["username"], r["queryid"], r["query"]))
    top = statements.top_reads(base, 7).where("host = 'h1'").orderBy("rank").collect()
    assert [(r["username"], r["queryid"], r["query"]) for r in top] == [
        (r["username"], r["queryid"], r["query"]) for r in ranked[:7]
    ]
    assert [r["rank"] for r in top] == list(range(1, 8))


def test_io_share_sums_to_hundred(frames):
    io = databases.database_increase(frames["pg_stat_database"].where("datid <> 0"))
    for row in io.groupBy("host").agg(F.sum("io_percent").alias("p"), F.count("*").alias("n")).collect():
        assert abs(row["p"] - 100) <= 0.01 * row["n"]


def test_wal_list_is_empty_without_wal(frames):
    rows = frames["pg_stat_statements"].drop("wal_records", "wal_fpi", "wal_bytes")
    assert statements.top_wal(statements.statement_base(rows)).count() == 0
    older = rows.withColumnRenamed("total_exec_time", "total_time")
    assert statements.statement_base(older).count() == statements.statement_base(rows).count() > 0


def test_findings_name_the_scope(spark):
    rows = [("h", "d", "s.a", 50.0), ("h", "d", "s.b", 60.0), ("h2", "d", "s.a", 50.0)]
    base = spark.createDataFrame(rows, "host string, database string, table_name string, heap_hit_ratio double")
    for family in tables.FAMILIES:
        if family != "heap":
            base = base.withColumn(f"{family}_hit_ratio", F.lit(100.0))
    assert [r["host"] for r in tables.table_findings(base).collect()] == ["h"]
    assert {r["host"] for r in tables.table_findings(base, more_than=0).collect()} == {"h", "h2"}


def test_unused_rules(spark):
    schema = (
        "host string, database string, schemaname string, relname string, indexrelname string, indkey string, "
        "conname string, indisunique boolean, idx_scan bigint"
    )
    rows = [
        ("h", "d", "public", "t", "sometimes", "1 3", None, False, 0),
        ("h", "d", "public", "t", "sometimes", "1 3", None, False, 4),
        ("h", "d", "public", "t", "never", "2", None, False, 0),
        ("h", "d", "public", "t", "expression", "0", None, False, 0),
        ("h", "d", "public", "t", "constraint", "1", "c", False, 0),
        ("h", "d", "public", "t", "unique", "1", None, True, 0),
        ("h", "d", "pg_toast", "t", "system", "1", None, False, 0),
    ]
    df = spark.createDataFrame(rows, schema)
    names = lambda rule: {r["index_name"] for r in indexes.unused_indexes(df, unused=rule).collect()}
    assert names("any") == {"public.t.sometimes", "public.t.never"}
    assert names("all") == {"public.t.never"}
    with pytest.raises(ValueError):
        indexes.unused_indexes(df, unused="some")


def test_guards(spark):
    t = datetime(2024, 1, 1)
    one = spark.createDataFrame([("h", "d", t)], "host string, database string, snapshot_time timestamp")
    assert [r["ok"] for r in quality.snapshot_count(one).collect()] == [False]
    rows = [("h", "d", "d", 5, t), ("h", "d", "d", 5, None), ("h", "d", "d", 5, datetime(2024, 1, 2)), ("h", "d", "x", 6, t)]
    schema = "host string, database string, datname string, datid bigint, stats_reset timestamp"
    status = quality.database_stats_reset(spark.createDataFrame(rows, schema)).first()
    assert (status["resets"], status["ok"]) == (2, False)
    versions = spark.createDataFrame([("PostgreSQL 12.1 on a",), ("PostgreSQL 13.1 on a",)], "version string")
    with pytest.raises(quality.DataQualityError):
        quality.require_ok(quality.one_engine(versions), "mixed servers")


def test_report_from_a_csv_lake(spark, frames, tmp_path):
    """A lake of gzipped CSV files gives the results its rows give, for every statistic that is in it."""
    names = ("pg_stat_bgwriter", "pg_settings", "version")
    small = {name: frames[name].where("year(snapshot_time) <= 1995 or year(snapshot_time) >= 2024") for name in names}
    for name, df in small.items():
        lake.write_snapshots(df, str(tmp_path), name, file_format="csv")
    loaded = lake.load_stats(spark, str(tmp_path), file_format="csv")
    assert set(loaded) == set(names)
    got, expected = report.build_report(loaded), report.build_report(small)
    assert set(got) == set(expected)
    for name, df in expected.items():
        columns = [c for c in df.columns if c in got[name].columns]
        left, right = got[name].select(*columns).collect(), df.select(*columns).collect()
        assert sorted(map(repr, left)) == sorted(map(repr, right))
        assert right or name.endswith("findings")


def test_scopes_do_not_mix(spark):
    """The same statement on two hosts and in two databases stays four entities."""
    rows = [
        (host, database, datetime(2024, 1, 1, hour), "u", 1, "q", base + hour * step)
        for host, database, base, step in (("a", "x", 0, 1), ("a", "y", 100, 2), ("b", "x", 200, 3), ("b", "y", 300, 4))
        for hour in range(3)
    ]
    schema = "host string, database string, snapshot_time timestamp, username string, queryid bigint, query string, n bigint"
    df = spark.createDataFrame(rows, schema)
    filled = df.select("*", *[F.col("n").alias(c) for c in statements.NEEDED]).drop("n")
    base = {(r["host"], r["database"]): r["calls"] for r in statements.statement_base(filled).collect()}
    assert base == {("a", "x"): 2, ("a", "y"): 4, ("b", "x"): 6, ("b", "y"): 8}
    assert {r["rank"] for r in statements.top_reads(statements.statement_base(filled), 1).collect()} == {1}
    assert statements.top_reads(statements.statement_base(filled), 1).count() == 4


@pytest.mark.parametrize("scope", [(), ("host",), ("host", "database")])
def test_every_scope_gives_every_result(spark, frames, tmp_path, scope):
    paths = report.write_report(frames, str(tmp_path), scope=scope, database="NATION_7", limit=3)
    assert list(paths) == report.RESULTS
    shares = spark.read.parquet(paths["remainder_io"])
    assert shares.count() > 0 and all(c in shares.columns for c in scope)


def test_scope_without_a_database_needs_its_name(frames):
    with pytest.raises(ValueError, match="current database"):
        report.build_report({"pg_stat_database": frames["pg_stat_database"]}, scope=())


def test_rows_of_an_unnamed_host_are_kept(frames):
    rows = frames["pg_stat_database"].where("host = 'h1'")
    unnamed = rows.withColumn("host", F.lit(None).cast("string"))
    names = lambda df: sorted(r["datname"] for r in databases.database_increase(df).collect())
    assert names(rows) and names(rows) == names(unnamed)
    assert report.report_status({"pg_stat_database": unnamed}).count() == rows.select("database").distinct().count()


def test_list_sizes_are_parameters(spark, frames):
    idle = spark.range(700).selectExpr(
        "'h' host", "'d' database", "timestamp '2024-01-01' snapshot_time", "'public' schemaname", "'t' relname",
        "concat('i', id) indexrelname", "'1' indkey", "cast(null as string) conname", "false indisunique", "0L idx_scan",
        "0L idx_blks_read", "0L idx_blks_hit",
    )
    made = {"index_stats": idle, "pg_stat_statements": frames["pg_stat_statements"]}
    assert report.build_report(made)["index_usage_2"].count() == 500
    wide = report.build_report(made, unused_limit=10_000, findings_limit=2)
    assert wide["index_usage_2"].count() == 700
    assert wide["findings_top_io_sql"].groupBy("host").count().agg(F.max("count")).first()[0] == 2


def test_nulls_and_absent_counters_add_nothing(spark, frames):
    rows = frames["pg_stat_statements"]
    absent = rows.drop("blk_read_time")
    assert {r["read_ms_per_call"] for r in statements.statement_base(absent).collect()} <= {0.0, None}
    hole = F.when((F.col("host") != "h1") | (F.dayofmonth("snapshot_time") != 9), F.col("calls"))
    whole, holed = (statements.statement_base(df) for df in (rows, rows.withColumn("calls", hole)))
    others = lambda df: sorted(map(repr, df.where("host <> 'h1'").collect()))
    assert others(whole) == others(holed) and holed.where("host = 'h1'").count() == whole.where("host = 'h1'").count()


def test_mixed_versions_and_nothing_at_all(frames, tmp_path):
    with pytest.raises(quality.DataQualityError, match="no statistics"):
        report.write_report({}, str(tmp_path))
    mixed = {r["host"]: r["one_engine"] for r in report.report_status(frames, scope=("host",)).collect()}
    assert mixed["h1"] is False and mixed["h4"] is True
    only = {name: frames[name] for name in ("pg_stat_database", "version")}
    alike = only | {"version": only["version"].withColumn("version", F.lit("PostgreSQL 14.1 on x"))}
    one = {r["one_engine"] for r in report.report_status(alike).collect()}
    assert one == {True}


def test_many_lists_in_one_pass_equal_the_single_ones(spark, frames, tmp_path):
    """Six and eight lists from one window each, under both scopes: rows, ranks and texts as the single functions give them."""
    base = statements.statement_base(frames["pg_stat_statements"])
    base.write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    rows = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)
    single = dict(zip(statements.LISTS, (statements.top_reads, statements.top_hits, statements.top_writes, statements.top_temp_reads, statements.top_temp_writes, statements.top_wal)))
    single[statements.FINDINGS] = lambda b, k, s: statements.top_io_findings(b, 2, s)
    for scope in (("host", "database"), ()):
        lists = statements.all_lists(base, 4, 2, scope)
        for name, alone in single.items():
            got = statements.list_of(lists, name, base, scope)
            assert rows(got) == rows(alone(base, 4, scope)) and got.count() > 0
    text = lists._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and text.count("WindowGroupLimit") == 2
    older = base.drop("wal_records", "wal_fpi", "wal_bytes")
    lists = statements.all_lists(older, 4)
    assert statements.list_of(lists, "sql_stats_wg", older).count() == 0
    assert rows(statements.list_of(lists, "sql_r_io_stats", older)) == rows(statements.top_reads(older, 4))
    sizes = tables.table_base(tables.table_activity(frames["table_stats"], vacuum=False))
    many = tables.all_lists(sizes, 3)
    for family, kind in (("heap", "read"), ("toast", "hit"), ("toast_index", "read")):
        assert rows(tables.list_of(many, family, kind)) == rows(tables.top_tables(sizes, family, kind, 3))


def test_a_failed_section_publishes_nothing(frames, tmp_path):
    """One section fails while it is written: the results of a report before it stay, nothing new is there."""
    good = {"pg_settings": frames["pg_settings"], "pg_stat_activity": frames["pg_stat_activity"]}
    paths = report.write_report(good, str(tmp_path / "out"))
    before = sorted(p.name for p in (tmp_path / "out").iterdir())
    files = {name: sorted(f.name for f in (tmp_path / "out" / name).iterdir()) for name in paths}
    broken = good | {"table_stats": frames["table_stats"].withColumn("heap_blks_read", F.expr("cast(raise_error('broken') as bigint)"))}
    with pytest.raises(Exception, match="broken"):
        report.write_report(broken, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == before
    assert {name: sorted(f.name for f in (tmp_path / "out" / name).iterdir()) for name in paths} == files


def test_report_is_appended_to_and_refused(spark, frames, tmp_path):
    one = {"pg_stat_activity": frames["pg_stat_activity"]}
    path = report.write_report(one, str(tmp_path))["wait_events"]
    once = spark.read.parquet(path).count()
    report.write_report(one, str(tmp_path), mode="append")
    assert spark.read.parquet(path).count() == 2 * once
    with pytest.raises(Exception, match="(?i)exists"):
        report.write_report(one, str(tmp_path), mode="error")
    assert spark.read.parquet(path).count() == 2 * once
