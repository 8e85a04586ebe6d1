from pyspark.sql import functions as F

from snapdelta.operators import catalog


def test_index_rows_repeat_per_constraint_and_survive_without(spark):
    io = spark.sql("select 1 relid, 's' schemaname, 't' relname, i indexrelid, concat('i', i) indexrelname, "
                   "5 idx_blks_read, 6 idx_blks_hit from values (10), (11) v(i)")
    activity = io.drop("idx_blks_read", "idx_blks_hit").withColumn("idx_scan", F.lit(0))
    flags = spark.sql("select i indexrelid, 1 indrelid, false indisunique, '1 2' indkey from values (10), (11) v(i)")
    names = spark.sql("select * from values (10, 'pk'), (10, 'fk'), (99, 'other') v(conindid, conname)")
    got = catalog.index_stats(io, flags, activity, names)
    assert sorted((r["indexrelid"], r["conname"] or "") for r in got.collect()) == [(10, "fk"), (10, "pk"), (11, "")]
    assert {r["capture_version"] for r in got.collect()} == {"1.2"}


def test_profiles(spark):
    df = spark.createDataFrame([("PostgreSQL 12.9 on x",), ("PostgreSQL 16.1 on x",), ("?",)], "version string")
    assert [r[0] for r in df.select(catalog.statement_profile("version")).collect()] == ["earlier", "split", None]
    assert [r["major_version"] for r in catalog.server_version(df).collect()] == [12, 16, None]


def test_earlier_statement_columns(spark):
    rows = spark.sql("select 1 userid, 7 dbid, 3L queryid, 'q' query, 2L calls, 1.5D total_time, 4L rows, 9L other")
    users = spark.sql("select 1 usesysid, 'u' usename")
    dbs = spark.sql("select 7 oid, 'd' datname")
    got = catalog.statement_stats(rows, users, dbs, current_database="d")
    assert got.columns == ["username", "userid", "queryid", "rows", "calls", "total_time", "query", "capture_version"]
    assert got.count() == 1
    assert catalog.statement_stats(rows, users, dbs, current_database="e").count() == 0
