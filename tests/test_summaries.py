"""Mergeable summaries and lives against the plain increase and against Python, and windows over landed days."""

import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapdelta.operators.asof import as_of_join
from snapdelta.operators.delta import counter_delta, counter_increase
from snapdelta.operators.lifetimes import database_resets, lifetimes, since_reset
from snapdelta.operators.quality import DataQualityError
from snapdelta.operators.summaries import increase_from_summaries, merge_summaries, period_summaries
from snapdelta.plans import statements, tables
from snapdelta.plans.report import build_report
from snapdelta.sources import days, lake
from snapdelta.sources.shared import shared_dir

START = datetime(2024, 1, 1)
KEYS = ["k", "database"]
SCHEMA = "k string, snapshot_time timestamp, relid bigint, x bigint, y double, z decimal(38,0)"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def timelines(spark):
    """Hours with gaps, falls, nulls, a null key, ids that change and come back; a key that is the same in all rows."""
    rng, rows = random.Random(1), []
    for k in ["a", "b", "c", None, "d"]:
        relid = 1
        for h in range(240):
            relid = rng.choice([relid] * 30 + [1, 2, None])
            if rng.random() < 0.8:
                rows.append((k, START + timedelta(hours=h), relid, rng.choice([None, h, h * 2, 5, 7]), float(h % 50) if h % 7 else None, rng.choice([None, Decimal(h), Decimal(3)])))
    rows += [("all null", START + timedelta(days=d), 1, None, None, None) for d in range(3)] + [("single", START, 1, 4, 4.0, Decimal(4))]
    return spark.createDataFrame(rows, SCHEMA).withColumn("database", F.lit("app")).cache()


@pytest.mark.parametrize("policy", ["raw", "zero", "restart"])
@pytest.mark.parametrize("period", ["hour", "day", "week"])
def test_increase_of_summaries_is_the_increase_of_rows(timelines, policy, period):
    want = rows_of(counter_increase(timelines, ["x", "y", "z"], KEYS, on_reset=policy, gaps="lag"))
    summed = period_summaries(timelines, ["x", "y", "z"], KEYS, period=period)
    assert rows_of(increase_from_summaries(summed, ["x", "y", "z"], KEYS, on_reset=policy)) == want
    weeks = merge_summaries(summed, ["x", "y", "z"], KEYS, period="week")
    months = merge_summaries(weeks, ["x", "y", "z"], KEYS, period="year")
    assert rows_of(increase_from_summaries(months, ["x", "y", "z"], KEYS, on_reset=policy)) == want


def test_summaries_merge_in_any_grouping(timelines):
    """Days to months in one step, or by weeks of days: the same rows, field by field."""
    day = period_summaries(timelines.where("k is not null"), ["x"], KEYS, lives=["relid"])
    straight = merge_summaries(day, ["x"], KEYS, period="month")
    stepwise = merge_summaries(merge_summaries(day.where("day(period) <= 31"), ["x"], KEYS, period="week"), ["x"], KEYS, period="month")
    drop = [c for c in straight.columns if c != "period"]
    assert rows_of(straight.select(drop)) == rows_of(stepwise.select(drop))


def expected_lives(rows, policy):
    """Sum of deltas by hand: within lives only; under restart a new life adds what it begins with."""
    out = {}
    for k, _, relid, x in sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1])):
        total, last = out.get(k, (0, None))
        if last is not None and k is not None:
            if last[0] != relid:
                total += (x or 0) if policy == "restart" else 0
            elif x is not None and last[1] is not None:
                d = x - last[1]
                total += d if d >= 0 or policy == "raw" else (x if policy == "restart" else 0)
        out[k] = (total, (relid, x))
    return sorted(((k, v[0]) for k, v in out.items()), key=repr)


@pytest.mark.parametrize("policy", ["raw", "zero", "restart"])
def test_no_delta_crosses_a_life(timelines, policy):
    rows = [tuple(r) for r in timelines.select("k", "snapshot_time", "relid", "x").collect()]
    want = expected_lives(rows, policy)
    grown = counter_increase(timelines, ["x"], KEYS, on_reset=policy, lives=["relid"])
    assert rows_of(grown.select("k", "increase_x")) == want
    deltas = counter_delta(timelines, ["x"], KEYS, on_reset=policy, lives=["relid"])
    assert rows_of(deltas.groupBy("k").agg(F.sum("delta_x"))) == want
    by_day = merge_summaries(period_summaries(timelines, ["x"], KEYS, lives=["relid"]), ["x"], KEYS, period="month")
    assert rows_of(increase_from_summaries(by_day, ["x"], KEYS, on_reset=policy).select("k", "increase_x")) == want


def test_lifetimes_are_islands(spark):
    at = lambda h: START + timedelta(hours=h)
    rows = [("t", at(h), relid) for h, relid in enumerate([1, 1, 2, 2, None, None, 1])] + [(None, at(0), 5), ("u", at(3), 9)]
    got = rows_of(lifetimes(spark.createDataFrame(rows, "k string, snapshot_time timestamp, relid bigint"), ["relid"], ["k"]).drop("_entity"))
    assert got == [("t", 1, 1, at(0), at(1), 2), ("t", 2, 2, at(2), at(3), 2), ("t", 3, None, at(4), at(5), 2), ("t", 4, 1, at(6), at(6), 1), ("u", 1, 9, at(3), at(3), 1)]
    assert lifetimes(spark.createDataFrame([], "k string, snapshot_time timestamp, relid bigint"), ["relid"], ["k"]).collect() == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3000)), max_size=30), st.lists(st.tuples(st.sampled_from(["a", None]), st.integers(0, 3000), st.integers(0, 2)), max_size=12))
def test_as_of_join_equals_a_search(spark, left, right):
    at = lambda h: START + timedelta(hours=h)
    df = spark.createDataFrame([(g, at(h), i) for i, (g, h) in enumerate(left)], "g string, snapshot_time timestamp, i int")
    marks = spark.createDataFrame([(g, at(h), v) for g, h, v in right], "g string, seen timestamp, v int")
    got = {r["i"]: r["v"] for r in as_of_join(df, marks, ["g"], ["v"], right_time="seen").collect()}
    for i, (g, h) in enumerate(left):
        best = max(((t, v) for og, t, v in right if og == g and t <= h), default=(0, None))
        assert got[i] == best[1]


def test_statistics_join_the_life_of_their_database(spark):
    """A reset between two captures ends the life of every statement of that database, whatever its own snapshot times are."""
    at = lambda h, m=0: START + timedelta(hours=h, minutes=m)
    database = [("h", "app", at(h), "app", 7, at(5, 30) if h > 5 else None) for h in range(10)] + [("h", "app", at(9), "other", 8, at(2))]
    resets = database_resets(spark.createDataFrame(database, "host string, database string, snapshot_time timestamp, datname string, datid bigint, stats_reset timestamp"))
    assert rows_of(resets) == [("h", "app", at(5, 30))]
    calls = [10, 20, 30, 40, 50, 60, 3, 8, 100, 101]
    rows = spark.createDataFrame([("h", "app", at(h, 1), "q", c) for h, c in enumerate(calls)] + [("i", "app", at(0), "q", 4), ("i", "app", at(1), "q", 5)], "host string, database string, snapshot_time timestamp, q string, calls bigint")
    keys = ["host", "database", "q"]
    lived = since_reset(rows, resets)
    for policy, want in (("raw", 50 + 98), ("restart", 50 + 98 + 3)):
        got = counter_increase(lived, ["calls"], keys, on_reset=policy, lives=["life_since"]).collect()
        assert {r["host"]: r["increase_calls"] for r in got} == {"h": want, "i": 1}


@pytest.fixture(scope="module")
def landed(spark):
    """Six days of statements and tables, six rows a day, with nulls, duplicates and falls; raw and as day summaries."""
    rng, rows, sizes = random.Random(2), [], []
    for host in ("h1", "h2"):
        for q in ("a", None, "c"):
            calls = 0
            for h in range(0, 144, 4):
                calls = rng.choice([calls + 5, calls + 1, 2])
                row = (host, "app", START + timedelta(hours=h, seconds=7), "u", 1 if q else None, q, calls, rng.choice([None, calls * 3]), calls * 2, float(calls * 7))
                rows += [row] * rng.choice([1, 1, 2])
                sizes.append((host, "app", row[2], "s", f"t{q}", calls, calls + 1, rng.choice([None, 3]), calls, calls, calls * 2))
    statement = "host string, database string, snapshot_time timestamp, username string, queryid bigint, query string, calls bigint, shared_blks_read bigint, shared_blks_hit bigint, total_exec_time double"
    table = "host string, database string, snapshot_time timestamp, schemaname string, relname string, heap_blks_read bigint, heap_blks_hit bigint, n_dead_tup bigint, n_live_tup bigint, vacuum_count bigint, autovacuum_count bigint"
    blocks = ("idx_blks_read", "idx_blks_hit", "toast_blks_read", "toast_blks_hit", "tidx_blks_read", "tidx_blks_hit")
    frames = {"pg_stat_statements": spark.createDataFrame(rows, statement), "table_stats": spark.createDataFrame(sizes, table).withColumns({c: F.lit(None).cast("bigint") for c in blocks})}
    root = shared_dir(spark, "days")
    for stat, df in frames.items():
        lake.compact_snapshots(df, f"{root}/raw", stat, fold=False)
        for _ in range(2):  # landing a day again changes nothing
            days.land_days(df, f"{root}/days", stat)
    return frames, root


WINDOWS = {
    "whole": (START, START + timedelta(days=6)),
    "edges": (START + timedelta(hours=9), START + timedelta(days=4, hours=13)),
    "inside a day": (START + timedelta(days=2, hours=3), START + timedelta(days=2, hours=15)),
    "to the last second": (START + timedelta(days=1), START + timedelta(days=3, hours=23, minutes=59, seconds=59)),
    "over midnight": (START + timedelta(hours=20), START + timedelta(days=1, hours=6)),
}


@pytest.mark.parametrize("window", WINDOWS)
def test_a_window_of_days_gives_the_lists_of_its_rows(spark, landed, window):
    frames, root = landed
    start, end = (t.replace(tzinfo=timezone.utc) for t in WINDOWS[window])
    summed = {s: days.window_summaries(spark, f"{root}/days", s, start, end, lambda a, b, s=s: lake.read_compacted(spark, f"{root}/raw", s, a, b)) for s in frames}
    raw = {s: df.where(lake.in_window(start, end)) for s, df in frames.items()}
    for policy in ("raw", "restart"):
        assert rows_of(statements.statement_base(summed["pg_stat_statements"], on_reset=policy).drop("wal_records", "wal_fpi", "wal_bytes")) == rows_of(statements.statement_base(raw["pg_stat_statements"], on_reset=policy))
    assert rows_of(tables.table_activity(summed["table_stats"])) == rows_of(tables.table_activity(raw["table_stats"]))
    got, want = build_report(raw, summaries=summed), build_report(raw)
    for name in ("sql_r_io_stats", "vacuum_stats", "table_heap_reads", "table_stats_findings"):
        columns = want[name].columns
        assert rows_of(got[name].select(columns)) == rows_of(want[name])


def test_a_window_reads_days_and_its_edges_only(spark, landed):
    _, root = landed
    start, end = (t.replace(tzinfo=timezone.utc) for t in WINDOWS["edges"])
    asked = []

    def raw(a, b):
        asked.append((a, b))
        return lake.read_compacted(spark, f"{root}/raw", "pg_stat_statements", a, b)

    days.window_summaries(spark, f"{root}/days", "pg_stat_statements", start, end, raw)
    second, utc = timedelta(seconds=1), lambda d, **k: (START + timedelta(days=d, **k)).replace(tzinfo=timezone.utc)
    assert asked == [(utc(0, hours=9), utc(1) - second), (utc(4), utc(4, hours=13))]
    with pytest.raises(DataQualityError):
        days.window_summaries(spark, f"{root}/none", "pg_stat_statements", start - timedelta(days=90), start - timedelta(days=80), lambda a, b: lake.read_compacted(spark, f"{root}/raw", "pg_stat_statements", a, b))


def test_snapshot_rows_move_once_and_days_after_that(spark, timelines, tmp_path):
    rows = str(tmp_path / "rows")
    timelines.write.parquet(rows)
    frame = spark.read.parquet(rows).withColumn("database", F.lit("app"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    summed = plan(period_summaries(frame, ["x", "y"], KEYS, duplicates="sum"))
    assert summed.count("Exchange") == 1 and summed.count("FileScan") == 1
    stored = str(tmp_path / "days")
    period_summaries(frame, ["x", "y"], KEYS).write.parquet(stored)
    read = plan(increase_from_summaries(spark.read.parquet(stored), ["x"], KEYS))
    assert read.count("FileScan") == 1 and "y:struct" not in read


def test_first_and_last_values_need_no_hash_table(spark, tmp_path):
    """One snapshot per entity and day, so that a summary row is as frequent as a snapshot: hash tables would hold all of them."""
    rows = [(f"k{k}", "app", START + timedelta(days=d), k + d if (k + d) % 3 else None, float(d), Decimal(k)) for k in range(20) for d in range(4)]
    rows += [("k0", "app", START + timedelta(hours=5), 7, None, None), (None, "app", START, 1, 1.0, None), ("k1", "app", None, 9, 9.0, None)]
    counters, frame = ["x", "y", "z"], str(tmp_path / "rows")
    spark.createDataFrame(rows, "k string, database string, snapshot_time timestamp, x bigint, y double, z decimal(38,0)").write.parquet(frame)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    summed = period_summaries(spark.read.parquet(frame), counters, KEYS)
    merged = merge_summaries(summed, counters, KEYS, period="week")
    assert "HashAggregate" not in plan(summed) and plan(summed).count("Sort [") == 1
    assert "HashAggregate" not in plan(merged) and plan(merged).count("Sort [") == 2
    got = {(r["k"], r["first_time"]): (r["x"]["first"], r["x"]["last"], r["y"]["first"], r["y"]["last"]) for r in summed.collect()}
    assert len(got) == 20 * 4 + 2
    assert got["k0", START] == (None, 7, 0.0, None) and got["k4", START + timedelta(days=3)] == (7, 7, 3.0, 3.0)
    assert got["k1", None] == (None, None, None, None)
    weeks = {r["k"]: (r["snapshots"], r["x"]["first"], r["x"]["last"], r["x"]["change"]) for r in merged.where("period is not null").collect()}
    assert weeks["k0"] == (5, None, None, (1 - 7) + (2 - 1)) and weeks["k4"] == (4, 4, 7, 1) and weeks[None] == (1, 1, 1, 0)
