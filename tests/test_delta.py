"""Hand-made timelines: every reset policy, with and without time slices."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from snapdelta.operators.delta import counter_delta, counter_increase, elapsed_delta
from snapdelta.operators.timeline import change_points, first_seen, first_state

START = datetime(2024, 1, 1, 22)
SCHEMA = "k string, snapshot_time timestamp, x bigint"

CASES = {
    "plain": ([10, 15, 18], [0, 5, 3], 8, 8, 8),
    "reset": ([10, 15, 12, 20], [0, 5, -3, 8], 10, 13, 25),
    "null_middle": ([1, None, 9], [0, 0, 0], 0, 0, 0),
    "null_middle_long": ([1, 3, None, 9, 10], [0, 2, 0, 0, 1], 3, 3, 3),
    "null_both_ends": ([None, 4, 9, None], [0, 0, 5, 0], 5, 5, 5),
    "null_start": ([None, None, 5, 9], [0, 0, 0, 4], 4, 4, 4),
    "null_end": ([1, 4, None], [0, 3, 0], 3, 3, 3),
    "all_null": ([None, None], [0, 0], 0, 0, 0),
    "single": ([7], [0], 0, 0, 0),
    "late": (["-", 5, 9], [0, 4], 4, 4, 4),
    "gap": ([2, "-", 8], [0, 6], 6, 6, 6),
}


def at(hour):
    return START + timedelta(hours=hour)


@pytest.fixture(scope="module")
def timelines(spark):
    rows = [
        (case, at(i), value)
        for case, (values, *_) in CASES.items()
        for i, value in enumerate(values)
        if value != "-"
    ]
    rows += [(None, at(0), 1), (None, at(1), 5)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("slice_seconds", [None, 3600, 86400])
def test_deltas(timelines, slice_seconds):
    rows = counter_delta(timelines, ["x"], ["k"], slice_seconds=slice_seconds).collect()
    for case, (_, raw, *_) in CASES.items():
        got = [r["delta_x"] for r in sorted((r for r in rows if r["k"] == case), key=lambda r: r["snapshot_time"])]
        assert got == raw, case
    assert [r["delta_x"] for r in rows if r["k"] is None] == [0, 0]


@pytest.mark.parametrize("slice_seconds", [3600, 7200, 86400])
@pytest.mark.parametrize("policy,place", [("raw", 2), ("zero", 3), ("restart", 4)])
def test_increase(timelines, policy, place, slice_seconds):
    rows = counter_increase(timelines, ["x"], ["k"], on_reset=policy, slice_seconds=slice_seconds).collect()
    got = {r["k"]: r["increase_x"] for r in rows}
    assert got == {**{case: expected[place] for case, expected in CASES.items()}, None: 0}


def test_increase_with_other_aggregates(timelines):
    for policy, place in (("raw", 2), ("restart", 4)):
        rows = counter_increase(
            timelines, ["x"], ["k"], on_reset=policy, aggregates=[F.max("x").alias("top")], slice_seconds=3600
        ).collect()
        got = {r["k"]: (r["increase_x"], r["top"]) for r in rows}
        assert got["reset"] == (CASES["reset"][place], 20) and got[None] == (0, 5)


def test_settled_increase_matches(timelines, tmp_path):
    from snapdelta.sources.shared import settle

    rows = counter_increase(timelines, ["x"], ["k"], settle=lambda df: settle(df, str(tmp_path / "ends"))).collect()
    assert {r["k"]: r["increase_x"] for r in rows} == {**{c: e[2] for c, e in CASES.items()}, None: 0}
    whole = timelines.where("k in ('plain', 'reset')")
    settled = counter_increase(whole, ["x"], ["k"], settle=lambda df: settle(df, str(tmp_path / "whole")))
    assert "Window" not in settled._jdf.queryExecution().toString()
    assert {r["k"]: r["increase_x"] for r in settled.collect()} == {"plain": 8, "reset": 10}


def test_unexpected_nulls_fail(timelines):
    with pytest.raises(PySparkException, match="list it as nullable"):
        counter_increase(timelines, ["x"], ["k"], nullable=[]).collect()
    with pytest.raises(PySparkException, match="resolve the gaps"):
        counter_increase(timelines, ["x"], ["k"], gaps="fail").collect()
    edges = timelines.where("k in ('null_start', 'null_end', 'all_null')")
    got = {r["k"]: r["increase_x"] for r in counter_increase(edges, ["x"], ["k"], gaps="fail").collect()}
    assert got == {"null_start": 4, "null_end": 3, "all_null": 0}


def test_duplicates(spark):
    same = spark.createDataFrame([("a", at(0), 3), ("a", at(0), 3), ("a", at(1), 8), ("a", at(1), 8)], SCHEMA)
    assert counter_increase(same, ["x"], ["k"], duplicates="max").first()["increase_x"] == 5
    parts = spark.createDataFrame([("a", at(0), 3), ("a", at(0), 10), ("a", at(1), 5), ("a", at(1), 11)], SCHEMA)
    assert counter_increase(parts, ["x"], ["k"], duplicates="sum").first()["increase_x"] == 3
    deltas = counter_delta(parts, ["x"], ["k"], duplicates="sum").orderBy("snapshot_time").collect()
    assert [r["delta_x"] for r in deltas] == [0, 3]


def test_elapsed(timelines):
    spans = {
        r["k"]: r["s"] for r in elapsed_delta(timelines, ["k"]).groupBy("k").agg(F.sum("delta_seconds").alias("s")).collect()
    }
    for policy in ("raw", "zero"):
        grown = counter_increase(timelines, ["x"], ["k"], on_reset=policy).collect()
        assert spans == {r["k"]: r["elapsed_seconds"] for r in grown}
    assert spans["gap"] == 7200 and spans[None] == 0


def test_empty_window(timelines):
    nothing = timelines.where("false")
    assert counter_delta(nothing, ["x"], ["k"]).count() == 0
    assert counter_increase(nothing, ["x"], ["k"]).count() == 0


def test_unknown_options(timelines):
    with pytest.raises(ValueError):
        counter_delta(timelines, ["x"], ["k"], on_reset="other")
    with pytest.raises(ValueError):
        counter_increase(timelines, ["x"], ["k"], gaps="other")
    with pytest.raises(ValueError):
        counter_increase(timelines, ["x"], ["k"], duplicates="avg")


values = st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(values, min_size=1, max_size=8), st.sampled_from([3600, 10_800, 86_400]))
def test_increase_is_sum_of_deltas(spark, series, width):
    rows = [(f"k{n}", at(i), v) for n, line in enumerate(series) for i, v in enumerate(line)]
    df = spark.createDataFrame(rows, SCHEMA)

    def by_hand(line):
        return sum(b - a for a, b in zip(line, line[1:]) if a is not None and b is not None)

    got = {r["k"]: r["increase_x"] for r in counter_increase(df, ["x"], ["k"], slice_seconds=width).collect()}
    assert got == {f"k{n}": by_hand(line) for n, line in enumerate(series)}


def test_hot_key_and_null_keys_are_spread(spark):
    hot = spark.range(20_000).selectExpr(
        "'hot' k", "timestamp_seconds(1704067200 + id * 60) snapshot_time", "id * 2 x"
    )
    hidden = spark.range(10_000).selectExpr(
        "cast(null as string) k", "timestamp_seconds(1704067200 + id * 60) snapshot_time", "id x"
    )
    df = hot.unionByName(hidden)
    total = counter_delta(df, ["x"], ["k"]).groupBy("k").agg(F.sum("delta_x").alias("d"), F.count("*").alias("n"))
    assert {(r["k"], r["d"], r["n"]) for r in total.collect()} == {("hot", 39_998, 20_000), (None, 0, 10_000)}


def test_change_points(spark):
    roles = [("a", at(i), v) for i, v in enumerate([0, 0, 1, 1, 0])]
    df = spark.createDataFrame(roles, SCHEMA)
    for width in (None, 3600, 86400):
        changes = change_points(df, ["x"], ["k"], slice_seconds=width).orderBy("change_time").collect()
        assert [(r["change_time"], r["x"]) for r in changes] == [(at(0), 0), (at(2), 1), (at(4), 0)]
    assert first_state(df, "x", ["k"]).first()["x"] == 0


def test_first_seen(spark):
    rows = [("s", at(0), 1), ("s", at(1), 2), ("s", at(2), 1), ("same", at(0), 5), ("same", at(1), 5)]
    rows += [("n", at(0), None), ("n", at(1), 3)]
    seen = first_seen(spark.createDataFrame(rows, SCHEMA), "x", ["k"]).collect()
    assert {(r["k"], r["x"], r["change_time"]) for r in seen} == {
        ("s", 1, at(0)),
        ("s", 2, at(1)),
        ("n", None, at(0)),
        ("n", 3, at(1)),
    }
