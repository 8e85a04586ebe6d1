from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapdelta.operators.delta import counter_delta
from snapdelta.streaming.deltas import DeltaStream
from snapdelta.streaming.waits import wait_windows

T0 = datetime(2024, 1, 1)
SCHEMA = "k string, snapshot_time timestamp, x bigint"


def rows(*items):
    return [(k, T0 + timedelta(hours=h), x) for k, h, x in items]


@pytest.fixture
def stream(tmp_path):
    return DeltaStream(str(tmp_path / "out"), ["x"], ["k"])


def deltas(spark, stream):
    return sorted((r["k"] or "", r["snapshot_time"].hour, r["delta_x"]) for r in stream.deltas(spark).collect())


def test_batches_equal_one_pass(spark, stream):
    parts = [
        rows(("a", 0, 10), ("b", 0, 5), (None, 0, 1)),
        rows(("a", 1, 15), ("a", 2, None), (None, 1, 9)),
        rows(("a", 3, 30), ("a", 4, 33), ("b", 4, 2), ("c", 4, 7)),
    ]
    for i, part in enumerate(parts):
        stream.process(spark.createDataFrame(part, SCHEMA), i)
    whole = counter_delta(spark.createDataFrame(sum(parts, []), SCHEMA), ["x"], ["k"])
    expected = sorted((r["k"] or "", r["snapshot_time"].hour, r["delta_x"]) for r in whole.collect())
    assert deltas(spark, stream) == expected
    assert stream.late(spark).count() == 0


def test_repeated_batch_and_late_rows(spark, stream):
    stream.process(spark.createDataFrame(rows(("a", 5, 10)), SCHEMA), 0)
    second = spark.createDataFrame(rows(("a", 3, 8), ("a", 6, 12)), SCHEMA)
    for _ in range(2):
        stream.process(second, 1)
    assert deltas(spark, stream) == [("a", 5, 0), ("a", 6, 2)]
    assert [r["x"] for r in stream.late(spark).collect()] == [8]
    stream.process(spark.createDataFrame(rows(("a", 7, 20)), SCHEMA), 2)
    assert deltas(spark, stream)[-1] == ("a", 7, 8)


def test_wait_windows_on_a_plain_frame(spark):
    sample = spark.createDataFrame(
        [("h", T0, None, None), ("h", T0 + timedelta(minutes=59), None, None), ("h", T0 + timedelta(hours=1), "w", "IO")],
        "host string, snapshot_time timestamp, wait_event string, wait_event_type string",
    )
    counted = wait_windows(sample, delay="10 minutes", scope=["host"]).orderBy("window_start").collect()
    assert [(r["wait_event"], r["total_samples"]) for r in counted] == [("CPU", 2), ("w", 1)]
    assert F.col("x") is not None


def test_later_run_continues(spark, tmp_path):
    """Files that arrive between two runs are differenced against the state the first run left."""
    stream = DeltaStream(str(tmp_path / "out"), ["x"], ["k"])
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for hour, value in ((0, 10), (1, 14), (2, 3), (3, 9)):
        spark.createDataFrame(rows(("a", hour, value)), SCHEMA).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(SCHEMA).parquet(source)
        stream.start(arriving, checkpoint).awaitTermination()
    assert deltas(spark, stream) == [("a", 0, 0), ("a", 1, 4), ("a", 2, -11), ("a", 3, 6)]
    assert sorted(p.name for p in (tmp_path / "out" / "state" / "live").iterdir() if p.is_dir()) == ["batch=2", "batch=3"]
    assert list((tmp_path / "out" / "work").iterdir()) == []


def test_csv_files_are_ingested(spark, tmp_path):
    from snapdelta.sources import lake
    from snapdelta.streaming.ingest import land_stream, stream_snapshots

    df = spark.createDataFrame(
        [("h", "d", T0, "a", 'x "y"\nz'), ("h", "d", T0 + timedelta(hours=1), "a", None)],
        "host string, database string, snapshot_time timestamp, name string, setting string",
    )
    lake.write_snapshots(df, str(tmp_path / "in"), "pg_settings", file_format="csv")
    arriving = stream_snapshots(spark, str(tmp_path / "in"), "pg_settings", file_format="csv", max_files=1)
    land_stream(arriving, str(tmp_path / "out"), "pg_settings", str(tmp_path / "cp")).awaitTermination()
    back = lake.read_compacted(spark, str(tmp_path / "out"), "pg_settings").select(*df.columns)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_state_written_grows_with_the_batch(spark, tmp_path):
    """A hundred entities are known; a batch of one entity reads and writes its own part, and a part is folded now and then."""
    stream = DeltaStream(str(tmp_path / "out"), ["x"], ["k"], parts=16, most=3)
    names = [f"k{i}" for i in range(100)]
    batches = [rows(*[(k, 0, i) for i, k in enumerate(names)])] + [rows(("k7", h, h * 10)) for h in range(1, 9)]
    for i, part in enumerate(batches):
        stream.process(spark.createDataFrame(part, SCHEMA), i)
        if i in (2, 5):
            stream.process(spark.createDataFrame(part, SCHEMA), i)
    live = stream.state.live(spark, len(batches) - 1)
    assert 1 < max(map(len, live.values())) <= 4 and sorted(map(len, live.values()))[-2] == 1
    written = [spark.read.parquet(f"{tmp_path}/out/state/rows/batch={i}").count() for i in sorted(live[max(live, key=lambda p: len(live[p]))])]
    assert max(written[1:]) == 1 and written[0] < 30
    whole = counter_delta(spark.createDataFrame(sum(batches, []), SCHEMA), ["x"], ["k"])
    assert sorted(map(tuple, stream.deltas(spark).collect())) == sorted(map(tuple, whole.collect()))


def test_waits_in_any_order_equal_one_count(spark, tmp_path):
    """Shuffled arrival, a repeated batch, folds in between: each window ends with what a plain count gives."""
    import random

    from snapdelta.streaming.waits import WaitCounts

    rng = random.Random(5)
    sample = [(rng.choice(["h", "i"]), T0 + timedelta(minutes=rng.randrange(600)), rng.choice([None, "w"]), rng.choice([None, "IO"])) for _ in range(300)]
    schema = "host string, snapshot_time timestamp, wait_event string, wait_event_type string"
    want = wait_windows(spark.createDataFrame(sample, schema), delay="0 seconds", scope=["host"])
    stream = WaitCounts(str(tmp_path / "out"), scope=["host"])
    for i in range(6):
        for _ in range(2 if i == 3 else 1):
            stream.process(spark.createDataFrame([*sample[i::6], ("h", None, "w", None)], schema), i)
        if i in (2, 4, 5):
            stream.fold(spark, i - 1)
    assert sorted(map(tuple, stream.counts(spark).collect())) == sorted(map(tuple, want.collect()))
    assert len(list((tmp_path / "out" / "whole").iterdir())) <= 2


def test_folding_ingest_lands_what_compaction_lands(spark, tmp_path):
    """Rows of three days in four batches in any order, duplicates across batches, one batch twice: the same days, also as summaries."""
    from snapdelta.operators.summaries import increase_from_summaries
    from snapdelta.sources import days, lake
    from snapdelta.streaming.ingest import FoldingIngest

    schema = "host string, database string, snapshot_time timestamp, username string, queryid bigint, query string, calls bigint, total_exec_time double"
    items = [("h", "d", T0 + timedelta(hours=6 * i), "u", q, "t", 10 * i + q, float(i)) for i in range(12) for q in (1, 2)]
    items += [("h", "d", T0 + timedelta(hours=6 * i), "u", 1, "t", 1, 1.0) for i in (1, 7)]
    lake.compact_snapshots(spark.createDataFrame(items, schema), str(tmp_path / "want"), "pg_stat_statements")
    days.land_days(spark.createDataFrame(items, schema), str(tmp_path / "want-days"), "pg_stat_statements")
    ingest = FoldingIngest(str(tmp_path / "got"), "pg_stat_statements", str(tmp_path / "arrived"), str(tmp_path / "got-days"))
    mixed = items[::-1]
    for i in (0, 1, 1, 2, 3):
        ingest.process(spark.createDataFrame([*mixed[i::4], ("h", "d", None, "u", 1, "t", 1, 1.0)], schema), i)
    ingest.process(spark.createDataFrame([], schema), 4)
    read = lambda name: sorted(map(tuple, lake.read_compacted(spark, str(tmp_path / name), "pg_stat_statements").collect()), key=repr)
    assert read("got") == read("want") and len(read("got")) == 24
    keys = ["host", "database", "username", "queryid", "query"]
    grown = lambda name: sorted(map(tuple, increase_from_summaries(days.read_days(spark, str(tmp_path / name), "pg_stat_statements", T0, T0 + timedelta(days=3)), ["calls"], keys).collect()), key=repr)
    assert grown("got-days") == grown("want-days")
    ingest.forget(spark, ["2024-01-01"])
    assert read("got") == read("want")
