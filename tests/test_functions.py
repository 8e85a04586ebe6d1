from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from snapdelta.functions import scalars as S
from snapdelta.functions.sql_functions import register_sql_functions

RATIO = [((0, 0), 100.0), ((0, 5), 100.0), ((1, 0), 0.0), ((1, 2), 66.67), ((7, 1), 12.5), ((1, 199), 99.5)]
PER_UNIT = [((0, 7), 7.0), ((4, 10), 2.5), ((3, 1), 0.33)]
PERCENT = [((0, 0), 0.0), ((200, 50), 25.0), ((3, 1), 33.33)]
BYTES = [
    (0, "0.0 bytes"),
    (1023, "1023.0 bytes"),
    (1024, "1.0 KB"),
    (1280, "1.2 KB"),
    (1792, "1.8 KB"),
    (8192, "8.0 KB"),
    (1048576, "1.0 MB"),
    (5 * 1024**4, "5.0 TB"),
    (2048 * 1024**4, "2.0 PB"),
    (3 * 1024**6, "3.0 EB"),
    (-8192, "-8192.0 bytes"),
]


def pairs(spark, cases):
    rows = [(a, b, expected) for (a, b), expected in cases] + [(None, 1, None), (1, None, None)]
    return spark.createDataFrame(rows, "a bigint, b bigint, expected double")


@pytest.mark.parametrize(
    "column,name,cases",
    [(S.hit_ratio, "hit_ratio", RATIO), (S.per_unit, "per_unit", PER_UNIT), (S.percent_of, "percent_of", PERCENT)],
)
def test_two_place_functions(spark, column, name, cases):
    register_sql_functions(spark)
    df = pairs(spark, cases)
    for row in df.select("expected", column("a", "b").alias("got"), F.expr(f"{name}(a, b)").alias("sql")).collect():
        assert row["got"] == row["expected"] and row["sql"] == row["expected"]


def test_bytes(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([*BYTES, (None, None)], "n bigint, expected string")
    for row in df.select("*", S.human_bytes("n").alias("got"), F.expr("human_bytes(n)").alias("sql")).collect():
        assert row["got"] == row["expected"] and row["sql"] == row["expected"]
    blocks = spark.createDataFrame([(0,), (3,), (None,)], "n bigint")
    got = [r[0] for r in blocks.select(S.blocks_to_bytes("n")).collect()]
    assert got == [0, 24576, None]
    assert [r[0] for r in blocks.selectExpr("blocks_to_bytes(n)").collect()] == got
    assert blocks.select(S.blocks_to_bytes("n", 16384)).collect()[1][0] == 49152


def test_texts_and_numbers(spark):
    row = spark.sql(
        "select 'PostgreSQL 13.4 on x86_64' v, 'odd' w, cast(null as string) n, true s, 1.9D x, -1.9D y, 'a' p, 'b' q, "
        "'My_PG_Toast_1' t, 'public' u, timestamp '2024-01-01 10:00:01.5' ts"
    ).select(
        S.major_version("v"),
        S.version_label("v"),
        S.major_version("w"),
        S.wait_or_cpu("n"),
        S.role_text("s"),
        S.truncated("x"),
        S.truncated("y"),
        S.qualified_name("p", "q"),
        S.qualified_name("p", "n"),
        S.is_toast("t"),
        S.is_toast("u"),
        S.epoch_seconds("ts"),
        F.date_format(S.whole_seconds("ts"), "HH:mm:ss.SSS"),
        S.or_zero("x"),
        S.whole_percent_of("100", "29"),
        S.per_minute("0", "2"),
        F.date_format(S.report_time(F.lit("02/03/2024 04:05:06")), "yyyy-MM-dd HH:mm:ss"),
    ).first()
    assert list(row) == [
        13,
        "PostgreSQL 13.4",
        None,
        "CPU",
        "True",
        1,
        -1,
        "a.b",
        None,
        True,
        False,
        1704103201.5,
        "10:00:01.000",
        1,
        29,
        120.0,
        "2024-02-03 04:05:06",
    ]


def test_report_window():
    now = datetime(2024, 1, 1, 12, 0, 0, 7, tzinfo=timezone.utc)
    start, end = S.parse_report_window(now=now)
    assert end == now.replace(microsecond=0) and (end - start).total_seconds() == 7200
    start, end = S.parse_report_window("01/02/2024 00:00:00", "01/03/2024 10:20:30")
    assert (start.day, end.hour, end.second) == (2, 10, 30)
    with pytest.raises(ValueError):
        S.parse_report_window("01/03/2024 00:00:00", "01/02/2024 00:00:00")
