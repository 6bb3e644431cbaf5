import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import columns as C


def test_durations(spark):
    rows = [(0,), (59999,), (60000,), (3599999,), (3600000,), (None,)]
    df = spark.createDataFrame(rows, "ms long")
    got = df.select(C.ms_to_hms("ms").alias("hms"), C.ms_to_hm("ms").alias("hm"),
                    C.duration_to_hms(F.col("ms") / 1000).alias("d")).collect()
    assert [r.hms for r in got] == ["0h 0m 0s", "0h 0m 59s", "0h 1m 0s", "0h 59m 59s", "1h 0m 0s", None]
    assert [r.hm for r in got] == ["0m", "0m", "1m", "59m", "1h 0m", None]
    assert [r.d for r in got][:5] == ["0h 0m 0s", "0h 0m 59s", "0h 1m 0s", "0h 59m 59s", "1h 0m 0s"]


def test_null_strict_least_and_rounding(spark):
    df = spark.createDataFrame([(1, 2, 2.5), (None, 2, -2.5), (5, 3, 2.4)], "a int, b int, x double")
    got = df.select(C.least_strict("a", "b").alias("l"), C.round_to_long("x").alias("r")).collect()
    assert [r.l for r in got] == [1, None, 3]
    assert [r.r for r in got] == [3, -3, 2]


def test_ellipsis_and_weeks(spark):
    df = spark.createDataFrame([("x" * 41, dt.date(2024, 1, 31)), ("short", dt.date(2024, 1, 29))], "t string, d date")
    got = df.select(C.ellipsis("t").alias("e"), C.week_start("d").alias("w"), C.weekday_name("d").alias("n")).collect()
    assert got[0].e == "x" * 37 + "..." and got[1].e == "short"
    assert got[0].w == dt.date(2024, 1, 29) and got[1].w == dt.date(2024, 1, 29)
    assert got[0].n == "Wednesday"


def test_round_half_up_is_decimal(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,)], "x double")
    assert [r[0] for r in df.select(C.round_half_up("x", 2)).collect()] == [1.01, 2.68, -1.01]


def test_ordered_array_and_safe_index(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, "c", 3)], "k int, v string, o int")
    got = df.groupBy("k").agg(C.ordered_join(F.col("v"), ",", F.col("o")).alias("s")).first()
    assert got.s == "a,b,c"
    arr = spark.createDataFrame([([1, 2, 3],), ([],)], "a array<int>")
    r = arr.select(C.safe_get("a", 5).alias("x"), C.first_elem("a").alias("f"), C.last_elem("a").alias("l")).collect()
    assert r[0].x is None and r[0].f == 1 and r[0].l == 3
    assert r[1].f is None and r[1].l is None
