import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import transforms as T


def test_epoch_ms(spark):
    df = spark.createDataFrame([("1704067200000",), ("1729930028000",), ("2024-03-01 10:00:00",), ("oops",), (None,)],
                               "v string")
    got = [r[0] for r in df.select(T.timestamp_ms_to_timestamp("v")).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 0, 0)
    assert got[1] == dt.datetime(2024, 10, 26, 8, 7, 8)
    assert got[2] == dt.datetime(2024, 3, 1, 10, 0)
    assert got[3] is None and got[4] is None


def test_flexible_date(spark):
    df = spark.createDataFrame([("1999",), ("1999-07",), ("1999-07-04",), ("abcd",), (None,)], "v string")
    got = [r[0] for r in df.select(T.string_to_date_flexible("v")).collect()]
    assert got == [dt.date(1999, 1, 1), dt.date(1999, 7, 1), dt.date(1999, 7, 4), None, None]


def test_string_to_date_variants(spark):
    df = spark.createDataFrame([("2024-05-06.0",), ("2024-05-06T10:11:12",), ("bad",)], "v string")
    got = [r[0] for r in df.select(T.string_to_date("v")).collect()]
    assert got == [dt.date(2024, 5, 6), dt.date(2024, 5, 6), None]


def test_iso_timestamp_zone_dropped(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05+02:00",)], "v string")
    got = [r[0] for r in df.select(T.string_to_timestamp_iso("v")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5)]


def test_casts(spark):
    df = spark.createDataFrame([(" 42 ",), ("1.5",), ("",), ("no",), ("0",), ("false",)], "v string")
    got = df.select(T.cast_value("v", "INT64").alias("i"), T.cast_value("v", "FLOAT64").alias("f"),
                    T.cast_value("v", "BOOL").alias("b")).collect()
    assert [r.i for r in got] == [42, None, None, None, 0, None]
    assert [r.f for r in got] == [42.0, 1.5, None, None, 0.0, None]
    assert [r.b for r in got] == [True, True, False, True, False, False]
