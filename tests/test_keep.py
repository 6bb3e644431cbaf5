import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import keep

T0 = dt.datetime(2024, 1, 1)


def test_keep_latest_fixture(spark):
    rows = [("a", T0, 1), ("a", T0 + dt.timedelta(hours=1), 2), ("a", T0 + dt.timedelta(hours=1), 3),
            ("b", T0, 4), (None, T0, 5), (None, T0 + dt.timedelta(hours=2), 6)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v int")
    out = keep.keep_latest(df, ["k"], [F.col("ts").desc()], [F.col("v").desc()])
    got = {r.k: r.v for r in out.collect()}
    assert got == {"a": 3, "b": 4, None: 6}
    dropped = keep.keep_latest(df, ["k"], [F.col("ts").desc()], [F.col("v").desc()], drop_null_keys=True)
    assert {r.k for r in dropped.collect()} == {"a", "b"}


def test_keep_latest_plans_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("ts"))
    plan = keep.keep_latest(df, ["k"], [F.col("ts").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_merge_upsert_fixture(spark):
    target = spark.createDataFrame([(1, "old"), (2, "same"), (None, "nullkey")], "id int, v string")
    source = spark.createDataFrame([(1, "new"), (3, "insert"), (None, "nullkey2")], "id int, v string")
    got = sorted((r.id if r.id is not None else -1, r.v) for r in keep.merge_upsert(target, source, ["id"]).collect())
    assert got == [(-1, "nullkey"), (-1, "nullkey2"), (1, "new"), (2, "same"), (3, "insert")]


def test_incremental_filter(spark):
    target = spark.createDataFrame([(T0,), (T0 + dt.timedelta(days=1),)], "ts timestamp")
    source = spark.createDataFrame([(T0,), (T0 + dt.timedelta(days=1),), (T0 + dt.timedelta(days=2),)], "ts timestamp")
    assert keep.incremental_filter(source, target, "ts", "ts").count() == 1
    assert keep.incremental_filter(source, None, "ts", "ts").count() == 3
    assert keep.incremental_filter(source, target, "ts", "ts", overlap="1 day").count() == 2
    empty = target.limit(0)
    assert keep.incremental_filter(source, empty, "ts", "ts").count() == 3


def test_merge_into_path(spark, tmp_path):
    path = str(tmp_path / "tbl")
    first = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 2))],
                                  "id int, v string, d date")
    keep.merge_into_path(spark, first, path, ["id"])
    second = spark.createDataFrame([(2, "B", dt.date(2024, 1, 2)), (3, "c", dt.date(2024, 1, 3))],
                                   "id int, v string, d date")
    out = keep.merge_into_path(spark, second, path, ["id"])
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert "_dp_updated_at" in out.columns


def test_merge_into_partitioned_path(spark, tmp_path):
    path = str(tmp_path / "ptbl")
    first = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02")], "id int, v string, day string")
    keep.merge_into_path(spark, first, path, ["id"], partition_by=["day"], updated_col=None)
    second = spark.createDataFrame([(2, "B", "2024-01-02"), (3, "c", "2024-01-02")], "id int, v string, day string")
    out = keep.merge_into_path(spark, second, path, ["id"], partition_by=["day"], updated_col=None)
    assert sorted((r.id, r.v, str(r.day)) for r in out.collect()) == [
        (1, "a", "2024-01-01"), (2, "B", "2024-01-02"), (3, "c", "2024-01-02")]


def test_merge_moves_a_key_between_partitions(spark, tmp_path):
    path = str(tmp_path / "mtbl")
    schema = "id int, v string, day string"
    first = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2024-01-02"),
                                   (4, "d", "2024-01-03")], schema)
    keep.merge_into_path(spark, first, path, ["id"], partition_by=["day"], updated_col=None)
    moved = spark.createDataFrame([(1, "A", "2024-01-02"), (2, "B", "2024-01-04")], schema)
    out = keep.merge_into_path(spark, moved, path, ["id"], partition_by=["day"], updated_col=None)
    assert sorted((r.id, r.v, str(r.day)) for r in out.collect()) == [
        (1, "A", "2024-01-02"), (2, "B", "2024-01-04"), (3, "c", "2024-01-02"), (4, "d", "2024-01-03")]
    assert not (tmp_path / "mtbl" / "day=2024-01-01").exists()


def test_failed_swap_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.range(3).write.parquet(path)
    with pytest.raises(OSError):
        keep.replace_path(spark, str(tmp_path / "missing"), path)
    assert spark.read.parquet(path).count() == 3


def test_unique_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [(r.k, r.occurrences) for r in keep.unique_key_violations(df, ["k"]).collect()] == [(1, 2)]
