import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tessera.sources import sinks as K


def test_slices(spark):
    months = [(str(r.slice_start), str(r.slice_end)) for r in K.month_slices(spark, "2024-01-15", "2024-03-10").collect()]
    assert months == [("2024-01-15", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-10")]
    chunks = K.day_chunks(spark, "2024-01-01", "2024-02-29", 28).collect()
    assert len(chunks) >= 3 and str(chunks[0].slice_end) == "2024-01-28" and str(chunks[1].slice_start) == "2024-01-29"
    progress = spark.createDataFrame([(dt.date(2024, 1, 1), "completed"), (dt.date(2024, 1, 29), "failed")],
                                     "slice_start date, status string")
    pending = sorted(str(r.slice_start) for r in K.pending_slices(K.day_chunks(spark, "2024-01-01", "2024-02-29", 28), progress).collect())
    assert pending == ["2024-01-29", "2024-02-26"]


def test_csv_and_export_values(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2], dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5))],
                               "id int, arr array<int>, d date, ts timestamp")
    K.write_csv(df, str(tmp_path / "csv"))
    text = "".join(open(os.path.join(tmp_path / "csv", f)).read() for f in os.listdir(tmp_path / "csv") if f.endswith(".csv"))
    assert '"[1,2]"' in text
    r = K.export_values(df).first()
    assert (r.d, r.ts) == ("2024-01-02", "2024-01-02T03:04:05")


def test_append_partitioned_and_expiry(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 20, 5))], "id int, ts timestamp")
    K.append(df, path, partition_col="ts", unit="DAY", cluster_by=["id"])
    assert spark.read.parquet(path).count() == 2
    removed = K.expire_partitions(spark, path, keep_days=10, today=dt.date(2024, 1, 25))
    assert removed == ["_partition=2024-01-01"] and spark.read.parquet(path).count() == 1


def test_expiry_of_months_and_years(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.datetime(2001, 1, 5)), (2, dt.datetime(2024, 1, 5))], "id int, ts timestamp")
    for unit, gone in (("MONTH", "_partition=2001-01"), ("YEAR", "_partition=2001")):
        path = str(tmp_path / unit)
        K.append(df, path, partition_col="ts", unit=unit)
        assert K.expire_partitions(spark, path, keep_days=30, today=dt.date(2024, 1, 25)) == [gone]
        assert [r.id for r in spark.read.parquet(path).collect()] == [2]


def test_entity_documents(spark, tmp_path):
    top = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "artist_id int, rank int, name string")
    cal = spark.createDataFrame([(1, dt.date(2024, 1, 1), 3)], "artist_id int, day date, plays int")
    docs = K.entity_documents("artist_id", {"tracks": top, "calendar": cal}, order={"tracks": [F.col("rank")]})
    got = {r.artist_id: r for r in docs.collect()}
    assert [t.name for t in got[1].tracks] == ["a", "b"] and got[1].calendar[0].day == "2024-01-01"
    assert got[2].calendar is None
    K.write_documents(docs, "artist_id", str(tmp_path / "docs"))
    assert {"artist_id=1", "artist_id=2"} <= set(os.listdir(tmp_path / "docs"))
    b = K.bundle({"a": top, "b": cal}).first()
    assert len(b.a) == 3 and len(b.b) == 1


def test_export_population(spark):
    stats = spark.createDataFrame([(i, 100 - i, dt.date(2024, 1, 1 + (i % 3))) for i in range(10)],
                                  "artist_id int, plays int, last_day date")
    got = sorted(r.artist_id for r in K.export_population(stats, "artist_id", "plays", "last_day", 2,
                                                           dt.date(2024, 1, 3)).collect())
    assert got == [0, 1, 2, 5, 8]


def test_document_store_builds_documents_once(spark, tmp_path):
    built = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        built.add(1)
        return "é" * i

    docs = spark.range(1, 21, 1, 2).select("id", text("id").alias("t"))
    store = K.DocumentStore(spark, str(tmp_path / "once"), "id", buckets=3)
    store.write(docs)
    assert built.value == 20
    lines = {(r.file, r.value): r.value for r in store.lines().collect()}
    index = {r.key: r for r in store.index().collect()}
    assert set(index) == {str(i) for i in range(1, 21)}
    for file, value in lines:
        key = str(json.loads(value)["id"])
        assert index[key].file == file and index[key].bytes == len(value.encode())
    for bucket in range(3):  # a task may give its files of several buckets one name
        held = sorted((r for r in index.values() if r._bucket == bucket), key=lambda r: r.key)
        assert [r.line for r in held] == list(range(len(held)))
