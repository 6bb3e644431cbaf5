import datetime as dt
import json
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.jsonl import FieldSpec
from tessera.streaming import stream as X

SPECS = [FieldSpec.from_dict(d) for d in [
    {"name": "id", "json_path": "$.id", "type": "INTEGER"},
    {"name": "v", "json_path": "$.v"},
    {"name": "ts", "json_path": "$.ts", "type": "TIMESTAMP", "transform": "timestamp_ms_to_timestamp"},
]]


def _land(d, name, recs):
    (d / name).write_text("\n".join(json.dumps(r) for r in recs) + "\n")


def test_available_now_merge_and_archive(spark, tmp_path):
    land, arch = tmp_path / "land", tmp_path / "archive"
    land.mkdir()
    _land(land, "a.jsonl", [{"id": 1, "v": "a", "ts": 1000}, {"id": 2, "v": "b", "ts": 1000}])
    target = str(tmp_path / "target")
    ckpt = str(tmp_path / "ckpt")
    writer = X.merge_batch_writer(target, ["id"], "ts")
    X.run_available_now(X.parsed_stream(X.landing_stream(spark, str(land), str(arch)), SPECS), "t1", writer=writer,
                        checkpoint=ckpt)
    # a re-delivered record (same id, newer ts) and a new one arrive later
    _land(land, "b.jsonl", [{"id": 2, "v": "b2", "ts": 2000}, {"id": 3, "v": "c", "ts": 2000}])
    X.run_available_now(X.parsed_stream(X.landing_stream(spark, str(land), str(arch)), SPECS), "t1", writer=writer,
                        checkpoint=ckpt)
    got = sorted((r.id, r.v) for r in spark.read.parquet(target).collect())
    assert got == [(1, "a"), (2, "b2"), (3, "c")]


def test_weekly_windows_start_monday(spark, tmp_path):
    src = tmp_path / "src"
    rows = [(dt.datetime(2024, 1, 3, 12), 1.0), (dt.datetime(2024, 1, 8, 1), 2.0), (dt.datetime(2024, 1, 30), 0.0)]
    spark.createDataFrame(rows, "ts timestamp, value double").write.parquet(str(src))
    stream = spark.readStream.schema("ts timestamp, value double").parquet(str(src))
    agg = X.tumbling_aggregates(stream, "ts", "value", unit="week", delay="1 day")
    q = agg.writeStream.format("memory").queryName("weekly_test").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = sorted((str(r.window_start), r.events) for r in spark.sql("select * from weekly_test").collect())
    assert got[:2] == [("2024-01-01 00:00:00", 1), ("2024-01-08 00:00:00", 1)]


def test_dedupe_within_watermark(spark, tmp_path):
    src = tmp_path / "src"
    rows = [(1, dt.datetime(2024, 1, 1, 23)), (1, dt.datetime(2024, 1, 2, 1)), (2, dt.datetime(2024, 1, 2, 2))]
    spark.createDataFrame(rows, "id int, ts timestamp").write.parquet(str(src))
    stream = spark.readStream.schema("id int, ts timestamp").parquet(str(src))
    q = X.dedupe_within_watermark(stream, ["id"], "ts").writeStream.format("memory").queryName("dd_test").option(
        "checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.id for r in spark.sql("select * from dd_test").collect()) == [1, 2]


def test_greedy_dedupe_across_batches(spark, tmp_path):
    src, target, ckpt = tmp_path / "src", str(tmp_path / "kept"), str(tmp_path / "ck")
    t0 = dt.datetime(2024, 1, 1)
    writer = X.greedy_dedupe_writer(target, "k", "ts", 24)
    schema = "k string, ts timestamp"
    # the second batch holds a late row (5 h), rows too close to the last kept one, and a new key
    for batch in ([("u", 0), ("u", 10), ("u", 23), ("u", 24), ("u", 30)], [("u", 5), ("u", 47.5), ("u", 48), ("u", 60), ("v", 3)]):
        rows = [(k, t0 + dt.timedelta(hours=h)) for k, h in batch]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(src))
        X.run_available_now(spark.readStream.schema(schema).parquet(str(src)), "greedy", writer=writer, checkpoint=ckpt)
    got = sorted((r.k, (r.ts - t0).total_seconds() / 3600) for r in spark.read.parquet(target).collect())
    assert got == [("u", 0), ("u", 24), ("u", 48), ("v", 3)]
    # a batch that is run again gives the same rows
    writer(spark.createDataFrame([(k, t0 + dt.timedelta(hours=h)) for k, h in batch], schema), 1)
    assert sorted((r.k, (r.ts - t0).total_seconds() / 3600) for r in spark.read.parquet(target).collect()) == got


def test_daily_windows_over_events_table(spark, tmp_path):
    """X06 on the provided events table read as a file stream: every day the
    watermark has closed equals the batch aggregate of the same day."""
    sf = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    agg = X.tumbling_aggregates(stream, "ts", "value", unit="day", delay="1 day", group=["event_type"])
    q = agg.writeStream.format("memory").queryName("events_daily").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.window_start.date(), r.event_type): (r.events, round(r.total, 6))
           for r in spark.sql("select * from events_daily").collect()}
    assert got
    last = max(d for d, _ in got)
    want = {(r.d, r.event_type): (r.n, round(r.t, 6)) for r in events.groupBy(
        F.to_date("ts").alias("d"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("t")).collect()
        if r.d <= last}
    assert got == want


def test_sliding_week_counts_over_events(spark, tmp_path):
    """X07 (short span): 7-day windows sliding daily over the events stream;
    every window the watermark closed equals a batch count over the same range."""
    sf = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    agg = X.sliding_counts(stream, "ts", ["event_type"], days=7, slide="1 day")
    q = agg.writeStream.format("memory").queryName("events_week").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.window_start, r.event_type): r.plays for r in spark.sql("select * from events_week").collect()}
    assert got
    for (start, typ), plays in list(got.items())[:5]:
        end = start + dt.timedelta(days=7)
        n = events.filter((F.col("event_type") == typ) & (F.col("ts").cast("timestamp") >= F.lit(start))
                          & (F.col("ts").cast("timestamp") < F.lit(end))).count()
        assert n == plays
