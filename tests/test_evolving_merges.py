"""Evolving tables, bucketed merges, clustered writes, one-pass ingest, months and chains of a stream."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import keep, records
from tessera.sources import jsonl, sinks
from tessera.sources.evolving import EvolvingTable
from tessera.streaming import stream as X


def _files(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


# ---- evolving tables ----------------------------------------------------------------


def test_evolving_table_reads_every_form(spark, tmp_path):
    t = EvolvingTable(spark, str(tmp_path / "t"))
    one = "id long, n long, r struct<a:long>"
    assert t.append(spark.createDataFrame([(1, 10, (100,))], one)) == 0
    before = _files(tmp_path)
    assert t.append(spark.createDataFrame([(2, 20, (200,))], one)) == 0  # the same form makes no version
    wide = "r struct<b:string,a:double>, id long, n double, tags array<struct<k:string>>"
    assert t.append(spark.createDataFrame([(("x", 2.5), 3, 30.5, [("t",)])], wide)) == 1
    assert t.append(spark.createDataFrame([(4, "forty")], "id long, n string")) == 2
    rows = {r.id: r for r in t.read("version").collect()}
    assert [rows[i].n for i in (1, 2, 3, 4)] == ["10", "20", "30.5", "forty"]  # other clashes become text
    assert [rows[i].r and tuple(rows[i].r) for i in (1, 3, 4)] == [(100.0, None), (2.5, "x"), None]
    assert rows[3].tags[0].k == "t" and rows[1].tags is None and [rows[i].version for i in (1, 2, 3, 4)] == [0, 0, 1, 2]
    assert before.items() <= _files(tmp_path).items()  # older files stay as they were
    assert len(t.versions()) == 3 and t.versions()[1]["n"].dataType.simpleString() == "double"


def test_evolving_table_lists_records_and_null_records(spark, tmp_path):
    t = EvolvingTable(spark, str(tmp_path / "t"))
    t.append(spark.createDataFrame([(1, [1, 2], None)], "id long, l array<long>, r struct<a:long>"))
    t.append(spark.createDataFrame([(2, [0.5], "plain")], "id long, l array<double>, r string"))
    rows = {r.id: r for r in t.read().collect()}
    assert rows[1].l == [1.0, 2.0] and rows[2].l == [0.5] and rows[1].r is None and rows[2].r is None
    with pytest.raises(FileNotFoundError):
        EvolvingTable(spark, str(tmp_path / "none")).read()


def test_evolving_table_prunes_columns(spark, tmp_path):
    t = EvolvingTable(spark, str(tmp_path / "t"))
    t.append(spark.createDataFrame([(1, "x" * 10)], "id long, unread string"))
    t.append(spark.createDataFrame([(2, "y", 1.5)], "id long, unread string, v double"))
    plan = t.read().select("id", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "unread" not in plan


# ---- merges -------------------------------------------------------------------------


def test_bucketed_merge_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    keep.merge_into_path(spark, base, path, ["k"], buckets=32)
    before = _files(tmp_path / "t")
    out = keep.merge_into_path(spark, spark.createDataFrame([(5, "new"), (5000, "new"), (None, "n")], "k long, v string"), path,
                               ["k"], buckets=32)
    assert {(r.k, r.v) for r in out.filter("v <> 'old'").collect()} == {(5, "new"), (5000, "new"), (None, "n")}
    assert out.count() == 1002
    kept = before.items() & _files(tmp_path / "t").items()
    assert len(before) - len(kept) <= 3 and len(before) >= 30


def test_index_finds_moved_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") % 20).cast("int").alias("day"), F.lit(0).alias("v"))
    plain = str(tmp_path / "plain")
    for where, buckets in ((path, 8), (plain, None)):
        keep.merge_into_path(spark, base, where, ["k"], partition_by=["day"], buckets=buckets)
    moves = [[(3, 7, 1), (999, 25, 1)], [(3, 9, 2), (4, 4, 2)], [(k, 19, 3) for k in range(0, 400, 20)]]
    for step in moves:
        before = {str(p) for p in (tmp_path / "t").rglob("part-*") if "_key_index" not in str(p)}
        df = spark.createDataFrame(step, "k long, day int, v int")
        for where, buckets in ((path, 8), (plain, None)):
            keep.merge_into_path(spark, df, where, ["k"], partition_by=["day"], buckets=buckets)
        after = {str(p) for p in (tmp_path / "t").rglob("part-*") if "_key_index" not in str(p)}
        assert len(before & after) >= 10  # partitions that no key comes from or goes to
    rows = lambda p: sorted((r.k, r.day, r.v) for r in spark.read.parquet(p).collect())
    assert rows(path) == rows(plain) and len(rows(path)) == 401 and (3, 9, 2) in rows(path)
    assert not (tmp_path / "t" / "day=0").exists()  # all of its keys moved away


# ---- clustered writes ---------------------------------------------------------------


def test_clustered_files_do_not_overlap(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 20_000, numPartitions=6).select((F.hash("id") % 500).alias("c"), F.col("id").alias("o"))
    sinks.append(df, path, cluster_by=["c", "o"], ranges=5)
    spans = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min(F.struct("c", "o")).alias("a"), F.max(F.struct("c", "o")).alias("b")).collect()
    spans = sorted((tuple(r.a), tuple(r.b)) for r in spans)
    assert len(spans) == 5 and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    sinks.append(df.limit(10), path, cluster_by=["c"], disposition="truncate")
    assert spark.read.parquet(path).count() == 10


# ---- one-pass ingest ----------------------------------------------------------------

SPECS = [jsonl.FieldSpec.from_dict(x) for x in (
    {"name": "id", "json_path": "$.id", "type": "INTEGER", "validations": [{"type": "not_null"}]},
    {"name": "v", "json_path": "$.v", "type": "FLOAT", "validations": [{"type": "range", "min": 0, "max": 9}]})]


def _land(tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.jsonl").write_text('{"id": 1, "v": 2}\n{"id": 2, "v": 99}\n\n[3]\n{"id": 4\n')
    (land / "b.jsonl").write_text('{"v": 1}\n{"id": 5, "v": 3}\n')
    (land / "c.jsonl").write_text("\nno record\n")
    return land


def test_one_pass_classifies_every_line(spark, tmp_path):
    lines = jsonl.scan_jsonl(spark, str(_land(tmp_path)))
    df = jsonl.classified(lines, SPECS, jsonl.rules_from_specs(SPECS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan
    told = {(r._status, r.id, r.v) for r in df.collect() if r._status in ("accepted", "rejected")}
    assert told == {("accepted", 1, 2.0), ("accepted", 5, 3.0), ("rejected", None, 1.0), ("rejected", 2, 99.0)}
    assert sorted(r._status for r in df.collect()) == ["accepted"] * 2 + ["bad"] * 3 + ["blank"] * 2 + ["rejected"] * 2


@pytest.mark.parametrize("mode, accepted, quarantined", [("strict", 2, 2), ("warn", 4, None), ("skip", 4, None)])
def test_ingest_outcome(spark, tmp_path, mode, accepted, quarantined):
    land, target, q = _land(tmp_path), str(tmp_path / "t"), tmp_path / "q"
    res = jsonl.ingest(spark, str(land), SPECS, target, mode=mode, quarantine=str(q), archive_dir=str(tmp_path / "done"),
                       rejected_dir=str(tmp_path / "none"), cluster_by=["id"])
    rejected = 0 if mode == "skip" else 2
    assert (res.files, res.records_read, res.records_rejected, res.bad_lines, res.files_without_records) == (3, 4, rejected, 3, 1)
    assert res.rejection_rate == rejected / 4 and res.files_archived == 2
    assert sorted(x.rsplit("/", 1)[1] for x in res.archived) == ["a.jsonl", "b.jsonl"]
    assert [x.rsplit("/", 1)[1] for x in res.rejected_files] == ["c.jsonl"]
    assert spark.read.parquet(target).count() == accepted
    assert (spark.read.parquet(str(q)).count() if q.exists() else None) == quarantined
    assert {p.name for p in land.iterdir() if not p.name.startswith(".")} == set()
    again = jsonl.ingest(spark, str(land), SPECS, target, mode=mode, disposition="truncate")
    assert (again.files, again.records_read) == (0, 0) and spark.read.schema("id long").parquet(target).count() == 0


# ---- streams ------------------------------------------------------------------------


def _deliver(spark, df, path, run):
    df.write.mode("append").parquet(path)
    run(spark.readStream.schema(df.schema).parquet(path))


def test_months_close_at_their_end(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 31, 23, 59), "a", 1.0), (dt.datetime(2024, 2, 1), "a", 2.0), (dt.datetime(2024, 2, 29, 12), "a", 4.0),
            (dt.datetime(2024, 2, 10), None, None), (dt.datetime(2024, 1, 2), "b", 8.0)]
    later = [(dt.datetime(2024, 3, 1, 12), "a", 16.0), (dt.datetime(2024, 2, 1, 1), "a", 999.0),  # that day is closed
             (dt.datetime(2024, 2, 29, 13), "a", 32.0)]
    last = [(dt.datetime(2024, 5, 2), "b", 0.0)]
    src, sink, state = (str(tmp_path / x) for x in ("src", "sink", "state"))
    schema = "ts timestamp, g string, v double"

    def run(s):
        X.run_available_now(X.tumbling_aggregates(s, "ts", "v", unit="month", group=["g"]), "months_test", sink_path=sink,
                            checkpoint=state, state_store=X.ROCKSDB[1])

    def closed():
        return sorted(((str(r.window_start)[:10], str(r.window_end)[:10], r.g, r.events, r.total)
                       for r in spark.read.parquet(sink).collect()), key=str)

    before = spark.conf.get(X.ROCKSDB[0])
    _deliver(spark, spark.createDataFrame(rows, schema), src, run)
    january = [("2024-01-01", "2024-02-01", "a", 1, 1.0), ("2024-01-01", "2024-02-01", "b", 1, 8.0)]
    assert closed() == january and spark.conf.get(X.ROCKSDB[0]) == before
    _deliver(spark, spark.createDataFrame(later, schema), src, run)
    assert closed() == january  # the watermark is a day behind: 29 February 12:00
    _deliver(spark, spark.createDataFrame(last, schema), src, run)
    assert closed() == sorted([*january, ("2024-02-01", "2024-03-01", "a", 3, 38.0), ("2024-02-01", "2024-03-01", None, 1, None),
                               ("2024-03-01", "2024-04-01", "a", 1, 16.0)], key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_of_shuffled_deliveries_equal_the_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.choice([1, 1, 1, 2, None]), start + dt.timedelta(hours=rng.randrange(0, 400) / 2), i) for i in range(160)]
    rows += [(1, None, 900), (None, None, 901), rows[0]]
    rng.shuffle(rows)
    schema = "k int, ts timestamp, id int"
    chains = X.GreedyChains(spark, str(tmp_path / "c"), "k", "ts", 24.0, "id")
    src, state = str(tmp_path / "src"), str(tmp_path / "state")
    for a in range(0, len(rows), 60):
        part = spark.createDataFrame(rows[a : a + 60], schema)
        _deliver(spark, part, src, lambda s: X.run_available_now(s, "chains_test", writer=chains.writer(), checkpoint=state))
    want = records.greedy_window_dedupe(spark.createDataFrame(rows, schema), "k", "ts", 24.0, "id")
    tell = lambda df: sorted(((r.k, str(r.ts), r.id) for r in df.collect()), key=str)
    assert tell(chains.table()) == tell(want)
    # a batch that runs again gives the same tables
    batches = len(list((tmp_path / "c" / "rows").iterdir()))
    again = spark.read.parquet(f"{tmp_path}/c/rows/_batch={batches - 1}").select("k", "ts", "id").collect()
    chains.writer()(spark.createDataFrame(again, schema), batches - 1)
    assert tell(chains.table()) == tell(want)


def test_late_chains_are_joined_once_per_batch(spark, tmp_path):
    from pathlib import Path

    from tessera.session import checkpoint_root

    again = lambda: {str(p) for p in Path(checkpoint_root(spark).removeprefix("file:")).glob("chains-again-*")}
    start, schema = dt.datetime(2024, 1, 1), "k int, ts timestamp, id int"
    chains = X.GreedyChains(spark, str(tmp_path / "c"), "k", "ts", 24.0, "id")
    before = again()
    deliveries = [[(1, 30, 0), (1, 60, 1), (2, 5, 2)], [(1, 0, 3), (2, 100, 4), (2, 29, 5)]]
    for n, part in enumerate(deliveries):
        batch = spark.createDataFrame([(k, start + dt.timedelta(hours=h), i) for k, h, i in part], schema)
        chains.writer()(batch, n)
        assert len(again() - before) == n  # the first delivery has no chain to emit again
    made, = again() - before
    # key 1 from its late first row on; key 2 from its last fixed row's window on
    assert sorted(r.id for r in spark.read.parquet(made).collect()) == [0, 1, 3, 4, 5]
    assert sorted(r.id for r in chains.table().collect()) == [0, 1, 2, 3, 4, 5]
