import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import nested as N
from tessera.operators import records as RC

T0 = dt.datetime(2024, 1, 1)


def test_greedy_dedupe_fixture(spark):
    hours = [0, 10, 23, 24, 30, 47, 48]
    rows = [("u", T0 + dt.timedelta(hours=h), i) for i, h in enumerate(hours)] + [("v", T0, 99)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int").repartition(3)
    got = sorted((r.k, int((r.ts - T0).total_seconds() // 3600)) for r in RC.greedy_window_dedupe(df, "k", "ts", 24).collect())
    assert got == [("u", 0), ("u", 24), ("u", 48), ("v", 0)]


def test_pivot_measures(spark):
    schema = "grpid long, attrib int, measures array<struct<type:int,value:long,unit:int>>"
    rows = [(1, 0, [(1, 7250, -2), (6, 215, -1), (1, 7300, -2)]), (2, 1, [(1, 7000, -2)]), (3, 2, [(6, 200, -1)])]
    df = RC.device_sourced(spark.createDataFrame(rows, schema))
    out = RC.pivot_measures(df, ["grpid"], "measures", {1: "weight", 6: "fat_ratio"}, keep_if="weight")
    got = [(r.grpid, r.weight, r.fat_ratio) for r in out.collect()]
    assert got == [(1, 73.0, 21.5)]
    bm = RC.body_metrics(spark.createDataFrame([(80.0, 2.0, 44.0)], "w double, h double, hy double"), "w", "h", "hy")
    assert bm.first().bmi == 20.0 and bm.first().hydration_pct == 55.0


def test_descriptor_zip_and_flatten(spark):
    df = spark.createDataFrame(
        [([[1.0, 2.0], [3.0, None]], [("a", 0), ("b", 1)], [[1, 2], [3, 4]], [[1, 2, 3]])],
        "vals array<array<double>>, desc array<struct<key:string,metricsIndex:int>>, pairs array<array<long>>, "
        "wide array<array<long>>")
    r = df.select(N.zip_descriptors("vals", "desc").alias("m"), N.flatten_pairs("pairs").alias("p"),
                  N.flatten_wide("wide", 3).alias("w")).first()
    assert r.m == [{"a": 1.0, "b": 2.0}, {"a": 3.0}]
    assert [(x.timestamp, x.value) for x in r.p] == [(1, 2), (3, 4)]
    assert [(x.val_0, x.val_1, x.val_2) for x in r.w] == [(1, 2, 3)]


def test_recursive_flatten_and_map_cleanup(spark):
    schema = T.StructType([T.StructField("doc", T.StructType([
        T.StructField("stress", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("inner", T.ArrayType(T.StructType([T.StructField("pts", T.ArrayType(T.ArrayType(T.LongType())))]))),
    ]))])
    df = spark.createDataFrame([(([[1, 2]], [([[5, 6]],)]),)], schema)
    col = N.flatten_nested_arrays(F.col("doc"), schema["doc"].dataType)
    r = df.select(col.alias("d")).first().d
    assert (r.stress[0].timestamp, r.stress[0].value) == (1, 2) and r.inner[0].pts[0].value == 6
    m = spark.createDataFrame([({"a": 1, "b": None},), ({"c": None},)], "m map<string,int>")
    assert [x[0] for x in m.select(N.drop_null_entries("m")).collect()] == [{"a": 1}, None]


def test_json_helpers(spark):
    doc = '{"devices": {"x": {"id": "d1"}, "y": {"id": "d2"}}, "genres": ["rock", "pop"], "n": 5, "items": 7}'
    df = spark.createDataFrame([(doc,)], "j string")
    r = df.select(N.json_first_value("j", "$.devices", "id").alias("dev"), N.json_string_array("j", "$.genres").alias("g"),
                  N.repair_array("j", "$.items", T.LongType()).alias("rep"),
                  N.repair_array("j", "$.missing", T.LongType()).alias("miss"),
                  N.json_object_struct("j", "$.devices.x", {"id": ("$.id", "string")}).alias("s")).first()
    assert r.dev == "d1" and r.g == ["rock", "pop"] and r.rep == [7] and r.miss == [] and r.s.id == "d1"


def test_envelope_and_entries(spark):
    df = spark.createDataFrame([([{"steps": 5}, {"steps": 6}],)], "payload array<struct<steps:int>>")
    env = RC.envelope(df, "payload", "2024-01-01", "steps")
    assert [(r.data.steps, r.date, r.data_type) for r in env.collect()] == [(5, "2024-01-01", "steps"), (6, "2024-01-01", "steps")]
    days = spark.createDataFrame([("2024-01-02", [("a", None), ("b", "2024-01-03")])],
                                 "summaryDate string, entries array<struct<name:string,summaryDate:string>>")
    got = [(r.name, r.summaryDate) for r in RC.explode_entries(days, "entries", {"summaryDate": "summaryDate"}).collect()]
    assert got == [("a", "2024-01-02"), ("b", "2024-01-03")]


def test_recover_key_and_filters(spark):
    df = spark.createDataFrame([(None, "/x/123_activity.jsonl"), (5, "/x/9_a.jsonl"), (None, "/x/none.jsonl")],
                               "id long, f string")
    assert sorted(r.id for r in RC.recover_key(df, "id", "f").collect()) == [5, 123]
    games = spark.createDataFrame([(1704067200,), (1706745600,)], "end_time long")
    assert RC.epoch_range_filter(games, "end_time", "2024-01-01", "2024-01-15").count() == 1


def test_minute_anti_join(spark):
    src = spark.createDataFrame([(1, T0 + dt.timedelta(seconds=10)), (1, T0 + dt.timedelta(minutes=5))], "u int, ts timestamp")
    tgt = spark.createDataFrame([(1, T0 + dt.timedelta(seconds=50))], "u int, ts timestamp")
    assert RC.skip_existing_minutes(src, tgt, "ts", ["u"]).count() == 1


def test_since_yesterday_hour(spark):
    from tessera.operators.records import since_yesterday_hour

    now = F.to_timestamp(F.lit("2024-06-10 08:00:00"))
    df = spark.createDataFrame([(dt.datetime(2024, 6, 9, 20, 59),), (dt.datetime(2024, 6, 9, 21, 0),)], "ts timestamp")
    # Paris is UTC+2 in June: yesterday 23:00 local = 21:00 UTC
    got = [r.ts.hour for r in df.filter(since_yesterday_hour("ts", "Europe/Paris", 23, now)).collect()]
    assert got == [21]


def test_safe_millis_and_datetime(spark):
    from tessera.functions.columns import datetime_of, safe_timestamp_millis

    df = spark.createDataFrame([(1704067200000,), (10**15,)], "ms long")
    assert [r[0] for r in df.select(safe_timestamp_millis("ms")).collect()] == [dt.datetime(2024, 1, 1), None]
    one = spark.createDataFrame([("2024-01-02 03:04:05",)], "s string").select(datetime_of("s")).first()[0]
    assert one == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_greedy_dedupe_matches_brute_force(spark):
    import random

    from tessera.operators.records import greedy_window_dedupe

    rnd = random.Random(7)
    rows = []
    for k in range(4):  # sparse keys with gaps around the window; key 0 is null
        t = T0
        for i in range(60):
            t = t + dt.timedelta(hours=rnd.choice([0.5, 3, 11, 23.9, 24, 30, 50]))
            rows.append((k or None, i, t))
    # a hot key without any gap: microseconds apart in places, times that repeat, and before the epoch's day start
    rows += [(9, i, T0 + dt.timedelta(microseconds=rnd.randrange(40 * 86_400_000_000) // 7 * 7)) for i in range(3000)]
    rows += [(9, 5000 + i, t) for i, (_, _, t) in enumerate(rows[-3000::11])]
    df = spark.createDataFrame(rows, "k int, i int, ts timestamp")

    def brute(points):
        kept, last = [], None
        for i, t in sorted(points, key=lambda p: p[1]):
            if last is None or (t - last) >= dt.timedelta(hours=24):
                kept.append(i)
                last = t
        return kept

    want = {(k, i) for k in {r[0] for r in rows} for i in brute([(i, t) for kk, i, t in rows if kk == k])}
    got = {(r.k, r.i) for r in greedy_window_dedupe(df, "k", "ts", 24.0, "i").collect()}
    assert got == want


def test_greedy_dedupe_of_nothing_and_of_rows_without_time(spark):
    from tessera.operators.records import greedy_window_dedupe

    empty = spark.createDataFrame([], "k int, i int, ts timestamp")
    assert greedy_window_dedupe(empty, "k", "ts", 24.0).collect() == []
    rows = [(1, 0, None), (1, 1, T0), (1, 2, T0), (1, 3, None)]
    got = greedy_window_dedupe(spark.createDataFrame(rows, "k int, i int, ts timestamp"), "k", "ts", 24.0, "i").collect()
    assert sorted(r.i for r in got) == [0, 1, 3]


def test_nested_deep(spark):
    """Number lists below lists of lists, records in maps, and null members on the way."""
    schema = T.StructType.fromDDL(
        "a array<array<struct<m:array<array<double>>>>>, b map<string,struct<m:array<array<double>>>>, c struct<d:array<struct<e:array<array<double>>>>>")
    df = spark.createDataFrame(
        [([[([[1.0, 2.0]],), None], None], {"x": ([[1.0, 2.0, 3.0], [4.0]],), "y": None}, ([([[7.0, 8.0]],), (None,)],)), (None, None, None)],
        schema)
    widths = N.matrix_widths(df)
    assert widths == {"a.m": 2, "b.m": 3, "c.d.e": 2}
    flat = df.select(*[N.flatten_nested_arrays(F.col(f.name), f.dataType, widths, f.name).alias(f.name) for f in schema.fields])
    first, last = flat.collect()
    assert first.a[0][0].m[0].value == 2.0 and first.a[0][1] is None and first.a[1] is None
    assert [tuple(x) for x in first.b["x"].m] == [(1.0, 2.0, 3.0), (4.0, None, None)] and first.b["y"] is None
    assert first.c.d[0].e[0].timestamp == 7.0 and first.c.d[1].e is None
    assert last.a is None and last.b is None and last.c is None


def _jumps(spark):
    from pathlib import Path

    from tessera.session import checkpoint_root

    return {p.name for p in Path(checkpoint_root(spark).removeprefix("file:")).glob("dedupe-jump-*")}


def test_short_keys_are_walked_and_shuffled_once(spark):
    from tessera.operators.records import greedy_window_dedupe

    rows = [(k, i, T0 + dt.timedelta(hours=7 * i)) for k in (None, 1, 2) for i in range(200)]
    before = _jumps(spark)
    out = greedy_window_dedupe(spark.createDataFrame(rows, "k int, i int, ts timestamp"), "k", "ts", 24.0, "i")
    # times by key, rows and kept times by (key, time), kept rows by (key, time)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 4
    assert _jumps(spark) == before
    assert sorted((str(r.k), r.i) for r in out.collect()) == [(str(k), i) for k in (1, 2, None) for i in range(0, 200, 4)]


def test_long_and_short_keys_together(spark):
    import random

    from tessera.operators.records import greedy_window_dedupe

    rnd = random.Random(3)
    sizes = {None: 400, 1: 400, 2: 101, 3: 100, 4: 99, 5: 1}  # null and 1 and 2 have more than 100 rows
    rows = [(k, i, T0 + dt.timedelta(minutes=rnd.randrange(30 * 1440))) for k, n in sizes.items() for i in range(n)]
    rows += [(k, 1000 + i, t) for k, i, t in rows[::5]] + [(1, 5000, None), (None, 5001, None), (6, 5002, None)]
    df, before = spark.createDataFrame(rows, "k int, i int, ts timestamp"), _jumps(spark)
    tell = lambda out: {(r.k, r.i, r.ts) for r in out.collect()}
    walked = tell(greedy_window_dedupe(df, "k", "ts", 24.0, "i"))
    assert _jumps(spark) == before
    assert tell(greedy_window_dedupe(df, "k", "ts", 24.0, "i", walked_rows=100)) == walked
    assert _jumps(spark) > before  # the long keys were spread
    assert tell(greedy_window_dedupe(df, "k", "ts", 24.0, "i", walked_rows=0)) == walked
    assert {i for _, i, t in walked if t is None} == {5000, 5001, 5002}
