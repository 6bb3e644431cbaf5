import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import relational as R

T0 = dt.datetime(2024, 1, 1, 10, 0)


def _ts(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_interval_join_fixture(spark):
    acts = spark.createDataFrame(
        [(1, 7, _ts(0), _ts(30)), (2, 7, _ts(20), _ts(50)), (3, 7, _ts(200), _ts(230)), (4, 8, _ts(0), _ts(30))],
        "activity_id int, user_id int, start_ts timestamp, end_ts timestamp")
    pts = spark.createDataFrame(
        [(10, 7, _ts(0)), (11, 7, _ts(30)), (12, 7, _ts(25)), (13, 7, _ts(31)), (14, 7, _ts(100)), (15, 9, _ts(5))],
        "play_id int, user_id int, played_at timestamp")
    pairs = R.interval_join(acts, pts, "start_ts", "end_ts", "played_at", keys=["user_id"], bucket_seconds=600)
    got = sorted((r.activity_id, r.play_id) for r in pairs.collect())
    # start and end inclusive; 12 lies in two activities; 13/14/15 match nothing
    assert got == [(1, 10), (1, 11), (1, 12), (2, 11), (2, 12), (2, 13)]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_streak_fixture(spark):
    d = dt.date(2024, 1, 10)
    rows = [("today", d), ("today", d - dt.timedelta(1)), ("today", d - dt.timedelta(2)), ("today", d - dt.timedelta(4)),
            ("gap", d - dt.timedelta(1)), ("future", d + dt.timedelta(1)), ("future", d), ("single", d)]
    df = spark.createDataFrame(rows, "k string, day date")
    got = {r.k: r.current_streak for r in R.current_streak(df, "k", "day", d).collect()}
    assert got == {"today": 3, "future": 1, "single": 1}


def test_spines(spark):
    agg = spark.createDataFrame([(dt.date(2024, 1, 30), 5)], "date date, n long")
    filled = R.spine_fill(R.date_spine(spark, "2024-01-31", 3), agg, "date", {"n": 0})
    assert sorted((str(r.date), r.n) for r in filled.collect()) == [
        ("2024-01-28", 0), ("2024-01-29", 0), ("2024-01-30", 5), ("2024-01-31", 0)]
    empty = R.spine_fill(R.date_spine(spark, "2024-01-31", 1), agg.limit(0), "date", {"n": 0})
    assert [r.n for r in empty.collect()] == [0, 0]
    weeks = [str(r.week_start) for r in R.week_spine(spark, "2024-01-31", 2).orderBy("week_start").collect()]
    assert weeks == ["2024-01-15", "2024-01-22", "2024-01-29"]


def test_whole_table_numbers_and_batches(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("v"))
    v = F.col("v")
    out = R.bucketed_row_number(df, [], (-F.ceil(v / 100), -F.ceil(v / 9)), [v.desc()], "rn")
    rows = sorted((r.rn, r.v) for r in out.collect())
    assert [r[0] for r in rows] == list(range(1, 1001))
    assert [r[1] for r in rows] == sorted([r[1] for r in rows], reverse=True)
    b = R.batch_ids(df, (F.floor(v / 100), F.floor(v / 10)), [v], 300)
    counts = sorted((r.batch_id, r["count"]) for r in b.groupBy("batch_id").count().collect())
    assert counts == [(0, 300), (1, 300), (2, 300), (3, 100)]


def test_period_rollup_matches_brute_force(spark):
    as_of = dt.date(2024, 1, 31)
    rows = [(k % 5, dt.datetime(2024, 1, 31) - dt.timedelta(days=k % 400, hours=k % 7)) for k in range(2000)]
    df = spark.createDataFrame(rows, "key long, ts timestamp")
    got = {(r.period, r.key): r.n for r in R.period_rollup(df, "ts", as_of, ["key"]).collect()}
    expect = {}
    for name, days, _ in R.PERIODS:
        for key, ts in rows:
            if days is None or ts.date() >= as_of - dt.timedelta(days=days):
                expect[(name, key)] = expect.get((name, key), 0) + 1
    assert got == expect


def test_top_k_per_group_and_share(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(30)] + [("b", 1, 1.0)], "g string, id int, v double")
    top = R.top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 3)
    assert sorted((r.g, r.id) for r in top.collect()) == [("a", 27), ("a", 28), ("a", 29), ("b", 1)]
    shared = {r.id: r.pct for r in R.share_of_total(df.filter("g = 'b'"), ["g"], "v", "pct").collect()}
    assert shared == {1: 100.0}


def test_thin_points(spark):
    rows = [(n, i) for n in (1, 80, 81, 200) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, i int")
    got = {r.k: r["count"] for r in R.thin_points(df, "k", (F.floor(F.col("i") / 50), F.floor(F.col("i") / 5)), ["i"], 80).groupBy("k").count().collect()}
    assert got == {1: 1, 80: 80, 81: 41, 200: 67}


def test_page_and_conjunction(spark):
    df = spark.range(0, 25)
    assert [r.id for r in R.page(df, [F.col("id")], 3, 10).collect()] == [20, 21, 22, 23, 24]
    assert df.filter(R.conjunction([F.col("id") > 5, None, F.col("id") < 8])).count() == 2


def test_limited_ordered_array_and_one_row(spark):
    df = spark.createDataFrame([("g", 3, "c"), ("g", 1, "a"), ("g", 2, "b"), ("g", 1, "a"), ("h", 5, "z")],
                               "g string, o int, v string")
    got = {r.g: r.top for r in R.limited_ordered_array(df, ["g"], [F.col("o")], F.col("v"), 2, "top").collect()}
    assert got == {"g": ["a", "a"], "h": ["z"]}
    got = {r.g: r.top for r in R.limited_ordered_array(df, ["g"], [F.col("o")], F.col("v"), 2, "top",
                                                       distinct=True).collect()}
    assert got == {"g": ["a", "b"], "h": ["z"]}
    stats = spark.createDataFrame([(9,)], "m int")
    assert [r.m for r in R.with_one_row(df, stats).collect()] == [9] * 5
    assert [r.m for r in R.with_one_row(df, stats.limit(0)).collect()] == [None] * 5


@pytest.fixture(scope="module")
def hot(spark):
    """600,000 rows with a payload column; key 0 holds two thirds, one key is null."""
    i = F.col("id")
    return spark.range(0, 600_000, numPartitions=7).select(
        F.when(i % 3 == 0, F.nullif(i % 7, F.lit(6))).otherwise(F.lit(0)).alias("k"),
        F.timestamp_seconds(F.lit(1_704_067_200) + i * 7919 % 600_011 * 7).alias("ts"), i.alias("id"),
        F.sha2(i.cast("string"), 256).alias("payload"))


@pytest.mark.parametrize("aqe,partitions", [("true", 4), ("false", 16), ("true", 200)])
def test_bucketed_numbers_and_lead_match_windows(spark, hot, aqe, partitions):
    w = Window.partitionBy("k").orderBy("ts", "id")
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = R.bucketed_row_number(hot, ["k"], R.time_buckets(F.col("ts")), ["ts", "id"], "rn", count_col="n")
        got = R.bucketed_lead(got, ["k"], "ts", ["id"], "nxt")
        want = hot.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("k")))
        want = want.withColumn("nxt", F.lead("ts").over(w))
        total = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64(
            "id", F.col("rn").cast("long"), F.col("n").cast("long"), "nxt"))).first()
        assert total(got) == total(want)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_no_window_over_a_key_alone(spark, hot, capsys):
    """Rows are windowed by key and bucket; only one row per bucket is windowed by key."""
    R.bucketed_row_number(hot, ["k"], R.time_buckets(F.col("ts")), ["ts", "id"]).explain()
    plan = capsys.readouterr().out
    assert "monotonically_increasing_id" not in plan and "SPARK_PARTITION_ID" not in plan
    lines = [x for x in plan.splitlines() if "Window [row_number()" in x]
    assert lines and all("_b1" in x and "_b2" in x for x in lines)


