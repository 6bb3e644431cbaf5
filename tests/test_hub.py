import re

from pyspark.sql import functions as F

from tessera.plans import hub, library

LOG = ("play_id long, playedAt string, trackId long, trackName string, trackDurationMs long, albumId string, "
       "albumName string, artists array<struct<artistId:long,artistName:string>>")


def _log(spark):
    a, b, old = (1, "A"), (2, "B"), (2, "B before")
    rows = [(10, "2024-01-01 10:00:00", 1, "one", 1000, "x", "X", [a, old]),
            (12, "2024-01-02 10:00:00", 1, "one again", 1000, "x", "X", [a]),
            (11, "2024-01-02 10:00:00", 1, "one", 1000, "x", "X", [b]),
            (-5, None, 2, "two", 500, None, "N", [b]), (-7, None, 2, "two less", 500, None, "N", [a]),
            (13, "2024-01-03 10:00:00", 3, "three", 100, "x", "X", [])]
    log = spark.createDataFrame(rows, LOG).withColumn("playedAt", F.col("playedAt").cast("timestamp_ntz"))
    return log.withColumn("albumArtists", F.col("artists"))


def test_play_order_is_the_order_of_time_then_id(spark):
    times = [None, "0001-01-01 00:00:00", "1969-12-31 23:59:59.999999", "2024-01-01 00:00:00", "9999-12-31 23:59:59.999999"]
    ids = [None, -(2**63), -1, 0, 2**63 - 1]
    df = spark.createDataFrame([(t, i) for t in times for i in ids], "playedAt string, play_id long").withColumn(
        "playedAt", F.col("playedAt").cast("timestamp_ntz")).withColumn("n", hub._play_order())
    by_number = [(r.playedAt, r.play_id) for r in df.orderBy("n").collect()]
    assert by_number == [(r.playedAt, r.play_id) for r in df.orderBy("playedAt", "play_id").collect()]
    assert df.select("n").distinct().count() == 25


def test_latest_rows_and_stats(spark):
    tracks = {r.track_id: r for r in hub.dim_tracks(_log(spark)).collect()}
    assert set(tracks) == {1, 2}  # the third has no credits
    assert (tracks[1].track_name, tracks[1].play_count, tracks[1].all_artist_names) == ("one again", 3, "A")
    assert (tracks[2].track_name, tracks[2].total_listen_duration) == ("two", 1000)
    albums = {r.album_id: r for r in hub.dim_albums(_log(spark)).collect()}
    assert set(albums) == {None} and albums[None].play_count is None  # the latest play of x has no credits
    artists = {r.artist_id: r for r in hub.dim_artists(_log(spark)).collect()}
    assert (artists[2].artist_name, artists[2].play_count) == ("B", 3) and artists[1].play_count == 3


def _tables(spark, d):
    lines = [(1, 10, 1, 1), (1, 10, 2, 2), (1, 11, 1, 3), (2, 10, 3, 1), (2, 12, 3, 2), (3, 11, 2, 1), (3, 10, 1, 2), (4, 11, 1, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").withColumn(
        "l_shipdate", F.expr("timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(l_linenumber)")).write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(10, "same", "b", 1), (11, "same", "b", 1), (12, "other", "c", 1)],
                          "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{d}/part.parquet")
    spark.createDataFrame([(i, f"s{i}") for i in (1, 2, 3)], "s_suppkey long, s_name string").write.parquet(f"{d}/supplier.parquet")
    spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "o_orderkey long").write.parquet(f"{d}/orders.parquet")


def test_plays_get_credit_lists_after_the_latest_are_chosen(spark, tmp_path):
    _tables(spark, tmp_path)
    log = hub.play_log_from_tables(spark, str(tmp_path))
    plan = hub.dim_tracks(log)._jdf.queryExecution().optimizedPlan().toString()
    depth = lambda part: re.search(rf"^([^A-Za-z]*)Join {part}", plan, re.M).end(1)
    lists = [m.end(1) for m in re.finditer(r"^([^A-Za-z]*)Join LeftOuter, \(trackId", plan, re.M)]
    assert lists and depth("LeftSemi") > min(lists)  # the semi join stands below the join to the lists
    physical = hub.dim_artists(log)._jdf.queryExecution().sparkPlan().toString()
    assert physical.count("SortAggregate") <= 2 and "max(struct" not in physical  # names of few rows only
    assert "RepartitionByExpression [track_id" in hub.bridge_tracks_artists(log)._jdf.queryExecution().optimizedPlan().toString()


def test_album_artists_of_one_and_of_several_lines(spark, tmp_path):
    _tables(spark, tmp_path)
    df = library.track_vs_album_artists(spark, str(tmp_path))
    rows = {(r.album_name, r.track_name): (r.album_artist, r.track_artists) for r in df.collect()}
    assert rows == {("Album #1", "same"): ("s1", "s1, s1, s1, s2, s2, s2, s3, s3"), ("Album #2", "same"): ("s3", "s1, s2, s3"),
                    ("Album #3", "same"): ("s2", "s1, s1, s2, s2, s3"), ("Album #4", "same"): ("s1", "s1, s2")}
    assert "flatten(collect_list(_ids" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert "size(_ids" in df._jdf.queryExecution().optimizedPlan().toString()  # lines are gathered by id, not with names
