"""Documented reports on the saved library and the album list (D15, D30, D32, D34, D39, D41, D43–D45),
the recent-runs and trend tiles (P22, P31) and the incremental work list (E01).

Saves are counted per track before any attribute is joined, and ranked rows
get their display attributes after the ranking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import ordered_join, round_half_up, weekday_letter
from tessera.operators.relational import as_date, global_top_k, limited_ordered_array, top_k_per_group, with_one_row
from tessera.plans.albums import album_enrichment
from tessera.plans.enrichment import enrichment, played_artists
from tessera.plans.library import _primary, _saves, _with_attributes, saved_albums, track_popularity
from tessera.plans.star import star_from_tables
from tessera.sources.tables import Tables

# Fixed values of the documented reports
EDGE_ROWS, COLLABORATIONS, TOP_ALBUMS, SAMPLE_ARTISTS, SAMPLE_TRACKS = 10, 50, 20, 5, 3
RUN_DAYS, TREND_MONTHS, INCREMENT_DAYS = 7, 6, 7
# as_of of the incremental work list: the library's third week, when artists are still first heard
INCREMENT_AS_OF = "1992-01-20"


def _tracks(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).part.select(
        F.col("p_partkey").alias("track_id"), F.col("p_name").alias("track_name"), F.col("p_brand").alias("album_id"),
        (F.col("p_size").cast("bigint") * 6000).alias("duration_ms"),
        track_popularity(F.col("p_partkey"), F.col("p_size")).alias("popularity"))


def _mean(value: str) -> F.Column:
    """Average over saves of a track attribute, from the saves per track ``n``."""
    return F.sum(F.col(value) * F.col("n")) / F.sum("n")


def explicit_vs_clean(spark: SparkSession, d: str) -> DataFrame:
    """Saves, popularity and minutes by the explicit flag."""
    per = _saves(spark, d).groupBy("explicit", "track_id").agg(F.count(F.lit(1)).alias("n"))
    return per.join(_tracks(spark, d), "track_id").groupBy("explicit").agg(
        F.sum("n").alias("track_count"), round_half_up(_mean("popularity"), 1).alias("avg_popularity"),
        round_half_up(_mean("duration_ms") / 1000 / 60, 1).alias("avg_duration_minutes"))


def saved_collaborations(spark: SparkSession, d: str, k: int = COLLABORATIONS) -> DataFrame:
    """The last ``k`` saves of tracks with more than one credited artist, with all their artists.

    A track has several artists if its smallest and largest differ; the
    credit lists are built for the ranked tracks only.
    """
    t = Tables(spark, d)
    several = t.lineitem.groupBy(F.col("l_partkey").alias("track_id")).agg(
        F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi")).filter("lo < hi").select("track_id")
    order = [F.col(c).desc() for c in ("added_at", "save_id", "track_id", "supplier_id")]
    top = global_top_k(_saves(spark, d).join(several, "track_id", "left_semi"), order, k, rank_col=None)
    ids = F.broadcast(top.select(F.col("track_id").alias("l_partkey")).distinct())  # at most k rows
    credits = (
        t.lineitem.select("l_partkey", "l_suppkey").join(ids, "l_partkey", "left_semi").distinct()
        .join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey")
        .groupBy(F.col("l_partkey").alias("track_id"))
        .agg(ordered_join(F.col("s_name"), ", ", F.col("l_suppkey")).alias("all_artists"),
             F.count(F.lit(1)).alias("artist_count"))
    )
    return top.join(_tracks(spark, d), "track_id").join(credits, "track_id").select(
        "track_name", F.col("album_id").alias("album_name"), "all_artists", "artist_count", "popularity", "added_at")


def release_edges(spark: SparkSession, d: str, k: int = EDGE_ROWS) -> DataFrame:
    """The ``k`` saves with the oldest and the ``k`` with the newest album release."""
    dates = album_enrichment(spark, d).select("album_id", F.col("release_date").alias("_date"))
    dated = (
        _saves(spark, d).join(_tracks(spark, d).select("track_id", "album_id"), "track_id")
        .join(dates, "album_id").filter(F.col("_date").isNotNull()).drop("album_id")
    )
    ties = ["save_id", "track_id", "supplier_id"]
    old = global_top_k(dated, [F.col("_date"), *map(F.col, ties)], k, rank_col=None)
    new = global_top_k(dated, [F.col("_date").desc(), *[F.col(c).desc() for c in ties]], k, rank_col=None)
    both = old.withColumn("category", F.lit("Oldest")).unionByName(new.withColumn("category", F.lit("Newest")))
    return _with_attributes(spark, d, both.drop("_date"), star_from_tables(spark, d)).select(
        "category", "track_name", F.col("primary_artist").alias("artist"), "album_name", "album_release_date", "added_at")


def saves_by_decade(spark: SparkSession, d: str) -> DataFrame:
    """Saves per release decade with distinct albums and primary artists."""
    per = _saves(spark, d).groupBy("track_id").agg(F.count(F.lit(1)).alias("n"))
    dates = album_enrichment(spark, d).select("album_id", "release_date").filter(F.col("release_date").isNotNull())
    primary = star_from_tables(spark, d).primary_bridge().select("track_id", "artist_id")
    rows = per.join(_tracks(spark, d), "track_id").join(dates, "album_id").join(primary, "track_id", "left")
    decade = (F.floor(F.substring("release_date", 1, 4).cast("int") / 10) * 10).cast("int")
    return rows.groupBy(decade.alias("decade")).agg(
        F.sum("n").alias("track_count"), F.countDistinct("album_id").alias("unique_albums"),
        F.countDistinct("artist_id").alias("unique_artists"), round_half_up(_mean("popularity"), 1).alias("avg_popularity"))


def saved_durations(spark: SparkSession, d: str) -> DataFrame:
    """Saves per duration range, with the most popular saved tracks of each as a sample."""
    ms = F.col("duration_ms")
    # Range labels and bounds
    ranges = F.when(ms < 120000, "< 2 min").when(ms < 180000, "2-3 min").when(ms < 240000, "3-4 min").when(
        ms < 300000, "4-5 min").when(ms < 360000, "5-6 min").otherwise("> 6 min")
    tracks = _tracks(spark, d).withColumn("duration_range", ranges)
    per = _saves(spark, d).groupBy("track_id").agg(F.count(F.lit(1)).alias("n")).join(tracks, "track_id")
    totals = per.groupBy("duration_range").agg(
        F.sum("n").alias("track_count"), round_half_up(_mean("popularity"), 1).alias("avg_popularity"),
        F.min("duration_ms").alias("min_ms"))
    # a track saved n times stands n times in the sample; three tracks a range are enough to fill it
    best = top_k_per_group(per, ["duration_range"], [F.col("popularity").desc(), F.col("track_id")], SAMPLE_TRACKS,
                           rank_col="r")
    copies = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(SAMPLE_TRACKS)).cast("int"))))
    sample = copies.groupBy("duration_range").agg(F.array_join(F.transform(
        F.slice(F.array_sort(F.collect_list(F.struct("r", "copy", "track_name"))), 1, SAMPLE_TRACKS),
        lambda x: x["track_name"]), "; ").alias("sample_tracks"))
    return totals.join(sample, "duration_range")


def labels_with_artists(spark: SparkSession, d: str, k: int = TOP_ALBUMS) -> DataFrame:
    """Labels by saved albums, with up to five of their primary artists (the first by name)."""
    a = saved_albums(spark, d, track_details=False).filter(F.col("label").isNotNull()).select(
        "label", "popularity", _primary("album_artists").alias("artist"))
    per = a.groupBy("label").agg(F.count(F.lit(1)).alias("album_count"),
                                 round_half_up(F.avg("popularity"), 1).alias("avg_popularity"))
    top = global_top_k(per, [F.col("album_count").desc(), F.col("label")], k, rank_col=None)
    sample = limited_ordered_array(a, ["label"], [F.col("artist")], F.col("artist"), SAMPLE_ARTISTS, "names", distinct=True)
    return top.join(sample.select("label", F.array_join("names", ", ").alias("sample_artists")), "label")


def explicit_albums(spark: SparkSession, d: str, k: int = TOP_ALBUMS) -> DataFrame:
    """Saved albums with explicit tracks, by the share of these."""
    t = Tables(spark, d)
    per = t.lineitem.groupBy(F.col("l_orderkey").alias("album_id")).agg(
        F.count_if(F.col("l_returnflag") == "R").alias("explicit_tracks"), F.count(F.lit(1)).alias("total_tracks"),
        F.min(F.struct("l_linenumber", "l_suppkey", "l_partkey"))["l_suppkey"].alias("s_suppkey"))
    per = per.filter("explicit_tracks > 0").withColumn(
        "pct_explicit", round_half_up(F.col("explicit_tracks") * 100.0 / F.col("total_tracks"), 1))
    top = global_top_k(per, [F.col("pct_explicit").desc(), F.col("album_id")], k, rank_col=None)
    return top.join(t.supplier.select("s_suppkey", F.col("s_name").alias("primary_artist")), "s_suppkey", "left").select(
        F.concat(F.lit("Album #"), F.col("album_id").cast("string")).alias("album_name"), "primary_artist",
        "explicit_tracks", "total_tracks", "pct_explicit")


def album_minutes_by_year(spark: SparkSession, d: str) -> DataFrame:
    """Average album minutes and track seconds per release year.

    The aggregate over an album's own tracks is one aggregate per order, on
    the key its join uses.
    """
    t = Tables(spark, d)
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(
        _tracks(spark, d).select(F.col("track_id").alias("l_partkey"), "duration_ms"), "l_partkey")
    per = lines.groupBy("l_orderkey").agg(F.sum("duration_ms").alias("total"), F.avg("duration_ms").alias("mean"))
    release = F.date_sub(F.to_date("o_orderdate"), F.pmod(F.col("o_custkey"), F.lit(3650)).cast("int"))
    albums = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.year(release).alias("release_year"))
    return albums.join(per, "l_orderkey").groupBy("release_year").agg(
        F.count(F.lit(1)).alias("album_count"), round_half_up(F.avg("total") / 1000 / 60, 1).alias("avg_album_minutes"),
        round_half_up(F.avg("mean") / 1000, 1).alias("avg_track_seconds"))


def collaborative_albums(spark: SparkSession, d: str, k: int = TOP_ALBUMS) -> DataFrame:
    """The most popular albums with several artists."""
    a = saved_albums(spark, d, track_details=False).withColumn("artist_count", F.size("album_artists"))
    top = global_top_k(a.filter("artist_count > 1"), [F.col("popularity").desc(), F.col("album_id")], k, rank_col=None)
    return top.select("album_name", "album_type", "popularity", "release_date", "artist_count", F.array_join(
        F.array_sort(F.transform("album_artists", lambda x: x["artist_name"])), ", ").alias("artists"))


def runs_last_week(spark: SparkSession, d: str, as_of) -> DataFrame:
    """Runs per day of the last 7 days — km, summed aerobic and anaerobic effect, weekday letter.

    Effects are re-aimed at the event's value; the anaerobic one is missing below 150.
    """
    ev = Tables(spark, d).events.filter(F.col("event_type") == "purchase")
    runs = ev.filter(F.col("ts") >= F.date_sub(as_date(as_of), RUN_DAYS).cast("timestamp_ntz"))
    anaerobic = F.when(F.col("value") >= 150, F.col("value") / 50 - 3)
    return runs.groupBy(F.to_date("ts").alias("date")).agg(
        round_half_up(F.sum(F.col("value") / 10), 2).alias("total_distance_km"),
        round_half_up(F.sum(F.coalesce(F.col("value") / 100, F.lit(0.0))), 1).alias("aerobic_score"),
        round_half_up(F.sum(F.coalesce(anaerobic, F.lit(0.0))), 1).alias("anaerobic_score"),
    ).withColumn("day_of_week", weekday_letter("date"))


def trend_with_weeks(spark: SparkSession, d: str, as_of, months: int = TREND_MONTHS) -> DataFrame:
    """One row — the current value, the weekly averages in order, and the change since the first
    value at or before ``months`` ago (0 when there is none: left join on a constant key)."""
    start = F.add_months(as_date(as_of), -months)
    ev = Tables(spark, d).events.filter((F.col("event_type") == "signup") & (F.col("ts") >= start.cast("timestamp_ntz")))
    daily = ev.groupBy(F.to_date("ts").alias("date")).agg(F.avg("value").alias("v"))
    now = daily.agg(F.max("date").alias("current_date"), F.max_by("v", "date").alias("_now"))
    past = daily.filter(F.col("date") <= start).agg(F.min_by("v", "date").alias("_past"))
    weekly = daily.groupBy(F.to_date(F.date_trunc("week", "date")).alias("week")).agg(F.avg("v").alias("w"))
    weeks = weekly.agg(F.array_sort(F.collect_list(F.struct("week", round_half_up("w", 2).alias("w")))).alias("_weeks"))
    row = with_one_row(with_one_row(now.filter("current_date is not null"), weeks), past)
    return row.select(
        "current_date", round_half_up("_now", 2).alias("current_value"),
        F.to_json(F.transform("_weeks", lambda x: x["w"])).alias("weekly_array"),
        round_half_up(F.col("_now") - F.coalesce("_past", "_now"), 2).alias("delta"))


def artists_lacking_enrichment_recent(spark: SparkSession, d: str, as_of=INCREMENT_AS_OF,
                                      table_exists: bool = True) -> DataFrame:
    """E01 incremental mode: artists first played in the last 7 days without an enrichment row
    (all of them while there is no enrichment table yet)."""
    played = played_artists(star_from_tables(spark, d)).filter(
        F.col("first_played_at") >= F.date_sub(as_date(as_of), INCREMENT_DAYS).cast("timestamp_ntz"))
    if not table_exists:
        return played
    return played.join(enrichment(spark, d, gaps=True).select("artist_id"), "artist_id", "left_anti")
