"""Documented analytic queries (D14–D46, D22–D25) re-aimed at the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.columns import pct, round_half_up
from tessera.operators.relational import global_top_k, top_k_per_group
from tessera.plans.star import star_from_events, star_from_tables
from tessera.sources.tables import Tables

SAMPLE_SIZE = 3
EDGE_ROWS = 10


def monthly_growth(spark: SparkSession, d: str) -> DataFrame:
    """Items per month, running total and 3-month moving average.

    The window runs over the monthly aggregate — one row per calendar month,
    so its single partition is bounded by the calendar, not by the data.
    """
    li = Tables(spark, d).lineitem
    monthly = li.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("items"))
    w = Window.orderBy("month")
    return monthly.select(
        "month", "items",
        F.sum("items").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_total"),
        round_half_up(F.avg("items").over(w.rowsBetween(-2, 0)), 2).alias("rolling_3"),
    )


def duration_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Tracks by duration bucket, ordered by the bucket's minimum."""
    star = star_from_tables(spark, d)
    ms = F.col("duration_ms")
    bucket = (F.when(ms < 60000, "< 1 min").when(ms < 180000, "1-3 min").when(ms < 300000, "3-5 min")
              .otherwise(">= 5 min"))
    return star.tracks.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("tracks"), F.min("duration_ms").alias("min_ms")).orderBy("min_ms")


def decade_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Orders by decade (and by year, D14) with average value."""
    o = Tables(spark, d).orders
    decade = (F.floor(F.year("o_orderdate") / 10) * 10).cast("int")
    return o.groupBy(decade.alias("decade"), F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("orders"), round_half_up(F.avg("o_totalprice"), 2).alias("avg_price"))


def flagged_share(spark: SparkSession, d: str) -> DataFrame:
    """Per album, the share of plays with the flag set (``R``)."""
    t = Tables(spark, d)
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    agg = j.groupBy(F.col("p_brand").alias("album_id")).agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("l_returnflag") == "R").alias("flagged"))
    return agg.withColumn("flagged_pct", pct("flagged", "items"))


def oldest_newest(spark: SparkSession, d: str) -> DataFrame:
    """The 10 oldest and the 10 newest orders in one result."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    old = global_top_k(o, [F.col("o_orderdate"), F.col("o_orderkey")], EDGE_ROWS, rank_col=None).withColumn(
        "edge", F.lit("oldest"))
    new = global_top_k(o, [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], EDGE_ROWS,
                       rank_col=None).withColumn("edge", F.lit("newest"))
    return old.unionByName(new)


def label_samples(spark: SparkSession, d: str) -> DataFrame:
    """Per album — distinct artists and three sample names.

    Distinct (album, artist) pairs first; the sample is a bounded per-album
    ``row_number() <= 3``, so no album's full artist set is collected.
    """
    t = Tables(spark, d)
    pairs = (
        t.lineitem.select("l_partkey", "l_suppkey")
        .join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.col("p_brand").alias("album_id"), F.col("s_name").alias("artist_name"))
        .distinct()
    )
    counts = pairs.groupBy("album_id").agg(F.count(F.lit(1)).alias("artists"))
    samples = top_k_per_group(pairs, ["album_id"], [F.col("artist_name")], SAMPLE_SIZE, rank_col="_r").groupBy(
        "album_id").agg(F.array_join(F.array_sort(F.collect_list("artist_name")), ", ").alias("sample_artists"))
    return counts.join(samples, "album_id")


def collaborations(spark: SparkSession, d: str) -> DataFrame:
    """Tracks by number of credited artists."""
    star = star_from_tables(spark, d)
    per_track = star.bridge.groupBy("track_id").agg(F.count(F.lit(1)).alias("artists"))
    return per_track.groupBy("artists").agg(F.count(F.lit(1)).alias("tracks"))


def habits_by_hour(spark: SparkSession, d: str) -> DataFrame:
    """Plays by hour of day — count, distinct tracks, distinct listeners."""
    star = star_from_events(spark, d)
    return star.fact.groupBy(F.hour("played_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("plays"), F.countDistinct("track_id").alias("tracks"),
        F.countDistinct("listener_id").alias("listeners"))


def plays_by_context(spark: SparkSession, d: str) -> DataFrame:
    """Plays by context (event type) with distinct listeners and share."""
    ev = Tables(spark, d).events
    per = ev.groupBy(F.col("event_type").alias("context")).agg(
        F.count(F.lit(1)).alias("plays"), F.countDistinct("user_id").alias("listeners"))
    return per.withColumn("share_pct", F.round(F.lit(100.0) * F.col("plays") / F.sum("plays").over(Window.partitionBy()), 1))


def daily_listening(spark: SparkSession, d: str) -> DataFrame:
    """Listening minutes and distinct tracks per day."""
    star = star_from_events(spark, d)
    j = star.fact.join(star.tracks.select("track_id", "duration_ms"), "track_id", "left")
    return j.groupBy(F.to_date("played_at").alias("day")).agg(
        F.count(F.lit(1)).alias("plays"), F.countDistinct("track_id").alias("tracks"),
        round_half_up(F.sum("duration_ms") / 60000, 1).alias("minutes"))


def word_stats(spark: SparkSession, d: str) -> DataFrame:
    """A correlated aggregate over each row's own array (whole texts).

    ``aggregate`` / ``array_max`` over the split words stay inside the row —
    no explode, no shuffle.
    """
    docs = Tables(spark, d).documents
    words = F.split("text", " ")
    lengths = F.transform(words, lambda w: F.length(w))
    return docs.select(
        "doc_id", F.size(words).alias("n_words"),
        F.aggregate(lengths, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("word_chars"),
        F.array_max(lengths).alias("longest_word"))


def long_words(spark: SparkSession, d: str, min_len: int = 12) -> DataFrame:
    """``ARRAY(SELECT w FROM UNNEST(words) WHERE len > n ORDER BY w)`` per document."""
    docs = Tables(spark, d).documents
    picked = F.array_sort(F.filter(F.split("text", " "), lambda w: F.length(w) > min_len))
    return docs.select("doc_id", F.size(picked).alias("n_long"), F.array_join(picked, " ").alias("long_words"))


# ---- recent plays (D20, D21, D23) over the sub-day play log --------------------------

RECENT_AS_OF = "2024-01-31"


def _recent(star, days: int):
    bound = F.date_sub(F.lit(RECENT_AS_OF).cast("date"), days).cast("timestamp_ntz")
    return star.fact.filter(F.col("played_at") >= bound)


def _credit_names(star) -> DataFrame:
    """Per track, its credited artist names sorted by name, as text (bounded by one track's credits)."""
    return star.bridge.join(star.artists, "artist_id").groupBy("track_id").agg(
        F.array_join(F.array_sort(F.collect_list("artist_name")), ", ").alias("artists"))


def recent_plays_with_artists(spark: SparkSession, d: str, days: int = 7) -> DataFrame:
    """Every play of the last ``days`` days with its artists (by name), newest first."""
    from tessera.plans.library import track_popularity

    star = star_from_events(spark, d)
    part = Tables(spark, d).part.select(F.col("p_partkey").alias("track_id"),
                                        track_popularity(F.col("p_partkey"), F.col("p_size")).alias("track_popularity"))
    plays = _recent(star, days).join(star.tracks, "track_id", "left").join(part, "track_id", "left").join(
        _credit_names(star), "track_id", "left")
    return plays.select(
        "played_at", "track_name", F.col("album_id").alias("album_name"), "artists",
        (F.col("duration_ms") / 1000).alias("duration_seconds"), "track_popularity",
    ).orderBy(F.col("played_at").desc())


def most_played_recent(spark: SparkSession, d: str, days: int = 30, k: int = 20) -> DataFrame:
    """Most played tracks of the last ``days`` days with their artists and last play.

    Plays are counted per track first; names are attached to the k ranked rows only.
    """
    star = star_from_events(spark, d)
    per = _recent(star, days).groupBy("track_id").agg(
        F.count(F.lit(1)).alias("play_count"), F.max("played_at").alias("last_played"))
    top = global_top_k(per, [F.col("play_count").desc(), F.col("track_id")], k)
    return top.join(star.tracks, "track_id", "left").join(_credit_names(star), "track_id", "left").select(
        "rank", "track_id", "track_name", F.col("album_id").alias("album_name"), "artists", "play_count",
        "last_played")


def favourite_artists_recent(spark: SparkSession, d: str, days: int = 90, k: int = 20) -> DataFrame:
    """Artists by plays over the last ``days`` days (a play counts for
    every credited artist), distinct tracks and last play.  Per-track totals
    go through the bridge, so the fan-out multiplies tracks, not plays."""
    star = star_from_events(spark, d)
    per_track = _recent(star, days).groupBy("track_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("played_at").alias("last"))
    per_artist = per_track.join(star.bridge.select("track_id", "artist_id"), "track_id").groupBy("artist_id").agg(
        F.sum("n").alias("play_count"), F.count(F.lit(1)).alias("unique_tracks_played"),
        F.max("last").alias("last_played"))
    top = global_top_k(per_artist, [F.col("play_count").desc(), F.col("artist_id")], k)
    return top.join(star.artists, "artist_id", "left").select(
        "rank", "artist_id", "artist_name", "play_count", "unique_tracks_played", "last_played")
