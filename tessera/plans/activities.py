"""Activity queries (P01–P03, P07) re-aimed at the events table.

An activity is a ``purchase`` event lasting ``ACTIVITY_MINUTES`` from its
timestamp; the plays heard during it are the same user's other events
(``track_id = props.k``).  Interval matching uses the bucketed range join
(J06), never a nested loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import (
    duration_to_hms,
    empty_to_null,
    least_strict,
    ms_to_hms,
    ordered_array,
    time_of_day,
)
from tessera.operators.relational import bucketed_lead, global_top_k, interval_join, thin_points, time_buckets
from tessera.plans.star import star_from_events
from tessera.sources.tables import Tables

# Fixed values of the re-aimed activity model
ACTIVITY_TYPE = "purchase"
ACTIVITY_MINUTES = 30
MAX_POLYLINE_POINTS = 80
HR_ZONE_BOUNDS = (50.0, 100.0, 150.0, 200.0)   # value thresholds of zones 1..5
MIN_LISTEN_MS = 30000


def activities(spark: SparkSession, d: str) -> DataFrame:
    ev = Tables(spark, d).events
    return ev.filter(F.col("event_type") == ACTIVITY_TYPE).select(
        F.col("event_id").alias("activity_id"), "user_id",
        F.col("ts").alias("start_ts"),
        (F.col("ts") + F.expr(f"INTERVAL {ACTIVITY_MINUTES} MINUTES")).alias("end_ts"),
        (F.col("value") / 10).alias("distance_km"),
    )


def plays(spark: SparkSession, d: str) -> DataFrame:
    star = star_from_events(spark, d)
    return (
        star.fact.filter(F.col("event_type") != ACTIVITY_TYPE)
        .join(star.tracks.select("track_id", "duration_ms"), "track_id", "left")
        .select("play_id", "played_at", "track_id", F.col("listener_id").alias("user_id"), "duration_ms")
    )


def _pairs(spark: SparkSession, d: str, acts: DataFrame | None = None) -> DataFrame:
    acts = activities(spark, d) if acts is None else acts
    return interval_join(acts, plays(spark, d), "start_ts", "end_ts", "played_at", keys=["user_id"],
                         bucket_seconds=ACTIVITY_MINUTES * 60)


def activity_music(spark: SparkSession, d: str) -> DataFrame:
    """P01/P02 over all activities: plays heard, distinct tracks, music time."""
    acts = activities(spark, d)
    pairs = _pairs(spark, d, acts)
    agg = pairs.groupBy("activity_id").agg(
        F.count(F.lit(1)).alias("plays_heard"),
        F.countDistinct("track_id").alias("distinct_tracks"),
        F.sum("duration_ms").alias("music_ms"),
    )
    return acts.join(agg, "activity_id", "left").select(
        "activity_id", "user_id", "start_ts", "distance_km",
        F.coalesce("plays_heard", F.lit(0)).alias("plays_heard"),
        F.coalesce("distinct_tracks", F.lit(0)).alias("distinct_tracks"),
        F.coalesce("music_ms", F.lit(0)).alias("music_ms"),
        ms_to_hms(F.coalesce("music_ms", F.lit(0))).alias("music_duration"),
        duration_to_hms(F.lit(ACTIVITY_MINUTES * 60)).alias("activity_duration"),
    )


def last_activities_with_music(spark: SparkSession, d: str, k: int = 100) -> DataFrame:
    """The last ``k`` activities (by id) with every play heard during each —
    time, track, credits, album, primary artist — plus distinct tracks, music
    time and readable durations.

    The primary artist comes from a left join whose ON clause carries the
    constant role condition (J04), so tracks without a primary credit keep
    their row.  An activity with no play keeps one entry of nulls, like the
    left-joined model; the track list is returned as text (one
    ``time|track|credits|artist`` item per play, in time order).
    """
    recent = F.broadcast(global_top_k(activities(spark, d), [F.col("activity_id").desc()], k, rank_col=None))  # k rows
    star = star_from_events(spark, d)
    bridge = star.bridge
    tracks = star.tracks.alias("t").join(
        bridge.alias("b"), (F.col("t.track_id") == F.col("b.track_id")) & (F.col("b.artist_role") == "primary"),
        "left").join(star.artists.alias("ar"), F.col("b.artist_id") == F.col("ar.artist_id"), "left").select(
        F.col("t.track_id").alias("track_id"), F.col("t.track_name").alias("track_name"),
        F.col("t.album_id").alias("album_name"), F.col("ar.artist_name").alias("primary_artist"))
    heard = _pairs(spark, d, recent).select("activity_id", "played_at", "track_id", "duration_ms").join(
        tracks, "track_id", "left").join(star.track_artist_names(), "track_id", "left")
    rows = recent.join(heard, "activity_id", "left")
    item = F.concat_ws("|", F.date_format("played_at", "yyyy-MM-dd HH:mm:ss"), F.col("track_name"),
                       F.col("all_artist_names"), F.col("primary_artist"))
    agg = rows.groupBy("activity_id", "user_id", "start_ts", "end_ts", "distance_km").agg(
        F.array_join(ordered_array(item, F.col("played_at")), "; ").alias("tracks_played_during_activity"),
        F.countDistinct("track_id").alias("unique_tracks_count"),
        F.sum("duration_ms").alias("total_music_duration_ms"))
    return agg.select(
        "*", duration_to_hms(F.lit(ACTIVITY_MINUTES * 60)).alias("duration_formatted"),
        ms_to_hms("total_music_duration_ms").alias("music_duration_formatted"))


def recent_activities_with_plays(spark: SparkSession, d: str, k: int = 100) -> DataFrame:
    """The last ``k`` activities, each with its plays as an ordered list (JSON)."""
    recent = global_top_k(activities(spark, d), [F.col("start_ts").desc(), F.col("activity_id").desc()], k,
                          rank_col=None)
    recent = F.broadcast(recent)  # k rows
    pairs = _pairs(spark, d, recent)
    item = F.struct(F.col("played_at").alias("_o"), F.col("play_id").alias("play_id"), F.col("track_id").alias("track_id"))
    lists = pairs.groupBy("activity_id").agg(F.array_sort(F.collect_list(item)).alias("_l"))
    return recent.join(lists, "activity_id", "left").select(
        "activity_id", "user_id", "start_ts",
        F.to_json(empty_to_null(F.transform("_l", lambda x: F.struct(x["play_id"].alias("play_id"),
                                                                      x["track_id"].alias("track_id"))))).alias("plays"),
    )


def listen_with_next(spark: SparkSession, d: str) -> DataFrame:
    """P07 core: real listen time = least(duration, gap to the listener's next play)."""
    star = star_from_events(spark, d)
    fact = star.fact.join(star.tracks.select("track_id", "track_name", "duration_ms"), "track_id")
    with_next = bucketed_lead(fact, ["listener_id"], "played_at", ["play_id"], "next_played_at")
    gap_ms = F.expr("timestampdiff(MILLISECOND, played_at, next_played_at)")
    return with_next.withColumn(
        "real_listen_duration_ms",
        F.when(F.col("next_played_at").isNotNull(), least_strict(F.col("duration_ms"), gap_ms)).otherwise(
            F.col("duration_ms")))


def real_duration_lead(spark: SparkSession, d: str, k: int = 100) -> DataFrame:
    """The last ``k`` plays heard longer than 30 s, with their real listen time."""
    heard = listen_with_next(spark, d).filter(F.col("real_listen_duration_ms") > MIN_LISTEN_MS)
    top = global_top_k(heard, [F.col("played_at").desc(), F.col("play_id").desc()], k, rank_col=None)
    return top.select(
        "played_at", "listener_id", "track_id", "track_name",
        F.to_date("played_at").alias("played_date"), time_of_day("played_at").alias("played_time"),
        "duration_ms", "real_listen_duration_ms")


def real_duration_daily(spark: SparkSession, d: str) -> DataFrame:
    """P07 over the whole log: real listen time per listener and day."""
    heard = listen_with_next(spark, d)
    return heard.groupBy("listener_id", F.to_date("played_at").alias("played_date")).agg(
        F.count(F.lit(1)).alias("plays"),
        F.count_if(F.col("real_listen_duration_ms") > MIN_LISTEN_MS).alias("plays_over_30s"),
        F.sum("real_listen_duration_ms").alias("real_listen_ms"))


def sampled_polyline(spark: SparkSession, d: str) -> DataFrame:
    """Keep every ``ceil(n/80)``-th point of each user's track (≤ ~80 points).

    Numbers and counts are summed over time buckets, so no user's points
    meet in one task or one array.
    """
    ev = Tables(spark, d).events.select("user_id", "event_id", "ts", "value")
    return thin_points(ev, "user_id", time_buckets(F.col("ts")), ["ts", "event_id"], MAX_POLYLINE_POINTS).select(
        "user_id", "point_idx", "ts", "value", "step")


def zone_percentages(spark: SparkSession, d: str) -> DataFrame:
    """Share of each user's points in five value zones (1 decimal)."""
    ev = Tables(spark, d).events
    b = HR_ZONE_BOUNDS
    v = F.col("value")
    zones = [v < b[0], (v >= b[0]) & (v < b[1]), (v >= b[1]) & (v < b[2]), (v >= b[2]) & (v < b[3]), v >= b[3]]
    agg = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(z).alias(f"_z{i + 1}") for i, z in enumerate(zones)])
    return agg.select("user_id", *[
        F.round(F.lit(100.0) * F.col(f"_z{i}") / F.nullif(F.col("_n"), F.lit(0)), 1).alias(f"zone{i}_pct")
        for i in range(1, 6)])


def recent_activities(spark: SparkSession, d: str) -> DataFrame:
    """The recent-activities read (P01 projection)."""
    return recent_activities_with_plays(spark, d)


def activities_list(spark: SparkSession, d: str) -> DataFrame:
    """Every activity with distance, minutes, zone shares of its user."""
    acts = activities(spark, d)
    zones = zone_percentages(spark, d)
    return acts.join(zones, "user_id", "left").withColumn("duration_min", F.lit(float(ACTIVITY_MINUTES)))


def activity_detail(spark: SparkSession, d: str, activity_id: int) -> dict[str, DataFrame]:
    """One activity and all its points in time order (its user's events while it lasts)."""
    act = activities(spark, d).filter(F.col("activity_id") == F.lit(activity_id))
    ev = Tables(spark, d).events.select("user_id", "event_id", "ts", "value")
    span = F.broadcast(act.select(F.col("user_id").alias("_user"), "start_ts", "end_ts"))  # one row
    inside = (F.col("user_id") == F.col("_user")) & F.col("ts").between(F.col("start_ts"), F.col("end_ts"))
    points = ev.join(span, inside).select("user_id", "event_id", "ts", "value").orderBy("ts", "event_id")
    return {"activity": act, "points": points}
