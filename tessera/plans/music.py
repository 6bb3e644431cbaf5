"""Music product queries (P04–P16, P19, P29, P30, P32) over a :class:`MusicStar`.

Plan shape shared by all rankings: aggregate the fact on ``track_id`` first
(map-side partial aggregation, one row per track per task), join dimension
attributes to the aggregate rather than to every play, rank with a literal
``row_number`` bound (partial ``WindowGroupLimit`` below the shuffle), and
look up display attributes only for the ranked rows.  ``count(distinct
played_at)`` in the source models is a row count here: the fact holds one
row per play (a play is a line or an event) and the bridge is distinct on
(track, artist).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import ellipsis, ms_to_hm, ms_to_hms, ordered_array, ordered_join, pct
from tessera.operators.relational import (
    as_date,
    current_streak,
    global_top_k,
    period_limit,
    period_order,
    PERIODS,
    period_rollup,
    share_of_total,
    top_k_per_group,
)
from tessera.plans.star import MusicStar
from tessera.session import scratch_path


def _bounded(df: DataFrame) -> DataFrame:
    """Broadcast a frame whose size is bounded by a ranking limit (k rows per period)."""
    return F.broadcast(df)


def _written(df: DataFrame, name: str) -> DataFrame:
    """A few rows, written to the shared scratch folder and read back: later readers do not compute them again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _track_counts_by_period(star: MusicStar, as_of, periods=PERIODS) -> DataFrame:
    counts = period_rollup(star.fact, "played_at", as_of, ["track_id"], periods=periods)
    return counts.join(star.tracks.select("track_id", "album_id", "duration_ms"), "track_id", "left").withColumn(
        "total_duration_ms", F.col("n") * F.col("duration_ms"))


def top_tracks_by_period(star: MusicStar, as_of, periods=PERIODS) -> DataFrame:
    """Top tracks per look-back period (20, 10 for ``yesterday``)."""
    agg = _track_counts_by_period(star, as_of, periods)
    ranked = top_k_per_group(
        agg, ["period"], [F.col("total_duration_ms").desc(), F.col("track_id")], 20,
        per_group_limit=period_limit())
    ranked = _bounded(ranked.select("period", "rank", "track_id", "total_duration_ms", "n"))
    ids = ranked.select("track_id").distinct()
    bridge = star.bridge.join(F.broadcast(ids), "track_id", "left_semi")
    names = (
        bridge.join(star.artists, "artist_id", "left")
        .groupBy("track_id")
        .agg(
            F.array_join(ordered_array(F.col("artist_name"), F.col("artist_position")), ", ").alias("all_artist_names"),
            F.array_join(ordered_array(F.col("artist_id").cast("string"), F.col("artist_position")), ",").alias("artist_ids"),
        )
    )
    return (
        ranked.join(star.tracks.select("track_id", "track_name"), "track_id", "left")
        .join(names, "track_id", "left")
        .select(
            "rank", "period",
            ellipsis("track_name").alias("track_name"),
            ellipsis("all_artist_names").alias("all_artist_names"),
            ms_to_hms("total_duration_ms").alias("total_duration"),
            "total_duration_ms",
            F.col("n").alias("play_count"),
            "track_id", "artist_ids",
        )
        .orderBy(period_order(), "rank")
    )


def top_artists_by_period(star: MusicStar, as_of, periods=PERIODS) -> DataFrame:
    """Top artists per period; a play counts once for every credited artist."""
    agg = _track_counts_by_period(star, as_of, periods)
    fan = agg.join(star.bridge.select("track_id", "artist_id"), "track_id", "left")
    per_artist = fan.groupBy("period", "artist_id").agg(
        F.sum("total_duration_ms").alias("total_duration_ms"), F.sum("n").alias("play_count"))
    ranked = top_k_per_group(
        per_artist, ["period"], [F.col("total_duration_ms").desc(), F.col("artist_id")], 20,
        per_group_limit=period_limit())
    return (
        _bounded(ranked).join(star.artists, "artist_id", "left")
        .select(
            "rank", "period", ellipsis("artist_name").alias("artist_name"),
            ms_to_hms("total_duration_ms").alias("total_duration"), "total_duration_ms", "play_count", "artist_id",
        )
        .orderBy(period_order(), "rank")
    )


def top_albums_by_period(star: MusicStar, as_of, periods=PERIODS) -> DataFrame:
    """Top albums per period."""
    agg = _track_counts_by_period(star, as_of, periods)
    per_album = agg.groupBy("period", "album_id").agg(
        F.sum("total_duration_ms").alias("total_duration_ms"), F.sum("n").alias("play_count"),
        F.count(F.lit(1)).alias("tracks_played"))
    ranked = top_k_per_group(
        per_album, ["period"], [F.col("total_duration_ms").desc(), F.col("album_id")], 20,
        per_group_limit=period_limit())
    return (
        _bounded(ranked).join(star.albums, "album_id", "left")
        .select(
            "rank", "period", "album_name", ms_to_hms("total_duration_ms").alias("total_duration"),
            "total_duration_ms", "play_count", "tracks_played", "album_id",
        )
        .orderBy(period_order(), "rank")
    )


def _track_totals(star: MusicStar, fact: DataFrame | None = None) -> DataFrame:
    fact = star.fact if fact is None else fact
    counts = fact.groupBy("track_id").agg(F.count(F.lit(1)).alias("play_count"))
    return counts.join(star.tracks, "track_id", "left").withColumn(
        "total_duration_ms", F.col("play_count") * F.col("duration_ms"))


def top_tracks_all_time(star: MusicStar, k: int = 20) -> DataFrame:
    """P10: all-time top tracks by listened time."""
    top = global_top_k(_track_totals(star), [F.col("total_duration_ms").desc(), F.col("track_id")], k)
    ids = top.select("track_id")
    names = star.track_artist_names().join(_bounded(ids), "track_id", "left_semi")
    return top.join(names, "track_id", "left").select(
        "rank", ellipsis("track_name").alias("track_name"), ellipsis("all_artist_names").alias("all_artist_names"),
        ms_to_hms("total_duration_ms").alias("total_duration"), "total_duration_ms", "play_count", "track_id",
    ).orderBy("rank")


def top_tracks_recent(star: MusicStar, as_of, days: int = 7, k: int = 10) -> DataFrame:
    """Top tracks of the last ``days`` days, artist ids in credit order."""
    start = F.date_sub(as_date(as_of), days).cast("timestamp_ntz")
    recent = star.fact.filter(F.col("played_at") >= start)
    top = global_top_k(_track_totals(star, recent), [F.col("total_duration_ms").desc(), F.col("track_id")], k)
    ids = top.select("track_id")
    bridge = star.bridge.join(_bounded(ids), "track_id", "left_semi")
    names = bridge.join(star.artists, "artist_id", "left").groupBy("track_id").agg(
        F.array_join(ordered_array(F.col("artist_name"), F.col("artist_position")), ", ").alias("all_artist_names"),
        F.array_join(ordered_array(F.col("artist_id").cast("string"), F.col("artist_position")), ",").alias("artist_ids"))
    return top.join(names, "track_id", "left").select(
        "rank", ellipsis("track_name").alias("track_name"), ellipsis("all_artist_names").alias("all_artist_names"),
        ms_to_hms("total_duration_ms").alias("total_duration"), "play_count", "track_id", "artist_ids",
    ).orderBy("rank")


def top_artists_recent(star: MusicStar, as_of, days: int = 7, k: int = 10) -> DataFrame:
    """Top primary artists of the last ``days`` days."""
    start = F.date_sub(as_date(as_of), days).cast("timestamp_ntz")
    recent = star.fact.filter(F.col("played_at") >= start)
    per_track = _track_totals(star, recent).select("track_id", "play_count", "total_duration_ms")
    per_artist = per_track.join(star.primary_bridge().select("track_id", "artist_id"), "track_id").groupBy(
        "artist_id").agg(F.sum("total_duration_ms").alias("total_duration_ms"), F.sum("play_count").alias("play_count"))
    top = global_top_k(per_artist, [F.col("total_duration_ms").desc(), F.col("artist_id")], k)
    return top.join(star.artists, "artist_id", "left").select(
        "rank", ellipsis("artist_name").alias("artist_name"), ms_to_hms("total_duration_ms").alias("total_duration"),
        "total_duration_ms", "play_count", "artist_id",
    ).orderBy("rank")


def top_albums_all_time(star: MusicStar, k: int = 20) -> DataFrame:
    """All-time top albums."""
    per_album = _track_totals(star).groupBy("album_id").agg(
        F.sum("total_duration_ms").alias("total_duration_ms"), F.sum("play_count").alias("play_count"))
    top = global_top_k(per_album, [F.col("total_duration_ms").desc(), F.col("album_id")], k)
    return top.join(star.albums, "album_id", "left").select(
        "rank", "album_name", ms_to_hms("total_duration_ms").alias("total_duration"), "total_duration_ms",
        "play_count", "album_id",
    ).orderBy("rank")


def top_artists_with_tracks(star: MusicStar, k: int = 20, tracks_per_artist: int = 10) -> DataFrame:
    """Top artists (grouped with the track credit string, as the model does)
    and each artist's top tracks with their share of the row's time.

    The nested track list is returned as JSON text (``tracks``).
    """
    per_track = _track_totals(star).select("track_id", "track_name", "play_count", "total_duration_ms")
    credits = star.track_artist_names()
    # Dictionary-encode the credit strings: tracks sharing one string share
    # the smallest track id as ``credit_id``, so the big fan-out aggregate
    # groups by two longs instead of (artist, long text); the text is looked
    # up again only for the k ranked rows.
    credit_ids = credits.groupBy("all_artist_names").agg(F.min("track_id").alias("credit_id"))
    track_credit = credits.join(credit_ids, "all_artist_names").select("track_id", "credit_id")
    fan = per_track.join(star.bridge.select("track_id", "artist_id"), "track_id", "left")
    stats = (
        fan.join(track_credit, "track_id", "left")
        .groupBy("artist_id", "credit_id")
        .agg(F.sum("total_duration_ms").alias("total_duration_ms"), F.sum("play_count").alias("play_count"))
    )
    # The k ranked rows are written: what follows reads them, not the fan-out behind them, three times over
    order = [F.col("total_duration_ms").desc(), F.col("artist_id"), F.col("credit_id")]
    ranked = _written(global_top_k(stats, order, k), "top-artists")
    # A credit id is a track with that credit string, so its text is that track's credits: k tracks are read
    chosen = star.bridge.join(_bounded(ranked.select(F.col("credit_id").alias("track_id")).distinct()), "track_id", "left_semi")
    names = chosen.join(star.artists, "artist_id").groupBy(F.col("track_id").alias("credit_id")).agg(
        ordered_join(F.col("artist_name"), ", ", F.col("artist_position")).alias("all_artist_names"))
    top = ranked.join(names, "credit_id", "left")
    mine = star.bridge.select("track_id", "artist_id").join(_bounded(ranked.select("artist_id").distinct()), "artist_id",
                                                            "left_semi")
    artist_tracks = mine.join(per_track, "track_id")
    best = top_k_per_group(
        artist_tracks, ["artist_id"], [F.col("total_duration_ms").desc(), F.col("track_id")], tracks_per_artist,
        rank_col="track_rank")
    rows = top.join(star.artists, "artist_id", "left").join(
        best.select("artist_id", "track_rank", "track_name", F.col("total_duration_ms").alias("track_ms"),
                    F.col("play_count").alias("track_plays")),
        "artist_id", "left")
    item = F.struct(
        F.col("track_rank").alias("rank"),
        F.col("track_name"),
        F.round(F.col("track_ms") / F.col("total_duration_ms") * 100, 1).alias("percentage"),
        ms_to_hm("track_ms").alias("duration"),
        F.col("track_plays").alias("play_count"),
    )
    return (
        rows.groupBy("rank", "artist_id", "artist_name", "all_artist_names", "total_duration_ms", "play_count")
        .agg(F.to_json(ordered_array(item, F.col("track_rank"))).alias("tracks"))
        .select(
            "rank", ellipsis("artist_name").alias("artist_name"), ms_to_hms("total_duration_ms").alias("total_duration"),
            "play_count", "artist_id", "tracks",
        )
        .orderBy("rank")
    )


def _primary_track_stats(star: MusicStar, *extra_keys) -> DataFrame:
    """Plays per (track, extra keys…) joined to the track's primary artist.

    The primary bridge has one row per track, so this join does not fan
    out and per-artist sums/counts of these rows are exact.
    """
    keyed = star.fact
    grouped = keyed.groupBy("track_id", *extra_keys).agg(
        F.count(F.lit(1)).alias("play_count"),
        F.min("played_at").alias("first_played_at"),
        F.max("played_at").alias("last_played_at"),
    )
    return (
        grouped.join(star.primary_bridge().select("track_id", "artist_id"), "track_id")
        .join(star.tracks.select("track_id", "album_id", "duration_ms", "track_name"), "track_id")
        .withColumn("total_duration_ms", F.col("play_count") * F.col("duration_ms"))
    )


def artist_top_tracks(star: MusicStar, k: int = 20) -> DataFrame:
    """Per primary artist, top-k tracks with their share of the artist's time."""
    stats = _primary_track_stats(star)
    shared = share_of_total(stats, ["artist_id"], "total_duration_ms", "pct_of_artist_time")
    ranked = top_k_per_group(shared, ["artist_id"], [F.col("total_duration_ms").desc(), F.col("track_id")], k,
                             rank_col="track_rank")
    return ranked.select(
        "artist_id", "track_rank", "track_id", "track_name", "play_count",
        ms_to_hms("total_duration_ms").alias("total_duration"), "total_duration_ms",
        F.col("first_played_at").cast("string").alias("first_played_at"),
        F.col("last_played_at").cast("string").alias("last_played_at"),
        "pct_of_artist_time",
    ).orderBy("artist_id", "track_rank")


def artist_albums(star: MusicStar) -> DataFrame:
    """Per artist and album — tracks heard, completion %, listen depth."""
    stats = _primary_track_stats(star)
    per_album = stats.groupBy("artist_id", "album_id").agg(
        F.count(F.lit(1)).alias("tracks_heard"),
        F.sum("play_count").alias("total_plays"),
        F.sum("total_duration_ms").alias("total_duration_ms"),
        F.min("first_played_at").alias("first_played_at"),
        F.max("last_played_at").alias("last_played_at"),
    )
    completion = pct("tracks_heard", "total_tracks")
    return (
        per_album.join(star.albums, "album_id")
        .select(
            "artist_id", "album_id", "album_name", "total_tracks", "tracks_heard", "total_plays",
            ms_to_hms("total_duration_ms").alias("total_duration"), "total_duration_ms",
            F.col("first_played_at").cast("string").alias("first_played_at"),
            F.col("last_played_at").cast("string").alias("last_played_at"),
            completion.alias("completion_rate"),
            F.when(completion >= 90, "complete").when(completion >= 50, "partial").otherwise("shallow").alias(
                "listen_depth"),
        )
        .orderBy("artist_id", F.col("total_duration_ms").desc())
    )


def artist_evolution(star: MusicStar) -> DataFrame:
    """Per artist and month — plays, distinct tracks, time."""
    month = F.date_format(F.col("played_at"), "yyyy-MM")
    stats = _primary_track_stats(star, month.alias("year_month"))
    return (
        stats.groupBy("artist_id", "year_month")
        .agg(F.sum("play_count").alias("play_count"), F.count(F.lit(1)).alias("unique_tracks"),
             F.sum("total_duration_ms").alias("total_duration_ms"))
        .withColumn("total_duration", ms_to_hm("total_duration_ms"))
        .orderBy("artist_id", "year_month")
    )


def artist_calendar(star: MusicStar) -> DataFrame:
    """Per artist and day — plays and time."""
    day = F.to_date(F.col("played_at"))
    stats = _primary_track_stats(star, day.alias("listen_date"))
    return (
        stats.groupBy("artist_id", "listen_date")
        .agg(F.sum("play_count").alias("play_count"), F.sum("total_duration_ms").alias("total_duration_ms"))
        .select("artist_id", F.col("listen_date").cast("string").alias("listen_date"), "play_count",
                "total_duration_ms", ms_to_hm("total_duration_ms").alias("total_duration"))
        .orderBy("artist_id", "listen_date")
    )


def artist_heatmap(star: MusicStar) -> DataFrame:
    """Per artist, hour of day × day of week (Sunday = 1)."""
    ts = F.col("played_at")
    stats = _primary_track_stats(
        star, F.hour(ts).alias("hour_of_day"), F.dayofweek(ts).alias("day_of_week"),
        F.date_format(ts, "EEEE").alias("day_name"))
    return (
        stats.groupBy("artist_id", "hour_of_day", "day_of_week", "day_name")
        .agg(F.sum("play_count").alias("play_count"), F.sum("total_duration_ms").alias("total_duration_ms"))
        .orderBy("artist_id", "day_of_week", "hour_of_day")
    )


def artist_overview(star: MusicStar, as_of) -> DataFrame:
    """Per primary artist — totals, discovery, consistency, current streak."""
    day = F.to_date(F.col("played_at"))
    per_track_day = _primary_track_stats(star, day.alias("listen_date"))
    stats = per_track_day.groupBy("artist_id").agg(
        F.sum("play_count").alias("total_plays"),
        F.sum("total_duration_ms").alias("total_duration_ms"),
        F.countDistinct("track_id").alias("unique_tracks"),
        F.countDistinct("album_id").alias("unique_albums"),
        F.min("listen_date").alias("first_played_date"),
        F.max("listen_date").alias("last_played_date"),
        F.countDistinct("listen_date").alias("days_with_listens"),
    )
    artist_days = per_track_day.select("artist_id", F.col("listen_date"))
    streaks = current_streak(artist_days, "artist_id", "listen_date", as_of)
    since = F.datediff(as_date(as_of), F.col("first_played_date"))
    return (
        stats.join(star.artists, "artist_id")
        .join(streaks, "artist_id", "left")
        .select(
            "artist_id", "artist_name", "total_plays",
            ms_to_hms("total_duration_ms").alias("total_duration"), "total_duration_ms",
            "unique_tracks", "unique_albums",
            F.col("first_played_date").cast("string").alias("first_heard"),
            F.col("last_played_date").cast("string").alias("last_heard"),
            "days_with_listens",
            since.alias("days_since_discovery"),
            F.round(F.lit(100.0) * F.col("days_with_listens") / F.nullif(since, F.lit(0)), 1).alias(
                "consistency_score"),
            F.round(F.col("total_plays") / F.nullif(F.col("days_with_listens"), F.lit(0)), 1).alias(
                "avg_plays_per_active_day"),
            F.coalesce(F.col("current_streak"), F.lit(0)).cast("bigint").alias("current_streak"),
        )
    )


def artist_documents(star: MusicStar, as_of) -> DataFrame:
    """One nested document per artist from the six focus views.

    Every part is per-artist bounded (top-20 tracks, albums, calendar days,
    168 heat-map cells, months), so collecting each part per artist is safe.
    """
    from tessera.sources.sinks import entity_documents

    return entity_documents("artist_id", {
        "overview": artist_overview(star, as_of),
        "top_tracks": artist_top_tracks(star),
        "albums": artist_albums(star),
        "calendar": artist_calendar(star),
        "heatmap": artist_heatmap(star),
        "evolution": artist_evolution(star),
    }, order={
        "top_tracks": [F.col("track_rank")], "calendar": [F.col("listen_date")],
        "heatmap": [F.col("day_of_week"), F.col("hour_of_day")], "evolution": [F.col("year_month")],
        "albums": [-F.col("total_duration_ms"), F.col("album_id")],
    })
