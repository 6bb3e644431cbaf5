"""Parameterised read queries (R01–R31) as DataFrame-returning functions.

Search terms and filters are bound as literals, never spliced into SQL
text (F11/F14).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import time_of_day
from tessera.operators.relational import conjunction, global_top_k, page
from tessera.plans import music
from tessera.plans.star import MusicStar

VALID_PERIODS = ("all_time", "last_365_days", "last_30_days", "last_7_days", "yesterday")
MAX_RANK_LIMIT = 100
MAX_PAGE_SIZE = 200
MAX_SEARCH_LIMIT = 200


def _check_period(period: str) -> None:
    if period not in VALID_PERIODS:
        raise ValueError(f"period must be one of {VALID_PERIODS}")


def _check_limit(limit: int, most: int) -> None:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}")


def _periods(period: str):
    """Only the requested period is aggregated (a bounded one prunes the scan)."""
    from tessera.operators.relational import PERIODS

    return tuple(p for p in PERIODS if p[0] == period)


def top_artists(star: MusicStar, as_of, period: str, limit: int = 20) -> DataFrame:
    """R01."""
    _check_period(period)
    _check_limit(limit, MAX_RANK_LIMIT)
    return music.top_artists_by_period(star, as_of, _periods(period)).filter(F.col("rank") <= limit)


def top_tracks(star: MusicStar, as_of, period: str, limit: int = 20) -> DataFrame:
    """R02."""
    _check_period(period)
    _check_limit(limit, MAX_RANK_LIMIT)
    return music.top_tracks_by_period(star, as_of, _periods(period)).filter(F.col("rank") <= limit)


def top_albums(star: MusicStar, as_of, period: str, limit: int = 20) -> DataFrame:
    """R03."""
    _check_period(period)
    _check_limit(limit, MAX_RANK_LIMIT)
    return music.top_albums_by_period(star, as_of, _periods(period)).filter(F.col("rank") <= limit)


def music_rankings(star: MusicStar, as_of, period: str, limit: int = 20) -> dict[str, DataFrame]:
    """The three rankings together."""
    return {
        "artists": top_artists(star, as_of, period, limit),
        "tracks": top_tracks(star, as_of, period, limit),
        "albums": top_albums(star, as_of, period, limit),
    }


def play_log(star: MusicStar) -> DataFrame:
    """Play log with track, album and primary artist (materialisable)."""
    prim = star.primary_bridge().join(star.artists, "artist_id").select("track_id", "artist_id", "artist_name")
    return (
        star.fact.join(star.tracks, "track_id", "left")
        .join(prim, "track_id", "left")
        .select(
            "play_id", "played_at", F.to_date("played_at").alias("played_date"),
            time_of_day("played_at").alias("played_time"), "track_id", "track_name", "album_id", "duration_ms",
            "artist_id", "artist_name")
    )


def _log_filter(start_date=None, end_date=None, artist: str | None = None, time_from: str | None = None,
                time_to: str | None = None):
    def d(x):
        return F.lit(x.isoformat() if isinstance(x, _dt.date) else str(x)).cast("date")

    return conjunction([
        (F.col("played_at") >= d(start_date).cast("timestamp_ntz")) if start_date else None,
        (F.col("played_at") < F.date_add(d(end_date), 1).cast("timestamp_ntz")) if end_date else None,
        F.lower(F.col("artist_name")).contains(F.lower(F.lit(artist))) if artist else None,
        F.col("played_time") >= F.lit(time_from) if time_from else None,
        F.col("played_time") <= F.lit(time_to) if time_to else None,
    ])


def recently_played(star: MusicStar, page_no: int = 1, size: int = 50, start_date=None, end_date=None,
                    artist: str | None = None, time_from: str | None = None,
                    time_to: str | None = None) -> dict[str, DataFrame]:
    """One page of the filtered log, the total, page count (1 when empty) and the facet of all artists.

    ``time_from`` / ``time_to`` (``HH:MM``) compare as text with the time of day.
    """
    if size > MAX_PAGE_SIZE:
        raise ValueError(f"size must be <= {MAX_PAGE_SIZE}")
    log = play_log(star).filter(_log_filter(start_date, end_date, artist, time_from, time_to))
    rows = page(log, [F.col("played_at").desc(), F.col("play_id").desc()], page_no, size)
    total = log.agg(F.count(F.lit(1)).alias("total")).withColumn(
        "pages", F.greatest(F.ceil(F.col("total") / F.lit(size)).cast("bigint"), F.lit(1).cast("bigint")))
    # whatever the page's filters: every artist with a play
    played = star.fact.select("track_id").distinct().join(star.primary_bridge(), "track_id").join(star.artists, "artist_id")
    facet = played.select("artist_name").filter(F.col("artist_name").isNotNull()).distinct()
    return {"rows": rows, "total": total, "artists": facet}


def search_artists(star: MusicStar, search: str | None = None, limit: int = 50) -> DataFrame:
    """Artists whose name contains ``search`` (case-insensitive), by plays."""
    _check_limit(limit, MAX_SEARCH_LIMIT)
    per_track = star.fact.groupBy("track_id").agg(F.count(F.lit(1)).alias("n"))
    per_artist = per_track.join(star.primary_bridge(), "track_id").groupBy("artist_id").agg(
        F.sum("n").alias("play_count"))
    arts = star.artists
    if search:
        arts = arts.filter(F.lower(F.col("artist_name")).contains(F.lower(F.lit(search))))
    joined = arts.join(per_artist, "artist_id")
    return global_top_k(joined, [F.col("play_count").desc(), F.col("artist_id")], limit, rank_col=None)


def artist_profile(star: MusicStar, as_of, artist_id) -> dict[str, DataFrame]:
    """The six focus-artist views filtered to one artist."""
    key = F.col("artist_id") == F.lit(artist_id)
    return {
        "overview": music.artist_overview(star, as_of).filter(key),
        "tracks": music.artist_top_tracks(star).filter(key),
        "albums": music.artist_albums(star).filter(key),
        "calendar": music.artist_calendar(star).filter(key),
        "heatmap": music.artist_heatmap(star).filter(key),
        "evolution": music.artist_evolution(star).filter(key),
    }
