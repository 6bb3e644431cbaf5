"""Hub layer (H01–H06): fact, bridges and dimensions built from the nested
play log (one row per play carrying its track, album and ``artists`` array).

Plans avoid exploding every play: plays are first grouped by their
(track, credit list) — identical credit lists collapse map-side — and only
those groups are unnested.  No plan sorts or shuffles plays with their credit
lists: the latest play is found by its numbers, and only latest rows keep lists.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.keep import keep_latest
from tessera.plans.star import star_from_tables
from tessera.sources.tables import Tables

# Lineitem bytes whose credit lists one task holds; a list is many times larger than the keys it is made of
CREDIT_BYTES = 4 << 20


def play_log_from_tables(spark: SparkSession, d: str) -> DataFrame:
    """A nested play log derived from the provided tables (lake ``recently_played`` shape).

    Each lineitem is a play of its part; the play carries the part's credit
    list (suppliers ordered by credit position) as ``artists`` and
    ``albumArtists``.  ``_dp_inserted_at`` is the day after the play.
    """
    star = star_from_tables(spark, d)
    # a stated number of partitions, by the input's size: by the size of the keys, few tasks would hold all the lists
    tasks = max(8, Tables(spark, d).bytes_of("lineitem") // CREDIT_BYTES)
    credits = (
        star.bridge.join(star.artists, "artist_id")
        .repartition(tasks, "track_id")
        .groupBy("track_id")
        .agg(F.transform(
            F.array_sort(F.collect_list(F.struct("artist_position", F.col("artist_id").alias("artistId"),
                                                 F.col("artist_name").alias("artistName")))),
            lambda x: F.struct(x["artistId"].alias("artistId"), x["artistName"].alias("artistName"))).alias("artists"))
    )
    li = Tables(spark, d).lineitem
    part = Tables(spark, d).part
    # every value is made below the join to the lists, so that a filter on plays is applied before plays get lists
    plays = li.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("play_id"),
        F.col("l_shipdate").alias("playedAt"),
        F.col("l_partkey").alias("trackId"),
        F.col("p_name").alias("trackName"),
        (F.col("p_size").cast("bigint") * 6000).alias("trackDurationMs"),
        F.col("p_brand").alias("albumId"),
        F.col("p_brand").alias("albumName"),
        F.date_add(F.to_date("l_shipdate"), 1).cast("timestamp_ntz").alias("_dp_inserted_at"),
    )
    return plays.join(credits, F.col("trackId") == F.col("track_id"), "left").select(
        "play_id", "playedAt", "trackId", "trackName", "trackDurationMs", "albumId", "albumName", "artists",
        F.col("artists").alias("albumArtists"), "_dp_inserted_at")


def fact_played(log: DataFrame) -> DataFrame:
    """The play fact projection."""
    return log.select("play_id", "playedAt", "trackId", "_dp_inserted_at")


def _play_order() -> Column:
    """(playedAt, play_id) as one number in the same order, nulls first.

    The greatest number is found by a hash aggregate, the greatest struct only by sorting whole rows.
    """
    at = F.unix_micros(F.col("playedAt").cast("timestamp")) + F.lit(62_135_596_800_000_001)  # from 1 for the year 1
    number = F.col("play_id").cast("decimal(20,0)") + F.lit(Decimal(2**63 + 1))
    zero = F.lit(0)
    return (F.coalesce(at, zero).cast("decimal(18,0)") * F.lit(Decimal(10**20))
            + F.coalesce(number, zero).cast("decimal(20,0)")).cast("decimal(38,0)")


def _credit_groups(log: DataFrame, key: str, list_col: str) -> DataFrame:
    """Plays grouped by (key, credit list): counts, time, first/last, latest play."""
    return log.groupBy(key, list_col).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("trackDurationMs").alias("_ms"),
        F.min("playedAt").alias("_first"),
        F.max("playedAt").alias("_last"),
        F.max(_play_order()).alias("_latest"),
    )


def _stats_and_latest(log: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Play stats per key, and each key's latest play with all its columns.

    Plays meet their key's latest number without their credit lists; the few that stay are all that has lists.
    """
    stats = log.groupBy(key).agg(
        F.count(F.lit(1)).alias("play_count"), F.sum("trackDurationMs").alias("total_listen_duration"),
        F.min("playedAt").alias("first_played_at"), F.max("playedAt").alias("last_played_at"))
    marks = log.groupBy(F.col(key).alias("_mk")).agg(F.max(_play_order()).alias("_mark"))
    last = log.join(marks, F.col(key).eqNullSafe(F.col("_mk")) & (_play_order() == F.col("_mark")), "left_semi")
    return stats, keep_latest(last, [key], [F.col("playedAt").desc()], [F.col("play_id").desc()])


def bridge_tracks_artists(log: DataFrame) -> DataFrame:
    """(track, artist) with the lowest credit position and its role (§7.4 #10)."""
    groups = log.select("trackId", "artists").distinct()
    ex = groups.select("trackId", F.posexplode("artists").alias("pos", "a"))
    return ex.groupBy(F.col("trackId").alias("track_id"), F.col("a.artistId").alias("artist_id")).agg(
        F.min("pos").cast("int").alias("artist_position")).withColumn(
        "artist_role", F.when(F.col("artist_position") == 0, "primary").otherwise("featuring"))


def bridge_albums_artists(log: DataFrame) -> DataFrame:
    """Distinct (album, artist)."""
    groups = log.select("albumId", "albumArtists").distinct()
    return groups.select(F.col("albumId").alias("album_id"),
                         F.explode("albumArtists").alias("a")).select("album_id", F.col("a.artistId").alias("artist_id")).distinct()


def dim_tracks(log: DataFrame) -> DataFrame:
    """Latest attributes + play stats + credit names in position order."""
    stats, latest = _stats_and_latest(log, "trackId")
    return (
        latest.filter(F.size("artists") > 0)
        .join(stats, "trackId", "left")
        .select(
            F.col("trackId").alias("track_id"), F.col("trackName").alias("track_name"),
            F.col("trackDurationMs").alias("duration_ms"), F.col("albumId").alias("album_id"),
            "play_count", "total_listen_duration", "first_played_at", "last_played_at",
            F.array_join(F.transform("artists", lambda a: a["artistName"]), ", ").alias("all_artist_names"),
        )
    )


def dim_albums(log: DataFrame) -> DataFrame:
    """The same on albums (album credit list)."""
    stats, latest = _stats_and_latest(log, "albumId")
    return (
        latest.filter(F.size("albumArtists") > 0)
        .join(stats, "albumId", "left")
        .select(
            F.col("albumId").alias("album_id"), F.col("albumName").alias("album_name"),
            "play_count", "total_listen_duration", "first_played_at", "last_played_at",
            F.array_join(F.transform("albumArtists", lambda a: a["artistName"]), ", ").alias("all_artist_names"),
        )
    )


def dim_artists(log: DataFrame, enrichment: DataFrame | None = None) -> DataFrame:
    """Per artist — stats over unnested plays, latest name, enrichment.

    Plays collapse to (track, credit list) groups before the unnest, so the
    exploded volume is groups × credits, not plays × credits.
    """
    groups = _credit_groups(log, "trackId", "artists")
    ex = groups.select("_n", "_ms", "_first", "_last", "_latest", F.explode("artists").alias("a"))
    # numbers only, so by hashing; an artist has few names
    named = ex.groupBy(F.col("a.artistId").alias("artist_id"), F.col("a.artistName").alias("_name")).agg(
        F.sum("_n").alias("_n"), F.sum("_ms").alias("_ms"), F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        F.max("_latest").alias("_latest"))
    per = named.groupBy("artist_id").agg(
        F.sum("_n").alias("play_count"), F.sum("_ms").alias("total_listen_duration"),
        F.min("_first").alias("first_played_at"), F.max("_last").alias("last_played_at"),
        F.max_by("_name", "_latest").alias("artist_name"))
    if enrichment is not None:
        per = per.join(enrichment, "artist_id", "left")
    return per


def hub_dim_artists(spark: SparkSession, d: str) -> DataFrame:
    from tessera.plans.enrichment import enrichment

    e = enrichment(spark, d).select("artist_id", "genre", "popularity", "followers")
    return dim_artists(play_log_from_tables(spark, d), e)
