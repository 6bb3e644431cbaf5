"""Music star schema: fact_played, dim_tracks, dim_albums, dim_artists, bridge.

``MusicStar`` is the hub layer the product queries read.  ``star_from_tables``
derives it from the provided TPC-H-style tables so every query's work grows
with the data:

* play fact      ← lineitem: one play per line, ``played_at = l_shipdate``,
                   ``play_id = order * 100 + line`` (a label: (order, line)
                   repeats in the provided data), ``track_id = l_partkey``
* dim_tracks     ← part: name, album (= brand), duration ``p_size * 6000`` ms
* dim_albums     ← distinct brands with their track count
* dim_artists    ← supplier
* bridge         ← distinct (part, supplier) pairs seen in lineitem, position
                   by supplier key, role ``primary`` at position 0 (H02)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import ordered_join
from tessera.sources.tables import Tables

# as_of used with the lineitem-based star: the day after its last ship date
LINEITEM_AS_OF = "2001-11-05"
# as_of used with the events table: the day after its last event
EVENTS_AS_OF = "2024-01-31"


@dataclass
class MusicStar:
    fact: DataFrame      # play_id, played_at, track_id
    tracks: DataFrame    # track_id, track_name, album_id, duration_ms
    albums: DataFrame    # album_id, album_name, total_tracks
    artists: DataFrame   # artist_id, artist_name
    bridge: DataFrame    # track_id, artist_id, artist_position, artist_role
    primary: DataFrame | None = None  # the bridge's primary rows, where they can be had without building it

    def track_artist_names(self) -> DataFrame:
        """H04 ``all_artist_names``: artist names ordered by credit position."""
        return (
            self.bridge.join(self.artists, "artist_id")
            .groupBy("track_id")
            .agg(ordered_join(F.col("artist_name"), ", ", F.col("artist_position")).alias("all_artist_names"))
        )

    def track_artist_ids(self) -> DataFrame:
        """P06 ``artist_ids``: ids ordered by position, as comma text."""
        return self.bridge.groupBy("track_id").agg(
            ordered_join(F.col("artist_id").cast("string"), ",", F.col("artist_position")).alias("artist_ids"))

    def primary_bridge(self) -> DataFrame:
        if self.primary is not None:
            return self.primary
        return self.bridge.filter((F.col("artist_role") == "primary") & F.col("artist_id").isNotNull())


def bridge_from_pairs(pairs: DataFrame, track_col: str, artist_col: str) -> DataFrame:
    """Distinct (track, artist) credits with a 0-based position and role.

    One aggregate builds each track's sorted credit set (deduplicated
    map-side, so a track's many plays shrink to its distinct artists before
    the shuffle); ``posexplode`` turns it back into rows with positions —
    no second shuffle and no window sort.  A credit set is bounded by the
    distinct artists of one track, like the play record's artist list.
    """
    credit_sets = pairs.groupBy(F.col(track_col).alias("track_id")).agg(
        F.array_sort(F.collect_set(F.col(artist_col))).alias("_artists"))
    return credit_sets.select("track_id", F.posexplode("_artists").alias("artist_position", "artist_id")).select(
        "track_id", "artist_id", F.col("artist_position").cast("int").alias("artist_position"),
        F.when(F.col("artist_position") == 0, F.lit("primary")).otherwise(F.lit("featuring")).alias("artist_role"))


def primary_from_pairs(pairs: DataFrame, track_col: str, artist_col: str) -> DataFrame:
    """The primary rows of :func:`bridge_from_pairs`: the smallest artist of a track, by one hash aggregate."""
    first = pairs.groupBy(F.col(track_col).alias("track_id")).agg(F.min(artist_col).alias("artist_id"))
    return first.filter(F.col("artist_id").isNotNull()).select(
        "track_id", "artist_id", F.lit(0).alias("artist_position"), F.lit("primary").alias("artist_role"))


def star_from_tables(spark: SparkSession, sf_dir: str) -> MusicStar:
    t = Tables(spark, sf_dir)
    li = t.lineitem
    fact = li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("play_id"),
        F.col("l_shipdate").alias("played_at"),
        F.col("l_partkey").alias("track_id"),
    )
    part = t.part
    tracks = part.select(
        F.col("p_partkey").alias("track_id"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("album_id"),
        (F.col("p_size").cast("bigint") * 6000).alias("duration_ms"),
    )
    albums = part.groupBy(F.col("p_brand").alias("album_id")).agg(
        F.count(F.lit(1)).alias("total_tracks")).withColumn("album_name", F.col("album_id"))
    artists = t.supplier.select(F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist_name"))
    bridge = bridge_from_pairs(li, "l_partkey", "l_suppkey")
    return MusicStar(fact, tracks, albums, artists, bridge, primary_from_pairs(li, "l_partkey", "l_suppkey"))


def star_from_events(spark: SparkSession, sf_dir: str) -> MusicStar:
    """Sub-second play log: ``events`` as plays (``track_id = props.k``).

    Same dimensions and bridge as :func:`star_from_tables`; used where
    time of day, daily look-backs or gaps between plays matter.
    """
    base = star_from_tables(spark, sf_dir)
    ev = Tables(spark, sf_dir).events
    fact = ev.select(
        F.col("event_id").alias("play_id"),
        F.col("ts").alias("played_at"),
        F.get_json_object("props", "$.k").cast("bigint").alias("track_id"),
        F.col("user_id").alias("listener_id"),
        "event_type",
    )
    return MusicStar(fact, base.tracks, base.albums, base.artists, base.bridge, base.primary)
