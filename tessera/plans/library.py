"""The saved library: saved tracks (D36–D42) and saved albums with nested
tracks (D26–D35), re-aimed at the provided tables.

* saved track ← one ``lineitem`` row: ``added_at = l_shipdate + l_linenumber
  hours``, the track is the part, ``explicit = (l_returnflag = 'R')``.
* saved album ← one ``orders`` row with its lines nested as ``tracks``
  (each with its credited artists), the distinct line suppliers as
  ``album_artists`` and two copyright lines.

Every query reads the whole tables; per-entity arrays are bounded by one
order's lines or one track's credits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import first_elem, ordered_array, regexp_extract_or_null, round_half_up
from tessera.operators.relational import global_top_k, limited_ordered_array
from tessera.plans.albums import album_enrichment
from tessera.plans.hub import CREDIT_BYTES
from tessera.plans.star import MusicStar, star_from_tables
from tessera.sources.tables import Tables

# Fixed values of the re-aimed library
SAVED_SINCE = "2000-01-01"     # the documented ``addedAt >= …`` filters, as a bound literal
MIN_SAVED_PER_ALBUM = 3        # D40 HAVING


def track_popularity(track_id: F.Column, size: F.Column) -> F.Column:
    return F.pmod(size * 3 + track_id, F.lit(101)).cast("int")


def _saves(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).lineitem.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("save_id"),
        (F.col("l_shipdate") + F.make_interval(hours=F.col("l_linenumber"))).alias("added_at"),
        F.col("l_partkey").alias("track_id"),
        F.col("l_suppkey").alias("supplier_id"),
        (F.col("l_returnflag") == "R").alias("explicit"),
    )


def _with_attributes(spark: SparkSession, d: str, saves: DataFrame, star: MusicStar) -> DataFrame:
    """Attach track, album and primary-artist attributes (dimension joins only)."""
    tracks = Tables(spark, d).part.select(
        F.col("p_partkey").alias("track_id"), F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("album_id"), (F.col("p_size").cast("bigint") * 6000).alias("duration_ms"),
        track_popularity(F.col("p_partkey"), F.col("p_size")).alias("popularity"))
    primary = star.primary_bridge().join(star.artists, "artist_id").select(
        "track_id", F.col("artist_id").alias("primary_artist_id"), F.col("artist_name").alias("primary_artist"))
    albums = star.albums.select("album_id", "album_name", F.col("total_tracks").alias("album_total_tracks")).join(
        album_enrichment(spark, d).select("album_id", F.col("release_date").alias("album_release_date"),
                                          "album_type"), "album_id", "left")
    return saves.join(tracks, "track_id", "left").join(primary, "track_id", "left").join(albums, "album_id", "left")


def saved_tracks(spark: SparkSession, d: str, star: MusicStar | None = None) -> DataFrame:
    """One row per saved track with its track, album and primary-artist attributes.

    The fact is joined to dimensions only (part, album enrichment, the
    primary credit): no fact-to-fact join.
    """
    return _with_attributes(spark, d, _saves(spark, d), star or star_from_tables(spark, d))


def recently_saved_tracks(spark: SparkSession, d: str, k: int = 50) -> DataFrame:
    """The last ``k`` saved tracks."""
    # rank the bare saves first (a per-task top-k), then join attributes to k rows
    # (order, line) repeats in the data: the track and supplier complete the order
    order = [F.col("added_at").desc(), F.col("save_id").desc(), F.col("track_id").desc(), F.col("supplier_id").desc()]
    top = global_top_k(_saves(spark, d), order, k)
    top = _with_attributes(spark, d, top, star_from_tables(spark, d))
    return top.select("rank", "added_at", "track_name", "primary_artist", "album_name", "album_release_date",
                      "popularity", round_half_up(F.col("duration_ms") / 1000.0 / 60, 2).alias("duration_minutes"))


def top_saved_artists(spark: SparkSession, d: str, since: str = SAVED_SINCE, k: int = 20) -> DataFrame:
    """Every credited artist of saved tracks since ``since`` (a save
    counts once per artist), top ``k`` by saves.  Saves are counted per track
    first, so the fan-out through the credits multiplies tracks, not rows."""
    star = star_from_tables(spark, d)
    st = saved_tracks(spark, d, star).filter(F.col("added_at") >= F.lit(since).cast("timestamp_ntz"))
    per_track = st.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("popularity").alias("pop"), F.sum("duration_ms").alias("ms"))
    fan = per_track.join(star.bridge.select("track_id", "artist_id"), "track_id").join(star.artists, "artist_id")
    per_artist = fan.groupBy("artist_name").agg(
        F.sum("n").alias("tracks_saved"), F.sum("pop").alias("_pop"), F.sum("ms").alias("_ms"))
    top = global_top_k(per_artist, [F.col("tracks_saved").desc(), F.col("artist_name")], k)
    return top.select("rank", "artist_name", "tracks_saved",
                      round_half_up(F.col("_pop") / F.col("tracks_saved"), 2).alias("avg_popularity"),
                      round_half_up(F.col("_ms") / 1000 / 60, 2).alias("total_minutes"))


def saved_tracks_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Saves per month — distinct primary artists, explicit count."""
    st = saved_tracks(spark, d)
    return st.groupBy(F.to_date(F.date_trunc("month", "added_at")).alias("month")).agg(
        F.count(F.lit(1)).alias("tracks_saved"), F.countDistinct("primary_artist_id").alias("unique_artists"),
        F.count_if(F.col("explicit")).alias("explicit_tracks"),
        round_half_up(F.avg("popularity"), 1).alias("avg_popularity"))


def albums_by_share_saved(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    """Albums (with the primary artist) by saved tracks,
    the share of the album saved, first and last save; at least 3 saves."""
    st = saved_tracks(spark, d)
    g = st.groupBy("album_name", "primary_artist", "album_total_tracks").agg(
        F.count(F.lit(1)).alias("tracks_saved"), F.min("added_at").alias("first_track_saved"),
        F.max("added_at").alias("last_track_saved"))
    g = g.filter(F.col("tracks_saved") >= MIN_SAVED_PER_ALBUM).withColumn(
        "pct_album_saved", round_half_up(F.col("tracks_saved") * 100.0 / F.col("album_total_tracks"), 1))
    top = global_top_k(g, [F.col("tracks_saved").desc(), F.col("album_name"), F.col("primary_artist")], k)
    return top.select("rank", "album_name", "primary_artist", "tracks_saved", "album_total_tracks",
                      "pct_album_saved", "first_track_saved", "last_track_saved")


def saved_by_album_type(spark: SparkSession, d: str) -> DataFrame:
    """Saved tracks per album type (null type = album not enriched)."""
    st = saved_tracks(spark, d)
    return st.groupBy("album_type").agg(
        F.count(F.lit(1)).alias("track_count"), F.countDistinct("album_id").alias("unique_albums"),
        round_half_up(F.avg("popularity"), 1).alias("avg_popularity"),
        round_half_up(F.avg("duration_ms") / 1000 / 60, 1).alias("avg_track_minutes"))


# ---- saved albums with nested tracks (D26–D35) ---------------------------------------

def _track_credits(star: MusicStar) -> DataFrame:
    """Per track, its credited artists in position order (bounded by one track's credits)."""
    return star.bridge.join(star.artists, "artist_id").groupBy("track_id").agg(
        ordered_array(F.struct("artist_id", "artist_name"), F.col("artist_position")).alias("artists"))


def saved_albums(spark: SparkSession, d: str, top_orders: DataFrame | None = None,
                 track_details: bool = True) -> DataFrame:
    """One row per saved album: order attributes, nested ``tracks`` (each with
    its ``artists``), ``album_artists`` (distinct line suppliers, in line
    order) and two ``copyrights`` entries.

    The lines are grouped by order key and joined to ``orders`` on that same
    key, so the aggregate's hash partitioning is reused by the join.  With
    ``track_details=False`` each track keeps only its number and id: queries
    that read the album level (counts, album artists, copyrights) skip the
    part and credit joins entirely.  ``top_orders`` is a top-k of ``orders``
    (at most k rows): the lines are pruned to those keys by a broadcast semi
    join before anything is nested.
    """
    t = Tables(spark, d)
    star = star_from_tables(spark, d)
    selected = top_orders is not None
    orders = top_orders if selected else t.orders
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("track_id"), "l_suppkey")
    if selected:  # k keys: bounded by the ranking, safe to broadcast
        lines = lines.join(F.broadcast(orders.select(F.col("o_orderkey").alias("l_orderkey"))), "l_orderkey",
                           "left_semi")
    track_fields = [F.col("l_linenumber").alias("track_number"), "track_id"]
    if track_details:
        part = t.part.select(F.col("p_partkey").alias("track_id"), F.col("p_name").alias("track_name"),
                             (F.col("p_size").cast("bigint") * 6000).alias("duration_ms"))
        lines = lines.join(part, "track_id", "left").join(_track_credits(star), "track_id", "left")
        track_fields += ["track_name", "duration_ms", "artists"]
    lines = lines.join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    # a line number can repeat inside an order: supplier and part make the order total
    line_order = [F.col("l_linenumber"), F.col("l_suppkey"), F.col("track_id")]
    nested = lines.groupBy("l_orderkey").agg(
        ordered_array(F.struct(*track_fields), *line_order).alias("tracks"),
        ordered_array(F.struct(F.col("l_suppkey").alias("artist_id"), F.col("s_name").alias("artist_name")),
                      *line_order).alias("_line_artists"))
    albums = orders.join(nested, F.col("o_orderkey") == F.col("l_orderkey"))
    release = F.date_sub(F.to_date("o_orderdate"), F.pmod(F.col("o_custkey"), F.lit(3650)).cast("int"))
    label = F.col("o_orderpriority")
    return albums.select(
        F.col("o_orderkey").alias("album_id"), F.concat(F.lit("Album #"), F.col("o_orderkey").cast("string"))
        .alias("album_name"), F.col("o_orderdate").alias("added_at"), release.alias("release_date"),
        label.alias("label"), F.pmod(F.col("o_custkey"), F.lit(101)).cast("int").alias("popularity"),
        F.size("tracks").alias("total_tracks"),
        F.when(F.size("tracks") == 1, "single").when(F.col("o_orderstatus") == "F", "album").otherwise("compilation")
        .alias("album_type"),
        F.array_distinct("_line_artists").alias("album_artists"), "tracks",
        F.array(
            F.struct(F.lit("C").alias("type"),
                     F.concat(F.lit("(C) "), F.year(release).cast("string"), F.lit(" "), label).alias("text")),
            F.struct(F.lit("P").alias("type"),
                     F.concat(F.lit("(P) "), F.year("o_orderdate").cast("string"), F.lit(" "), label).alias("text")),
        ).alias("copyrights"),
    )


def _primary(arr: str) -> F.Column:
    return first_elem(arr)["artist_name"]


def recently_saved_albums(spark: SparkSession, d: str, k: int = 50) -> DataFrame:
    """The last ``k`` saved albums (ranked on ``orders`` before nesting)."""
    top = global_top_k(Tables(spark, d).orders, [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], k,
                       rank_col=None)
    a = saved_albums(spark, d, top, track_details=False)
    return a.select("added_at", "album_id", "album_name", _primary("album_artists").alias("primary_artist"),
                    "release_date", "total_tracks", "popularity", "label")


def saved_albums_by_artist(spark: SparkSession, d: str, since: str = SAVED_SINCE, k: int = 20) -> DataFrame:
    """Album artists (unnested) of albums saved since ``since``, top ``k`` by albums."""
    a = saved_albums(spark, d, track_details=False).filter(F.col("added_at") >= F.lit(since).cast("timestamp_ntz"))
    per = a.select(F.explode("album_artists").alias("artist"), "popularity", "release_date").groupBy(
        F.col("artist.artist_name").alias("artist_name")).agg(
        F.count(F.lit(1)).alias("album_count"), round_half_up(F.avg("popularity"), 2).alias("avg_popularity"),
        F.min("release_date").alias("earliest_album"), F.max("release_date").alias("latest_album"))
    return global_top_k(per, [F.col("album_count").desc(), F.col("artist_name")], k)


def albums_saved_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Albums saved per month with distinct primary album artists."""
    a = saved_albums(spark, d, track_details=False)
    return a.groupBy(F.to_date(F.date_trunc("month", "added_at")).alias("month")).agg(
        F.count(F.lit(1)).alias("albums_saved"),
        F.countDistinct(first_elem("album_artists")["artist_id"]).alias("unique_artists"))


def album_type_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Saved albums per type — average tracks and popularity."""
    a = saved_albums(spark, d, track_details=False)
    return a.groupBy("album_type").agg(
        F.count(F.lit(1)).alias("count"), round_half_up(F.avg("total_tracks"), 1).alias("avg_tracks"),
        round_half_up(F.avg("popularity"), 1).alias("avg_popularity"))


def longest_albums(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    """The saved albums with the most tracks."""
    top = global_top_k(saved_albums(spark, d, track_details=False), [F.col("total_tracks").desc(), F.col("album_id")], k)
    return top.select("rank", "album_name", _primary("album_artists").alias("primary_artist"), "total_tracks",
                      "release_date", "album_type")


def track_vs_album_artists(spark: SparkSession, d: str) -> DataFrame:
    """Collaborations inside saved albums — per (album, album artist,
    track name), the names of every credited artist of those tracks.

    The model nests tracks (with their artists) per album and unnests them
    twice again.  Here the lines are grouped per (order, track name) by their
    track ids alone.  A group of one line takes its track's names (bounded by
    one track's credits), sorted once per track, straight into the result;
    only groups of several lines gather names.  The album artist is the
    supplier of the order's first line, as in :func:`saved_albums`.
    """
    t = Tables(spark, d)
    star = star_from_tables(spark, d)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("track_id"), "l_suppkey")
    tasks = max(8, t.bytes_of("lineitem") // CREDIT_BYTES)
    names = star.bridge.join(star.artists, "artist_id").repartition(tasks, "track_id").groupBy("track_id").agg(
        F.array_sort(F.collect_list("artist_name")).alias("names")).filter(F.size("names") > 1)
    part = t.part.select(F.col("p_partkey").alias("track_id"), F.col("p_name").alias("track_name"))
    groups = (lines.select("l_orderkey", "track_id").join(part, "track_id", "left").repartition("l_orderkey")
              .groupBy("l_orderkey", "track_name").agg(F.collect_list("track_id").alias("_ids")))
    first = lines.groupBy("l_orderkey").agg(
        F.min(F.struct("l_linenumber", "l_suppkey", "track_id"))["l_suppkey"].alias("_s"))
    albums = (t.orders.select(F.col("o_orderkey").alias("l_orderkey")).join(first, "l_orderkey")
              .join(t.supplier.select(F.col("s_suppkey").alias("_s"), F.col("s_name").alias("album_artist")), "_s",
                    "left")).select("l_orderkey", "album_artist")
    single = groups.filter(F.size("_ids") == 1).join(albums, "l_orderkey").select(
        "l_orderkey", "album_artist", "track_name", F.get("_ids", F.lit(0)).alias("track_id")).join(names, "track_id")
    several = (groups.filter(F.size("_ids") > 1).select("l_orderkey", "track_name", F.explode("_ids").alias("track_id"))
               .join(names, "track_id").groupBy("l_orderkey", "track_name")
               .agg(F.array_sort(F.flatten(F.collect_list("names"))).alias("names")).join(albums, "l_orderkey"))
    both = single.select("l_orderkey", "album_artist", "track_name", "names").unionByName(
        several.select("l_orderkey", "album_artist", "track_name", "names"))
    return both.select(
        F.concat(F.lit("Album #"), F.col("l_orderkey").cast("string")).alias("album_name"), "album_artist",
        "track_name", F.array_join("names", ", ").alias("track_artists"))


def copyright_types(spark: SparkSession, d: str, samples: int = 5) -> DataFrame:
    """Copyright entries by type — albums and up to five sample years
    (the smallest distinct years, so the sample is deterministic)."""
    a = saved_albums(spark, d, track_details=False)
    c = a.select("album_id", F.explode("copyrights").alias("c")).select(
        "album_id", F.col("c.type").alias("type"), regexp_extract_or_null(F.col("c.text"), r"\d{4}").alias("year"))
    stats = c.groupBy("type").agg(F.countDistinct("album_id").alias("album_count"))
    years = limited_ordered_array(c.filter(F.col("year").isNotNull()), ["type"], [F.col("year")], F.col("year"),
                                  samples, "sample_years", distinct=True)
    name = F.when(F.col("type") == "C", "Copyright").when(F.col("type") == "P", "Phonographic").otherwise("Unknown")
    return stats.join(years, "type", "left").select(
        "type", name.alias("copyright_type_name"), "album_count",
        F.array_join("sample_years", ", ").alias("sample_years"))
