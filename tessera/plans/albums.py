"""Album enrichment work list and catalogue queries.

The album enrichment table is re-aimed at ``part`` grouped by brand (the
star's album): one aggregate per brand gives the track count, a
popularity, a label (the type of the brand's first part) and the genres
(distinct lower-cased types of its largest parts).  Catalogue queries read
all brands; the work list takes a brand whose number is a multiple of three
as not enriched yet.  Plays come from the
lineitem play fact, pre-aggregated per track before any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import round_half_up
from tessera.operators.relational import as_date, global_top_k, limited_ordered_array
from tessera.plans.enrichment import albums_lacking_enrichment
from tessera.plans.star import MusicStar, star_from_tables
from tessera.sources.tables import Tables

# Fixed values of the re-aimed album enrichment
ALBUM_ENRICH_AS_OF = "2024-01-31"
GENRE_MIN_SIZE = 49          # parts at least this large lend their type as a genre
STALE_DAYS = 90
GENRE = "promo"              # D10's genre filter (bound literal)


def _tier(pop: F.Column) -> F.Column:
    # Popularity tier labels and lower bounds
    return (F.when(pop >= 80, "80-100 (Very Popular)").when(pop >= 60, "60-79 (Popular)")
            .when(pop >= 40, "40-59 (Moderate)").when(pop >= 20, "20-39 (Niche)").otherwise("0-19 (Emerging)"))


def album_enrichment(spark: SparkSession, d: str, gaps: bool = False) -> DataFrame:
    """The normalized album enrichment rows, one per brand; with ``gaps`` every third is still to be enriched."""
    part = Tables(spark, d).part
    per_brand = part.groupBy(F.col("p_brand").alias("album_id")).agg(
        F.count(F.lit(1)).alias("total_tracks"),
        F.pmod(F.sum("p_size"), F.lit(101)).cast("int").alias("popularity"),
        F.min_by("p_type", "p_partkey").alias("label"),
        F.array_sort(F.collect_set(F.when(F.col("p_size") >= GENRE_MIN_SIZE, F.lower("p_type")))).alias("genres"),
    )
    no = F.substring("album_id", 7, 10).cast("int")
    release = F.date_add(F.lit("1990-01-01").cast("date"), no * 97)
    day_precision = F.pmod(no, F.lit(5)) != 0
    return (per_brand.filter(F.pmod(no, F.lit(3)) != 0) if gaps else per_brand).select(
        "album_id", F.col("album_id").alias("album_name"), "popularity", "label", "genres", "total_tracks",
        F.when(F.pmod(no, F.lit(4)) == 0, "single").when(F.pmod(no, F.lit(4)) == 1, "compilation")
        .otherwise("album").alias("album_type"),
        F.when(day_precision, F.date_format(release, "yyyy-MM-dd")).otherwise(F.date_format(release, "yyyy"))
        .alias("release_date"),
        F.when(day_precision, "day").otherwise("year").alias("release_date_precision"),
        F.date_sub(as_date(ALBUM_ENRICH_AS_OF), F.pmod(no * 37, F.lit(200)).cast("int")).cast("timestamp_ntz")
        .alias("enriched_at"),
    )


def _album_plays(star: MusicStar) -> DataFrame:
    per_track = star.fact.groupBy("track_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_track.join(star.tracks.select("track_id", "album_id"), "track_id").groupBy("album_id").agg(
        F.sum("_n").alias("play_count"))


def album_backfill_worklist(spark: SparkSession, d: str) -> DataFrame:
    """E02 backfill mode / D11: played albums without enrichment, first play and plays."""
    star = star_from_tables(spark, d)
    return albums_lacking_enrichment(star.fact, star.tracks, album_enrichment(spark, d, gaps=True)).select(
        "album_id", F.col("album_id").alias("album_name"), "first_played_at", "play_count")


def top_enriched_albums(spark: SparkSession, d: str, k: int = 30) -> DataFrame:
    """Most played enriched albums with their enrichment attributes."""
    star = star_from_tables(spark, d)
    joined = _album_plays(star).join(album_enrichment(spark, d), "album_id")
    top = global_top_k(joined, [F.col("play_count").desc(), F.col("album_id")], k)
    return top.select("rank", "album_name", "popularity", "release_date", "label", "album_type", "play_count",
                      F.array_join("genres", ", ").alias("genres"))


def albums_by_genre(spark: SparkSession, d: str, genre: str = GENRE, k: int = 20) -> DataFrame:
    """Enriched albums tagged with ``genre``, most popular first."""
    e = album_enrichment(spark, d).filter(F.array_contains("genres", F.lit(genre)))
    top = global_top_k(e, [F.col("popularity").desc(), F.col("album_id")], k)
    return top.select("rank", "album_name", "popularity", "release_date", "label",
                      F.array_join("genres", ", ").alias("genre_list"))


def albums_by_label(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    """Per label — albums, average popularity, three most popular names."""
    e = album_enrichment(spark, d).filter(F.col("label").isNotNull())
    stats = e.groupBy("label").agg(F.countDistinct("album_id").alias("album_count"),
                                   round_half_up(F.avg("popularity"), 1).alias("avg_popularity"))
    top3 = limited_ordered_array(e, ["label"], [-F.col("popularity"), F.col("album_name")], F.col("album_name"), 3,
                                 "top_albums")
    ranked = global_top_k(stats, [F.col("album_count").desc(), F.col("label")], k)
    return ranked.join(top3, "label", "left").select(
        "rank", "label", "album_count", "avg_popularity", F.array_join("top_albums", ", ").alias("top_albums"))


def release_timeline(spark: SparkSession, d: str) -> DataFrame:
    """Albums per release year × type (day-precision dates only)."""
    e = album_enrichment(spark, d).filter(F.col("release_date_precision") == "day")
    year = F.year(F.to_date("release_date", "yyyy-MM-dd"))
    return e.groupBy(year.alias("release_year"), "album_type").agg(
        F.count(F.lit(1)).alias("album_count"), round_half_up(F.avg("popularity"), 1).alias("avg_popularity"))


def stale_albums(spark: SparkSession, d: str, k: int = 100) -> DataFrame:
    """Albums enriched more than 90 days before ``as_of``."""
    now = as_date(ALBUM_ENRICH_AS_OF).cast("timestamp_ntz")
    e = album_enrichment(spark, d).filter(F.col("enriched_at") < now - F.expr(f"INTERVAL {STALE_DAYS} DAYS"))
    top = global_top_k(e, [F.col("popularity").desc(), F.col("album_id")], k, rank_col=None)
    return top.select("album_id", "album_name", "enriched_at",
                      F.datediff(as_date(ALBUM_ENRICH_AS_OF), F.to_date("enriched_at")).alias("days_since_enrichment"),
                      "popularity", "release_date")


def album_tiers_by_type(spark: SparkSession, d: str) -> DataFrame:
    """Album type × popularity tier, count and three sample names."""
    e = album_enrichment(spark, d).withColumn("popularity_tier", _tier(F.col("popularity")))
    keys = ["album_type", "popularity_tier"]
    stats = e.groupBy(*keys).agg(F.count(F.lit(1)).alias("album_count"), F.min("popularity").alias("min_popularity"))
    samples = limited_ordered_array(e, keys, [-F.col("popularity"), F.col("album_name")], F.col("album_name"), 3,
                                    "sample_albums")
    return stats.join(samples, keys).select(
        *keys, "album_count", F.array_join("sample_albums", ", ").alias("sample_albums"), "min_popularity")


def albums_without_genres(spark: SparkSession, d: str) -> DataFrame:
    """Enriched albums whose genre list is empty (data-quality monitor)."""
    e = album_enrichment(spark, d).filter(F.size("genres") == 0)
    return e.select("album_name", "album_id", "album_type", "popularity", "release_date", "label", "enriched_at")


def singles_vs_albums(spark: SparkSession, d: str) -> DataFrame:
    """Per album type — count, average popularity and tracks, distinct labels."""
    e = album_enrichment(spark, d)
    return e.groupBy("album_type").agg(
        F.count(F.lit(1)).alias("count"), round_half_up(F.avg("popularity"), 1).alias("avg_popularity"),
        round_half_up(F.avg("total_tracks"), 1).alias("avg_tracks"), F.countDistinct("label").alias("unique_labels"))
