"""Enrichment work lists and catalogue queries.

The enrichment table is re-aimed at ``supplier``: popularity, followers,
the genre (its nation) and enrichment date derive from the supplier row.
Catalogue queries read all of them; work lists take artists without a
positive balance as not enriched yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import round_half_up
from tessera.operators.relational import as_date, batch_ids, top_k_per_group
from tessera.plans.star import MusicStar, star_from_tables
from tessera.sources.tables import Tables

# Fixed values of the re-aimed enrichment model
ENRICH_AS_OF = "2024-01-31"
STALE_DAYS = 90
ARTIST_BATCH = 50
SAMPLE_SIZE = 3


def enrichment(spark: SparkSession, d: str, gaps: bool = False) -> DataFrame:
    """One row per supplier; with ``gaps`` those without a positive balance are still to be enriched (work lists)."""
    t = Tables(spark, d)
    suppliers = t.supplier.filter(F.col("s_acctbal") > 0) if gaps else t.supplier
    return (
        suppliers
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("artist_id"),
            F.floor(F.col("s_acctbal") / 100).cast("int").alias("popularity"),
            (F.col("s_nationkey").cast("bigint") * 1000 + F.col("s_suppkey")).alias("followers"),
            F.col("n_name").alias("genre"),
            F.date_sub(as_date(ENRICH_AS_OF), F.pmod(F.col("s_suppkey") * 7, F.lit(200)).cast("int")).alias("enriched_at"),
        )
    )


def played_artists(star: MusicStar) -> DataFrame:
    """Every credited artist of a played track, with plays and first play (J03 fan-out)."""
    per_track = star.fact.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("played_at").alias("first_played"))
    credits = star.bridge.select("track_id", "artist_id")
    return per_track.join(credits, "track_id").groupBy("artist_id").agg(
        F.sum("n").alias("play_count"), F.min("first_played").alias("first_played_at"))


def artists_lacking_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """E01 backfill mode / D02: played artists with no enrichment row, by plays."""
    star = star_from_tables(spark, d)
    return played_artists(star).join(enrichment(spark, d, gaps=True), "artist_id", "left_anti")


def enrichment_batches(spark: SparkSession, d: str) -> DataFrame:
    """The work list cut into fixed batches in play order."""
    work = artists_lacking_enrichment(spark, d)
    buckets = (-F.col("play_count"), F.floor(F.col("artist_id") / 1024))
    return batch_ids(work, buckets, [F.col("play_count").desc(), F.col("artist_id")], ARTIST_BATCH).select(
        "artist_id", "play_count", "position", "batch_id")


def coverage(spark: SparkSession, d: str) -> DataFrame:
    """Share of played artists lacking enrichment (one row)."""
    star = star_from_tables(spark, d)
    marked = played_artists(star).join(
        enrichment(spark, d, gaps=True).select("artist_id", F.lit(1).alias("_has")), "artist_id", "left")
    return marked.agg(
        F.count(F.lit(1)).alias("played_artists"),
        F.count_if(F.col("_has").isNull()).alias("missing"),
    ).withColumn("pct_missing", F.round(F.lit(100.0) * F.col("missing") / F.nullif(F.col("played_artists"), F.lit(0)), 2))


def stale_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Enrichment rows older than 90 days, with their age."""
    e = enrichment(spark, d)
    age = F.datediff(as_date(ENRICH_AS_OF), F.col("enriched_at"))
    return e.filter(age > STALE_DAYS).select("artist_id", "enriched_at", age.alias("days_old"))


def genre_summary(spark: SparkSession, d: str) -> DataFrame:
    """Per genre — distinct artists, total followers, average popularity."""
    e = enrichment(spark, d)
    return e.groupBy("genre").agg(
        F.countDistinct("artist_id").alias("artists"), F.sum("followers").alias("total_followers"),
        round_half_up(F.avg("popularity"), 1).alias("avg_popularity"))


def popularity_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Popularity tiers with counts and up to three sample artists.

    Samples come from a per-tier ``row_number() <= 3`` (partial group limit
    before the shuffle), so no tier's full member list is ever collected.
    """
    e = enrichment(spark, d).join(Tables(spark, d).supplier.select(
        F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist_name")), "artist_id")
    p = F.col("popularity")
    tier = F.when(p >= 80, "80-100 very high").when(p >= 60, "60-79 high").when(p >= 40, "40-59 medium").when(
        p >= 20, "20-39 low").otherwise("0-19 very low")
    tiered = e.withColumn("tier", tier)
    counts = tiered.groupBy("tier").agg(F.count(F.lit(1)).alias("artists"), F.min("popularity").alias("min_pop"))
    samples = top_k_per_group(tiered, ["tier"], [F.col("artist_name")], SAMPLE_SIZE, rank_col="_r").groupBy(
        "tier").agg(F.array_join(F.array_sort(F.collect_list("artist_name")), ", ").alias("samples"))
    return counts.join(samples, "tier").orderBy("min_pop")


def artists_of_genre(spark: SparkSession, d: str, genre: str) -> DataFrame:
    """Enriched artists tagged with ``genre`` (bound literal, case-insensitive)."""
    e = enrichment(spark, d)
    names = Tables(spark, d).supplier.select(F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist_name"))
    return e.filter(F.lower("genre") == F.lower(F.lit(genre))).join(names, "artist_id").select(
        "artist_id", "artist_name", "popularity", "followers")


def popularity_follower_ratio(spark: SparkSession, d: str, min_popularity: int = 50) -> DataFrame:
    """Popular artists with few followers — popularity per thousand followers."""
    e = enrichment(spark, d).filter(F.col("popularity") >= min_popularity)
    ratio = round_half_up(F.col("popularity") * 1000 / F.nullif(F.col("followers"), F.lit(0)), 4)
    return e.select("artist_id", "popularity", "followers", ratio.alias("pop_per_k_followers"))


RUN_DAYS = 7


def enrichment_runs_by_day(spark: SparkSession, d: str, days: int = RUN_DAYS) -> DataFrame:
    """Enrichment runs of the last ``days`` days — artists
    touched, those with a genre (``COUNT(DISTINCT CASE …)``), averages."""
    e = enrichment(spark, d).filter(F.col("enriched_at") >= F.date_sub(as_date(ENRICH_AS_OF), days))
    return e.groupBy(F.col("enriched_at").alias("run_date")).agg(
        F.count(F.lit(1)).alias("artists"),
        F.countDistinct(F.when(F.col("genre").isNotNull(), F.col("artist_id"))).alias("artists_with_genres"),
        round_half_up(F.avg("popularity"), 1).alias("avg_popularity"),
        round_half_up(F.avg("followers"), 0).alias("avg_followers"))


def albums_lacking_enrichment(fact: DataFrame, tracks: DataFrame, album_enrichment: DataFrame,
                              since=None) -> DataFrame:
    """Albums with their first play, lacking an enrichment row.

    Backfill mode (``since`` None) lists all of them by first play;
    incremental mode keeps albums first played on or after ``since``.
    """
    per_track = fact.groupBy("track_id").agg(F.min("played_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    per_album = per_track.join(tracks.select("track_id", "album_id"), "track_id").groupBy("album_id").agg(
        F.min("_first").alias("first_played_at"), F.sum("_n").alias("play_count"))
    out = per_album.join(album_enrichment.select("album_id"), "album_id", "left_anti")
    if since is not None:
        out = out.filter(F.col("first_played_at") >= F.lit(since))
    return out
