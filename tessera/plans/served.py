"""Reads and exports over whole tables: rankings together (R04), activity lists
and points (R07, R08), one artist's profile (R10–R15), the home-page bundle
(R31, S28), hub rows H01 and H03, staged saves (L03, L04), entity documents
and export forms (S24–S27, S29–S34).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.relational import interval_join
from tessera.plans import activities as acts_plan
from tessera.plans import health, hub, music, reads, staging, workouts
from tessera.plans.star import EVENTS_AS_OF, LINEITEM_AS_OF, star_from_events, star_from_tables
from tessera.session import scratch_path
from tessera.sources import sinks
from tessera.sources.tables import Tables

# Parameters of the registered reads: the artist of the profile, the last full day, slices, the export's population
PROFILE_ARTIST = 7
STREAK_AS_OF = "2024-01-30"
CHUNK_DAYS = 7
EXPORT_TOP, EXPORT_SINCE = 20, "2001-10-01"


# The key and up to three figures of each home-page tile, as they are returned by home_page_tiles
TILE_COLUMNS = {
    "music_time_daily": ("date", "total_duration_ms", "bar_height_percent"),
    "running_weekly_volume": ("week_start", "total_km", "runs"),
    "running_by_day": ("date", "km", "runs", "aerobic"),
    "body_battery": ("date", "highest", "lowest", "gain"),
    "hrv": ("date", "hrv", "baseline", "height_pct"),
    "race_prediction": ("metric", "current_value", "previous_value", "delta"),
    "vo2max": ("week_start", "weekly_avg", "current_value", "delta"),
    "sleep_stages": ("date", "total", "pct"),
    "steps": ("date", "steps", "goal", "goal_pct"),
    "resting_hr": ("date", "value", "display_height_percent", "average"),
    "sleep_scores": ("date", "score", "average"),
    "sleep_body_battery": ("date", "sleep_score", "battery_at_bedtime", "battery_gain"),
    "stress": ("date", "avg_stress", "max_stress", "average_stress"),
    "top_tracks": ("rank", "play_count", "track_id"),
    "top_artists": ("rank", "total_duration_ms", "play_count", "artist_id"),
}


def rankings_together(spark: SparkSession, d: str) -> DataFrame:
    """The three rankings of one period in one result."""
    out = None
    parts = reads.music_rankings(star_from_tables(spark, d), LINEITEM_AS_OF, "last_30_days", 10)
    for kind, df in parts.items():
        key = {"artists": "artist_id", "tracks": "track_id", "albums": "album_id"}[kind]
        part = df.select(F.lit(kind).alias("kind"), "rank", F.col(key).cast("string").alias("id"), "play_count", "total_duration_ms")
        out = part if out is None else out.unionByName(part)
    return out


def activity_list(spark: SparkSession, d: str) -> DataFrame:
    """Every activity with its user's zone shares."""
    return acts_plan.activities_list(spark, d)


def activity_points(spark: SparkSession, d: str) -> DataFrame:
    """R08 for every activity: all the points of its user while it lasts."""
    ev = Tables(spark, d).events.select("user_id", "event_id", "ts", "value")
    acts = acts_plan.activities(spark, d).select("activity_id", "user_id", "start_ts", "end_ts")
    return interval_join(acts, ev, "start_ts", "end_ts", "ts", keys=["user_id"],
                         bucket_seconds=acts_plan.ACTIVITY_MINUTES * 60).select("activity_id", "event_id", "ts", "value")


def _profile(part: str, events: bool = False):
    def query(spark: SparkSession, d: str) -> DataFrame:
        star, as_of = (star_from_events(spark, d), STREAK_AS_OF) if events else (star_from_tables(spark, d), LINEITEM_AS_OF)
        return reads.artist_profile(star, as_of, PROFILE_ARTIST)[part]

    return query


def homepage_sizes(spark: SparkSession, d: str) -> DataFrame:
    """The home-page bundle (one row of arrays), as the length of each of its arrays."""
    whole = health.homepage_bundle(spark, d, EVENTS_AS_OF)
    return whole.select(*[F.size(c).cast("bigint").alias(c) for c in whole.columns])


def hub_fact_played(spark: SparkSession, d: str) -> DataFrame:
    """The play fact of the nested play log."""
    return hub.fact_played(hub.play_log_from_tables(spark, d))


def hub_bridge_albums_artists(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (album, artist) of the nested play log."""
    return hub.bridge_albums_artists(hub.play_log_from_tables(spark, d))


def _saves(spark: SparkSession, d: str, images: str) -> DataFrame:
    """Two deliveries per event; the second (even ids only) holds another number of images."""
    ev = Tables(spark, d).events
    urls = lambda n, run: F.transform(
        F.sequence(F.lit(1), n), lambda i: F.struct(F.concat_ws("/", F.lit(run), F.col("event_id").cast("string"), i.cast("string")).alias("url")))
    count = F.pmod(F.col("event_id"), F.lit(4)).cast("int")
    first = ev.select("event_id", F.col("ts").alias("addedAt"), F.date_add(F.to_date("ts"), 1).alias("_dp_inserted_at"),
                      F.when(count > 0, urls(count, "one")).alias(images))
    second = ev.filter(F.pmod("event_id", F.lit(2)) == 0).select(
        "event_id", F.col("ts").alias("addedAt"), F.date_add(F.to_date("ts"), 2).alias("_dp_inserted_at"),
        urls(count + 1, "two").alias(images))
    return first.unionByName(second)


def staged_saved_albums(spark: SparkSession, d: str) -> DataFrame:
    """Image addresses by safe index, the latest delivery of each save."""
    return staging.saved_albums(_saves(spark, d, "images")).drop("images")


def staged_saved_tracks(spark: SparkSession, d: str) -> DataFrame:
    """The same on a saved track's album images."""
    return staging.saved_tracks(_saves(spark, d, "albumImages")).drop("albumImages")


def artist_document_sizes(spark: SparkSession, d: str) -> DataFrame:
    """One document per artist, as the length of each of its lists."""
    docs = music.artist_documents(star_from_events(spark, d), STREAK_AS_OF)
    lists = [c for c in docs.columns if c != "artist_id"]
    return docs.select("artist_id", *[F.coalesce(F.size(c), F.lit(0)).cast("bigint").alias(c) for c in lists])


def exported_artists(spark: SparkSession, d: str) -> DataFrame:
    """The artists whose documents are exported: the most played, and those played lately."""
    star = star_from_tables(spark, d)
    per_track = star.fact.groupBy("track_id").agg(F.count(F.lit(1)).alias("plays"), F.max("played_at").alias("last_played_at"))
    stats = per_track.join(star.primary_bridge().select("track_id", "artist_id"), "track_id").groupBy("artist_id").agg(
        F.sum("plays").alias("plays"), F.max("last_played_at").alias("last_played_at"))
    return sinks.export_population(stats, "artist_id", "plays", "last_played_at", EXPORT_TOP, EXPORT_SINCE)


def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Orders with a nested customer as JSON lines in export form, read back."""
    o = Tables(spark, d).orders
    nested = sinks.export_values(o.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))).select(
        "o_orderkey", "o_orderdate", "o_totalprice", F.struct("o_custkey", "o_orderpriority").alias("customer"))
    path = scratch_path(spark, "export-json")
    sinks.write_jsonl(nested, path)
    back = spark.read.schema(nested.schema).json(path)
    return back.select("o_orderkey", "o_orderdate", "o_totalprice", "customer.o_custkey", "customer.o_orderpriority")


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The same as CSV with the nested column as JSON text, read back."""
    o = Tables(spark, d).orders
    path = scratch_path(spark, "export-csv")
    sinks.write_csv(o.select("o_orderkey", F.struct("o_custkey", "o_orderstatus").alias("customer")), path)
    # the writer escapes quotes inside a value by a backslash, Spark's own default for reading too
    return spark.read.option("header", "true").schema("o_orderkey bigint, customer string").csv(path)


def pending_months(spark: SparkSession, d: str) -> DataFrame:
    """The calendar months of the orders' dates, less those marked done (every third month)."""
    o = Tables(spark, d).orders
    lo, hi = o.select(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    start = F.greatest(F.trunc(F.to_date("o_orderdate"), "MM"), F.lit(lo))
    progress = o.select(start.alias("slice_start")).distinct().withColumn(
        "status", F.when(F.month("slice_start") % 3 == 0, "completed").otherwise("failed"))
    return sinks.pending_slices(sinks.month_slices(spark, lo, hi), progress)


def pending_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Week-long chunks of the events' days, less those whose first day is marked done."""
    ev = Tables(spark, d).events
    lo, hi = ev.select(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    progress = ev.select(F.to_date("ts").alias("slice_start")).distinct().withColumn(
        "status", F.when(F.dayofmonth("slice_start") % 2 == 0, "completed").otherwise("running"))
    return sinks.pending_slices(sinks.day_chunks(spark, lo, hi, CHUNK_DAYS), progress)


def _artist_documents(part: str, events: bool = False):
    """The documents of all artists, written to a store and read back: the entries of one of their lists."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        star, as_of = (star_from_events(spark, d), STREAK_AS_OF) if events else (star_from_tables(spark, d), LINEITEM_AS_OF)
        views = {"overview": lambda: music.artist_overview(star, as_of), "top_tracks": lambda: music.artist_top_tracks(star),
                 "albums": lambda: music.artist_albums(star), "calendar": lambda: music.artist_calendar(star),
                 "heatmap": lambda: music.artist_heatmap(star), "evolution": lambda: music.artist_evolution(star)}
        docs = music.artist_documents(star, as_of)
        store = sinks.DocumentStore(spark, scratch_path(spark, f"artists-{part}"), "artist_id", buckets=32)
        store.write(docs)
        view = views[part]().schema  # the types that the JSON text is read back in
        entry = T.StructType([f for f in view.fields if f.name != "artist_id"])
        schema = T.StructType([T.StructField("artist_id", docs.schema["artist_id"].dataType), T.StructField(part, T.ArrayType(entry))])
        entries = store.read(schema).select("artist_id", F.explode(part).alias("e")).select("artist_id", "e.*")
        return entries.select(*view.names)

    return query


def home_page_tiles(spark: SparkSession, d: str) -> DataFrame:
    """The home-page bundle as one JSON document, read back: every entry of its tiles (its key and figures)."""
    whole = health.homepage_bundle(spark, d, EVENTS_AS_OF)
    path = scratch_path(spark, "home-page")
    whole.write.mode("overwrite").json(path)
    back = spark.read.schema(whole.schema).json(path)
    out = None
    for tile, columns in TILE_COLUMNS.items():
        number = [F.col(f"e.{c}").cast("double").alias(f"v{i}") for i, c in enumerate(columns[1:], 1)]
        filled = number + [F.lit(None).cast("double").alias(f"v{i}") for i in range(len(number) + 1, 4)]
        part = back.select(F.explode(tile).alias("e")).select(
            F.lit(tile).alias("tile"), F.substring(F.col(f"e.{columns[0]}").cast("string"), 1, 10).alias("name"), *filled)
        out = part if out is None else out.unionByName(part)
    return out


def ranking_documents(spark: SparkSession, d: str) -> DataFrame:
    """A document per period and ranking, written to a store, read back and compared entry by entry."""
    entry = F.struct("rank", "id", "play_count", "total_duration_ms")
    name = F.concat_ws("-", F.lit("last_30_days"), "kind")
    docs = rankings_together(spark, d).groupBy(name.alias("name"), "kind").agg(
        F.array_sort(F.collect_list(entry)).alias("entries"))  # a ranking has at most its limit of entries
    store = sinks.DocumentStore(spark, scratch_path(spark, "rankings"), "name", buckets=4)
    store.write(docs)
    kinds = [f"last_30_days-{k}" for k in ("artists", "tracks", "albums")]
    return store.read(docs.schema, kinds).select("kind", F.explode("entries").alias("e")).select("kind", "e.*")


def activity_documents(spark: SparkSession, d: str) -> DataFrame:
    """A document per running activity with all its arrays, written to a store, read back, every element."""
    docs = workouts.hub(spark, d)
    store = sinks.DocumentStore(spark, scratch_path(spark, "activities"), "activityId", buckets=16)
    store.write(docs)
    kept = docs.select("activityId", "kilometer_laps", "training_intervals", "time_series", "polyline")
    return workouts.elements(store.read(kept.schema))


QUERIES = {
    f.__name__: f
    for f in (
        ranking_documents, activity_documents, home_page_tiles, rankings_together, activity_list, activity_points, homepage_sizes, hub_fact_played, hub_bridge_albums_artists,
        staged_saved_albums, staged_saved_tracks, artist_document_sizes, exported_artists, json_round_trip, csv_round_trip,
        pending_months, pending_chunks,
    )
} | {
    f"artist_documents_{part}": _artist_documents(part, part in ("overview", "heatmap"))
    for part in ("overview", "top_tracks", "albums", "calendar", "heatmap", "evolution")
} | {
    "profile_overview": _profile("overview", events=True),
    "profile_heatmap": _profile("heatmap", events=True),
    "profile_tracks": _profile("tracks"),
    "profile_albums": _profile("albums"),
    "profile_calendar": _profile("calendar"),
    "profile_evolution": _profile("evolution"),
}
