"""Lake-layer queries over the provided tables: keep-latest, incremental,
merge, quality and nested-record operators (I01–I03, Q01–Q10, N/C rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import safe_get, last_elem
from tessera.functions.nested import flatten_pairs, json_path, zip_descriptors
from tessera.operators import keep, quality, records
from tessera.sources.tables import Tables

# Fixed values for the re-aimed examples: the batch boundaries that split
# the provided tables into "already loaded" and "new" parts.
EVENTS_LOADED_BEFORE = "2024-01-20"
EVENTS_NEW_FROM = "2024-01-20"
EVENTS_TARGET_BEFORE = "2024-01-25"
ORDERS_TARGET_BEFORE = "2000-01-01"
ORDERS_SOURCE_FROM = "1999-01-01"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def keep_latest_single(spark: SparkSession, d: str) -> DataFrame:
    """I01, single key: each customer's latest order."""
    o = Tables(spark, d).orders
    latest = keep.keep_latest(o, ["o_custkey"], [F.col("o_orderdate").desc()], [F.col("o_orderkey").desc()])
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


def keep_latest_composite(spark: SparkSession, d: str) -> DataFrame:
    """I01, composite key: latest line per (part, supplier)."""
    li = Tables(spark, d).lineitem
    latest = keep.keep_latest(
        li, ["l_partkey", "l_suppkey"], [F.col("l_shipdate").desc()],
        [F.col("l_orderkey").desc(), F.col("l_linenumber").desc()])
    return latest.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")


def keep_latest_two_orders(spark: SparkSession, d: str) -> DataFrame:
    """I01 with two order columns (``ORDER BY ts DESC, event_id DESC``)."""
    ev = Tables(spark, d).events
    latest = keep.keep_latest(ev, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.select("user_id", "event_type", "event_id", "ts", "value")


def incremental_new_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows newer than the target's high-water mark."""
    ev = Tables(spark, d).events
    target = ev.filter(F.col("ts") < F.lit(EVENTS_LOADED_BEFORE).cast("timestamp_ntz"))
    return keep.incremental_filter(ev, target, "ts", "ts").select("event_id", "ts", "user_id", "event_type")


def merge_orders(spark: SparkSession, d: str) -> DataFrame:
    """Upsert a batch of corrected orders into an older snapshot."""
    o = Tables(spark, d).orders
    target = o.filter(F.col("o_orderdate") < F.lit(ORDERS_TARGET_BEFORE).cast("timestamp_ntz"))
    source = o.filter(F.col("o_orderdate") >= F.lit(ORDERS_SOURCE_FROM).cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"),
        (F.col("o_totalprice") + 100.0).alias("o_totalprice"), "o_orderdate")
    merged = keep.merge_upsert(target.select(*source.columns), source, ["o_orderkey"])
    return merged


LINEITEM_RULES = [
    quality.not_null("l_shipdate"),
    quality.in_range("l_quantity", 1, 45),
    quality.in_range("l_discount", 0.0, 0.08),
    quality.positive("l_tax"),
    quality.max_length("l_returnflag", 1),
    quality.date_range("l_shipdate", "1995-01-01", "2001-06-30"),
]


def quality_errors(spark: SparkSession, d: str) -> DataFrame:
    """Q07: every failing rule per line, joined as text."""
    li = Tables(spark, d).lineitem
    checked = quality.with_errors(li, LINEITEM_RULES)
    return checked.filter(F.size("_errors") > 0).select(
        "l_orderkey", "l_linenumber", F.size("_errors").alias("n_errors"),
        F.array_join("_errors", "; ").alias("errors"))


def quality_split(spark: SparkSession, d: str) -> DataFrame:
    """Q08 strict mode: accepted vs quarantined counts."""
    li = Tables(spark, d).lineitem
    checked = quality.with_errors(li, LINEITEM_RULES)
    status = F.when(F.size("_errors") == 0, "accepted").otherwise("quarantined")
    return checked.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("records"))


def unique_violations(spark: SparkSession, d: str) -> DataFrame:
    """Q09 unique test on (part, supplier)."""
    return keep.unique_key_violations(Tables(spark, d).lineitem, ["l_partkey", "l_suppkey"])


def not_null_violations(spark: SparkSession, d: str) -> DataFrame:
    """Q09 not_null test over every column of customer and orders (one scan each)."""
    t = Tables(spark, d)
    c, o = t.customer, t.orders
    return quality.null_counts(c, c.columns).withColumn("table_name", F.lit("customer")).unionByName(
        quality.null_counts(o, o.columns).withColumn("table_name", F.lit("orders")))


def rejection_rate(spark: SparkSession, d: str) -> DataFrame:
    """Q10: success / rejection rates of the lineitem rules."""
    return quality.quality_summary(Tables(spark, d).lineitem, LINEITEM_RULES)


def json_extract_scalar(spark: SparkSession, d: str) -> DataFrame:
    """Scalar from JSON text, aggregated by its value."""
    ev = Tables(spark, d).events
    k = json_path("props", "$.k").cast("bigint")
    return ev.groupBy(k.alias("k")).agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total_value"))


def array_explode_offset(spark: SparkSession, d: str) -> DataFrame:
    """Lines of every document with their 0-based offset."""
    docs = Tables(spark, d).documents
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).select(
        "doc_id", "line_no", F.length("line").alias("line_chars"))


def array_safe_index(spark: SparkSession, d: str) -> DataFrame:
    """First, third (null when absent) and last word of every document."""
    docs = Tables(spark, d).documents
    words = F.split("text", " ")
    return docs.select(
        "doc_id", F.size(words).alias("n_words"), safe_get(words, 0).alias("first_word"),
        safe_get(words, 2).alias("third_word"), last_elem(words).alias("last_word"),
        safe_get(words, 100000).alias("far_word"))


def nested_struct_build(spark: SparkSession, d: str) -> DataFrame:
    """Order with a two-level nested customer → nation record, as JSON."""
    t = Tables(spark, d)
    doc = F.struct(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderstatus").alias("status"),
        F.struct(
            F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
            F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")).alias("nation"),
        ).alias("customer"),
    )
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("o_orderkey", F.to_json(doc).alias("order_json"))
    )


def flatten_pairs_query(spark: SparkSession, d: str) -> DataFrame:
    """Each embedding as ``[[a, b], …]`` pairs → ``{timestamp, value}`` rows."""
    emb = Tables(spark, d).embeddings
    e = F.col("embedding")
    pairs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(e) / 2).cast("int") - 1),
        lambda i: F.array(F.get(e, i * 2).cast("double"), F.get(e, i * 2 + 1).cast("double")))
    return emb.select("vec_id", F.posexplode(flatten_pairs(pairs)).alias("pair_idx", "p")).select(
        "vec_id", "pair_idx", F.col("p.timestamp").alias("timestamp"), F.col("p.value").alias("value"))


def descriptor_expand(spark: SparkSession, d: str) -> DataFrame:
    """Metric vectors + ``[{key, metricsIndex}]`` descriptors → one row per vector."""
    ev = Tables(spark, d).events
    k = json_path("props", "$.k").cast("double")
    vectors = F.array(F.array(F.col("value"), k), F.array(-F.col("value"), k + 1), F.array(F.lit(None).cast("double"), k))
    descriptors = F.array(
        F.struct(F.lit("value").alias("key"), F.lit(0).alias("metricsIndex")),
        F.struct(F.lit("k").alias("key"), F.lit(1).alias("metricsIndex")))
    maps = zip_descriptors(vectors, descriptors)
    return ev.select("event_id", F.posexplode(maps).alias("idx", "m")).select(
        "event_id", "idx", F.col("m")["value"].alias("value"), F.col("m")["k"].alias("k"),
        F.size("m").alias("n_keys"))


def measure_pivot(spark: SparkSession, d: str) -> DataFrame:
    """N23-style pivot: per user and day, one column per event type."""
    ev = Tables(spark, d).events
    return (
        ev.groupBy("user_id", F.to_date("ts").alias("day"))
        .pivot("event_type", list(EVENT_TYPES))
        .agg(F.round(F.sum("value"), 2))
    )


def window_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Greedy 24-hour dedupe of each user's events."""
    ev = Tables(spark, d).events.select("user_id", "event_id", "ts")
    return records.greedy_window_dedupe(ev, "user_id", "ts", 24.0)


def minute_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """New events whose (user, minute) is not already in the target."""
    ev = Tables(spark, d).events
    source = ev.filter(F.col("ts") >= F.lit(EVENTS_NEW_FROM).cast("timestamp_ntz"))
    target = ev.filter(F.col("ts") < F.lit(EVENTS_TARGET_BEFORE).cast("timestamp_ntz"))
    return records.skip_existing_minutes(source, target, "ts", ["user_id"]).select("event_id", "user_id", "ts")
