"""Record-level operators over raw text that Spark derives from the provided
tables (T01–T09, N02, N05–N07, N10, N12–N22, N24, N25, N28, N29, C11, C12, Q06, Q12).

Every event, order or vector becomes a raw record of the kind the landing
files hold (text stamps, JSON objects, positional arrays, measure lists), with
the malformed forms those files show, and is read back by the operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import transforms as tr
from tessera.functions.columns import datetime_of, safe_timestamp_millis
from tessera.functions.nested import (
    drop_null_entries,
    flatten_by_width,
    flatten_nested_arrays,
    json_array_of_struct,
    json_first_value,
    json_path,
    matrix_widths,
    repair_array,
    struct_from_positions,
)
from tessera.operators import quality, records
from tessera.sources.tables import Tables

# Fixed values of the re-aim: measure codes, the device window, the epoch range
MEASURES = {1: "weight", 4: "height", 77: "hydration"}
EPOCH_RANGE = ("2024-01-05", "2024-01-09")
PULL_AT, PULL_ZONE = "2024-01-20 12:00:00", "Europe/Paris"
WIDTH_NAMES = {2: ("time", "level"), 3: ("time", "level", "status"), 4: ("time", "low", "high", "status")}


def _events(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.withColumn("k", json_path("props", "$.k").cast("bigint"))


def _form(n: int) -> Column:
    """Which of ``n`` written forms a record takes."""
    return F.pmod(F.col("event_id"), F.lit(n))


def typed_transforms(spark: SparkSession, d: str) -> DataFrame:
    """Each transform over five written forms, among them malformed ones (null)."""
    ev, form = _events(spark, d), _form(5)
    day, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    k = F.col("k").cast("string")
    written = ev.select(
        "event_id",
        F.when(form == 0, clock).when(form == 1, "n/a").otherwise(millis).alias("stamp"),
        F.when(form == 0, F.concat(day, F.lit(".0"))).when(form == 1, "soon").when(form == 2, iso).otherwise(day).alias("day"),
        F.when(form == 0, clock).when(form == 1, "later").otherwise(iso).alias("clock"),
        F.when(form == 0, k).when(form == 1, F.concat(k, F.lit(".5"))).when(form == 2, F.concat(F.lit(" "), k, F.lit(" ")))
        .when(form == 3, F.concat(F.lit("-1"), k)).otherwise("x").alias("number"),
        F.when(form == 0, F.concat(iso, F.lit("Z"))).when(form == 1, F.concat(iso, F.lit("+02:00"))).when(form == 2, iso)
        .otherwise("?").alias("iso"),
        F.when(form == 0, F.substring(day, 1, 4)).when(form == 1, F.substring(day, 1, 7)).when(form == 2, day)
        .otherwise("spring").alias("release"),
    )
    return written.select(
        "event_id",
        tr.timestamp_ms_to_timestamp("stamp").cast("timestamp_ntz").alias("stamp_at"),
        tr.timestamp_ms_to_date("stamp").alias("stamp_day"),
        tr.string_to_date("day").alias("day"),
        tr.string_to_timestamp("clock").cast("timestamp_ntz").alias("clock_at"),
        tr.string_to_int("number").alias("whole"),
        tr.string_to_float("number").alias("number"),
        tr.string_to_timestamp_iso("iso").cast("timestamp_ntz").alias("iso_at"),
        tr.string_to_date_flexible("release").alias("release_day"),
    )


def cast_values(spark: SparkSession, d: str) -> DataFrame:
    """Values cast on request; what cannot be cast is null."""
    ev, form = _events(spark, d), _form(6)
    text = (
        F.when(form == 0, "true").when(form == 1, "false").when(form == 2, "0")
        .when(form == 3, F.concat(F.col("k").cast("string"), F.lit(".5"))).when(form == 4, "word").otherwise("")
    )
    # every third number of milliseconds lies beyond the year 9999
    ms = F.unix_millis(F.col("ts").cast("timestamp")) * F.when(_form(3) == 0, F.lit(1000)).otherwise(F.lit(1))
    written = ev.select("event_id", text.alias("text"), ms.alias("ms"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
    return written.select(
        "event_id",
        tr.cast_value("text", "INT64").alias("as_int"),
        tr.cast_value("text", "FLOAT64").alias("as_float"),
        tr.cast_value("text", "STRING").alias("as_text"),
        tr.cast_value("text", "BOOL").alias("as_bool"),
        safe_timestamp_millis("ms").cast("timestamp_ntz").alias("ms_at"),
        datetime_of("at").alias("local_at"),
    )


def first_member(spark: SparkSession, d: str) -> DataFrame:
    """``$.m.*.v``, the first member of an object whatever its name."""
    ev, form = _events(spark, d), _form(4)
    k = F.col("k").cast("string")
    full = F.concat(F.lit('{"m": {"x'), k, F.lit('": {"v": '), k, F.lit('}, "a": {"v": -1}}}'))
    raw = F.when(form == 0, F.lit('{"m": {}}')).when(form == 1, F.lit('{"n": 1}')).otherwise(full)
    return ev.select("event_id", raw.alias("raw")).select(
        "event_id", json_first_value("raw", "$.m", "v").cast("bigint").alias("first_v"))


def inherited_entries(spark: SparkSession, d: str) -> DataFrame:
    """Orders as JSON with nested lines; a line without a date of its own takes its order's."""
    t = Tables(spark, d)
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    line = F.struct(
        F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_linenumber") == 1, day("l_shipdate")).alias("day"),
        F.array("l_returnflag", "l_linestatus").alias("flags"))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))  # of one order
    raw = lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.to_json(F.struct(F.col("o_orderkey").alias("order"), day("o_orderdate").alias("day"), "lines")).alias("raw"))
    element = T.StructType.fromDDL("part bigint, quantity double, day string, flags array<string>")
    parsed = raw.select(
        json_path("raw", "$.order").cast("bigint").alias("order_key"), json_path("raw", "$.day").alias("order_day"),
        json_array_of_struct("raw", "$.lines", element).alias("lines"))
    entries = records.explode_entries(parsed, "lines", {"day": "order_day", "order_key": "order_key"})
    return entries.select("order_key", "part", "quantity", "day", F.get("flags", F.lit(1)).alias("status"))


def _matrix() -> Column:
    """A vector's values as rows of 2, 3 or 4, by its id; the last row may be shorter."""
    width = (F.pmod(F.col("vec_id"), F.lit(3)) + 2).cast("int")
    e = F.transform("embedding", lambda x: x.cast("double"))
    return F.transform(F.sequence(F.lit(0), (F.ceil(F.size("embedding") / width) - 1).cast("int")),
                       lambda i: F.slice(e, i * width + 1, width))


def arrays_by_width(spark: SparkSession, d: str) -> DataFrame:
    """Positional arrays named by their width."""
    emb = Tables(spark, d).embeddings.select("vec_id", _matrix().alias("rows"))
    return emb.select("vec_id", F.posexplode(flatten_by_width("rows", WIDTH_NAMES)).alias("row_no", "r")).select(
        "vec_id", "row_no", "r.*")


def wide_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Every undeclared ``[[…]]`` of a record found by its schema, none of its values lost."""
    emb = Tables(spark, d).embeddings.select(F.struct("vec_id", _matrix().alias("rows")).alias("record"))
    flat = emb.select(flatten_nested_arrays(F.col("record"), emb.schema["record"].dataType, matrix_widths(emb), "record")
                      .alias("record"))
    return flat.select("record.vec_id", F.posexplode("record.rows").alias("row_no", "r")).select("vec_id", "row_no", "r.*")


def positional_fields(spark: SparkSession, d: str) -> DataFrame:
    """``[[stamp, reading]]`` by position, typed."""
    ev = _events(spark, d)
    pairs = F.array(F.array(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("k").cast("string")), F.array(F.lit("2024-01-01 00:00:00")))
    named = struct_from_positions(pairs, ["at", "reading"], ["timestamp_ntz", "bigint"])
    return ev.select("event_id", F.posexplode(named).alias("point", "p")).select("event_id", "point", "p.at", "p.reading")


def repaired_arrays(spark: SparkSession, d: str) -> DataFrame:
    """A missing or null list is empty, a scalar a list of one; null entries of a map go."""
    ev, form = _events(spark, d), _form(4)
    raw = (
        F.when(form == 0, F.concat(F.lit('{"tags": ["'), F.col("event_type"), F.lit('", "'), F.col("k").cast("string"), F.lit('"]}')))
        .when(form == 1, F.concat(F.lit('{"tags": "'), F.col("event_type"), F.lit('"}')))
        .when(form == 2, F.lit('{"tags": null}')).otherwise(F.lit("{}")))
    entries = F.create_map(
        F.lit("k"), F.when(form != 3, F.col("k")), F.lit("user"), F.when(form < 2, F.col("user_id")))
    tags = repair_array(raw, "$.tags", T.StringType())
    return ev.select(
        "event_id", F.size(tags).alias("n_tags"), F.array_join(tags, "|").alias("tags"),
        F.size(drop_null_entries(entries)).alias("n_entries"))


def enriched_orders(spark: SparkSession, d: str) -> DataFrame:
    """Each order with its customer attached as one struct (null without one)."""
    t = Tables(spark, d)
    customers = t.customer.filter(F.pmod("c_custkey", F.lit(3)) > 0).withColumnRenamed("c_custkey", "o_custkey")
    out = records.enrich(t.orders, customers, "o_custkey", "customer")
    return out.select("o_orderkey", "o_custkey", F.col("customer.c_name").alias("c_name"),
                      F.col("customer.c_acctbal").alias("c_acctbal"), F.col("customer").isNull().alias("unknown"))


def recovered_ids(spark: SparkSession, d: str) -> DataFrame:
    """An id the record lacks is read from its file's name; records without either go."""
    ev = _events(spark, d)
    name = F.when(_form(7) == 0, F.lit("/landing/part.jsonl")).otherwise(
        F.concat(F.lit("/landing/2024/"), F.col("event_id").cast("string"), F.lit("_"), F.col("event_type"), F.lit(".jsonl")))
    raw = ev.select(F.when(_form(3) > 0, F.col("event_id")).alias("record_id"), name.alias("source_file"), "user_id")
    return records.recover_key(raw, "record_id", "source_file")


def body_measures(spark: SparkSession, d: str) -> DataFrame:
    """Measure groups unpacked, those not measured by a device left out, body figures derived."""
    ev = _events(spark, d)
    measure = lambda kind, value, unit: F.struct(
        F.lit(kind).alias("type"), value.cast("bigint").alias("value"), F.lit(unit).alias("unit"))
    group = F.struct(
        "event_id", _form(5).cast("int").alias("attrib"),
        F.array_compact(F.array(
            measure(1, (F.col("k") + 50) * 1000, -3), measure(4, F.col("user_id") % 40 + 150, -2),
            F.when(_form(6) > 0, measure(77, F.col("k") * 10 + 1, -1)))).alias("measures"))
    raw = ev.select(F.to_date("ts").alias("day"), F.array(group).alias("payload"))
    rows = records.envelope(raw, "payload", F.lit("2024-02-01"), "body").select("data.*", "date", "data_type")
    wide = records.pivot_measures(records.device_sourced(rows), ["event_id", "date", "data_type"], "measures", MEASURES, "weight")
    return records.body_metrics(wide, "weight", "height", "hydration").select(
        "event_id", "date", "data_type", "weight", "bmi", "hydration_pct")


def epoch_window(spark: SparkSession, d: str) -> DataFrame:
    """Records whose end falls in a range of days, and whether they are newer than last evening's pull."""
    ev = _events(spark, d).withColumn("end_epoch", F.unix_seconds(F.col("ts").cast("timestamp")))
    recent = records.since_yesterday_hour("at", PULL_ZONE, now=F.lit(PULL_AT).cast("timestamp"))
    inside = records.epoch_range_filter(ev, "end_epoch", *EPOCH_RANGE).select(F.lit("range").alias("part"), "event_id", "end_epoch")
    newer = ev.withColumn("at", F.col("ts").cast("timestamp")).filter(recent).select(F.lit("pull").alias("part"), "event_id", "end_epoch")
    return inside.unionByName(newer)


def required_and_filled(spark: SparkSession, d: str) -> DataFrame:
    """Q06, Q12: required fields of a record checked, then declared null replacements."""
    ev = _events(spark, d).select(
        "event_id", F.when(_form(3) > 0, F.col("event_type")).alias("kind"), F.when(_form(4) > 0, F.col("k")).alias("k"))
    checked = quality.with_errors(ev, quality.required_fields(["kind", "k"]))
    counted = checked.select("event_id", "kind", "k", F.size("_errors").alias("n_errors"))
    return quality.fill_nulls(counted, {"kind": "unknown", "k": -1})


QUERIES = {
    f.__name__: f
    for f in (
        typed_transforms, cast_values, first_member, inherited_entries, arrays_by_width, wide_arrays, positional_fields,
        repaired_arrays, enriched_orders, recovered_ids, body_measures, epoch_window, required_and_filled,
    )
}
