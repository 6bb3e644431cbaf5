"""Jobs over landing files, streams and written tables that Spark derives from
the provided events: scan, route, parse and ingest (S01–S21), streaming
(X01–X08), merges into written tables (I03–I06) and a model run (I05–I09, M04).

Every job works in fresh folders below the shared checkpoint folder and
returns what it wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.nested import json_path
from tessera.operators import keep
from tessera.operators.quality import alerts
from tessera.plans.registry import Model, Registry, global_high_water
from tessera.session import scratch_path
from tessera.sources import jsonl, sinks
from tessera.sources.evolving import EvolvingTable
from tessera.sources.jsonl import FieldSpec
from tessera.sources.schema import infer_schema, schema_from_config
from tessera.sources.tables import Tables
from tessera.streaming import stream

# Fixed values of the re-aim: routes by name, keywords, the declared fields of a landing record
ROUTES = {"sales": r"_purchase\.jsonl$", "traffic": r"_(click|view)\.jsonl$"}
MERGE_BUCKETS, LAST_DELIVERY = 16, "2024-02-01"
SECOND_DELIVERY, SECOND_YEARS = "2024-01-15", "1998-06-10"
KEYWORDS = (("err", "faults"), ("sign", "accounts"))
LANDING_FIELDS = [
    {"name": "event_id", "json_path": "$.id", "type": "INTEGER", "validations": [{"type": "not_null"}]},
    {"name": "at", "json_path": "$.at", "type": "TIMESTAMP", "transform": "timestamp_ms_to_timestamp"},
    {"name": "kind", "json_path": "$.kind", "validations": [{"type": "max_length", "max": 6}]},
    {"name": "reading", "json_path": "$.v.x", "bq_type": "FLOAT", "validations": [{"type": "range", "min": 10, "max": 180}]},
]
NESTED_FIELDS = [
    {"name": "id", "json_path": "$.id", "type": "INTEGER"},
    {"name": "owner", "type": "RECORD", "json_path_base": "$.user", "fields": [
        {"name": "uid", "json_path": "$.uid", "type": "INTEGER"}, {"name": "n", "json_path": "$.deep.n", "type": "INTEGER"}]},
    {"name": "items", "type": "RECORD", "mode": "REPEATED", "json_path": "$.items", "fields": [
        {"name": "n", "json_path": "$.n", "type": "INTEGER"}, {"name": "t", "json_path": "$.t"}]},
    {"name": "points", "type": "RECORD", "mode": "REPEATED", "json_path": "$.points", "fields": [
        {"name": "a", "array_index": 0, "type": "INTEGER"}, {"name": "b", "array_index": 1, "type": "FLOAT"}]},
]


def _events(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events.withColumn("k", json_path("props", "$.k").cast("bigint"))


def _form(n: int) -> Column:
    return F.pmod(F.col("event_id"), F.lit(n))


def _specs(fields: list[dict]) -> list[FieldSpec]:
    return [FieldSpec.from_dict(f) for f in fields]


# ---- landing files ----------------------------------------------------------------

def landing_names(spark: SparkSession, d: str) -> DataFrame:
    """What a landing file's name says: time, service, type, dataset, owner."""
    ev = _events(spark, d)
    stamp = F.date_format("ts", "yyyy_MM_dd_HH_mm")
    named = ev.select(
        "event_id", F.concat(stamp, F.lit("_app_"), F.col("event_type"), F.lit(".jsonl")).alias("file_name"),
        F.when(_form(3) == 0, F.concat(F.lit("export_"), F.col("event_type"), F.lit(".jsonl"))).otherwise(
            F.concat(F.lit("x_app_u"), F.col("user_id").cast("string"), F.lit("_"), F.col("event_type"), F.lit(".jsonl"))
        ).alias("owner_name"))
    parts = jsonl.file_name_parts(named).withColumnRenamed("data_type", "type_in_name")
    routed = jsonl.route_by_regex(parts, ROUTES).withColumnRenamed("dataset", "route")
    routed = jsonl.route_by_keyword(routed, KEYWORDS).withColumnRenamed("dataset", "keyword")
    owned = jsonl.user_and_type_from_name(routed, "app", ["click", "view"], "owner_name")
    return owned.select("event_id", F.col("file_ts").cast("timestamp_ntz").alias("file_at"), "service", "type_in_name",
                        "route", "keyword", "username", "data_type")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """One line per event in six written forms; the file holds one form of one user."""
    ev, form = _events(spark, d), _form(6)
    eid, kind = F.col("event_id").cast("string"), F.col("event_type")
    whole = F.concat(F.lit('{"id": '), eid, F.lit(', "kind": "'), kind, F.lit('", "more": [1, {"a": null}]}'))
    text = (
        F.when(form == 0, whole).when(form == 1, "  ").when(form == 2, "[1, 2]").when(form == 3, F.concat(F.lit('{"id": '), eid))
        .when(form == 4, F.concat(F.lit('{"id": "no number", "kind": "'), kind, F.lit('"}'))).otherwise('"text"'))
    name = F.concat_ws("_", F.lit("user"), F.col("user_id").cast("string"), form.cast("string"))
    return ev.select("event_id", text.alias("value"), name.alias("source_file"))


def parsed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Good lines by a declared schema (a value that does not fit is null), bad lines apart, blank ones skipped."""
    good, bad = jsonl.parse_lines(_lines(spark, d), T.StructType.fromDDL("id bigint, kind string"))
    none = F.lit(None)
    return good.select(F.lit("good").alias("part"), "event_id", "id", "kind").unionByName(
        bad.select(F.lit("bad").alias("part"), "event_id", none.cast("bigint").alias("id"), none.cast("string").alias("kind")))


def raw_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Whole records kept as text with type and source; what is no JSON object is left out."""
    out = jsonl.raw_envelope(_lines(spark, d), "event", extra={"size": F.length("raw_data")})
    return out.select("event_id", "raw_data", "data_type", "source_file", "size", F.col("_dp_inserted_at").isNotNull().alias("stamped"))


def files_without_records(spark: SparkSession, d: str) -> DataFrame:
    """Files none of whose lines is a record."""
    return jsonl.files_without_valid_records(_lines(spark, d), jsonl.is_json_object(F.col("value")))


def declared_fields(spark: SparkSession, d: str) -> DataFrame:
    """Nested, repeated and positional fields by declaration."""
    ev = _events(spark, d)
    raw = F.to_json(F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").alias("uid"), F.struct(F.col("k").alias("n")).alias("deep")).alias("user"),
        F.array(F.struct(F.col("k").alias("n"), F.col("event_type").alias("t")), F.struct(F.lit(1).alias("n"), F.lit("z").alias("t")))
        .alias("items"),
        F.array(F.array(F.col("k").cast("string"), F.col("value").cast("string"))).alias("points")))
    out = jsonl.extract_fields(ev.select(raw.alias("value")), _specs(NESTED_FIELDS))
    return out.select(
        "id", "owner.uid", "owner.n", F.size("items").alias("n_items"), F.get("items", F.lit(0))["n"].alias("first_n"),
        F.get("items", F.lit(1))["t"].alias("second_t"), F.get("points", F.lit(0))["a"].alias("point_a"),
        F.get("points", F.lit(0))["b"].alias("point_b"))


def inferred_fields(spark: SparkSession, d: str) -> DataFrame:
    """The schema inferred over every record, one row per top-level field."""
    ev = _events(spark, d)
    k = F.col("k").cast("string")
    number = F.when(_form(2) == 0, k).otherwise(F.concat(k, F.lit(".5")))
    raw = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "reading": '), number, F.lit(', "kind": "'),
                   F.col("event_type"), F.lit('", "flag": true, "deep": {"n": '), k, F.lit('}, "list": ["a"]}'))
    schema = infer_schema(ev.select(raw.alias("value")))
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "field string, type string")


def _land(spark: SparkSession, events: DataFrame, name: str) -> str:
    """Landing files of JSON lines, one folder per event type, some lines malformed."""
    form = _form(10)
    record = F.to_json(F.struct(
        F.col("event_id").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at"),
        F.col("event_type").alias("kind"), F.struct(F.col("value").alias("x")).alias("v")))
    text = F.when(form == 7, "").when(form == 8, "[1]").when(form == 9, "{broken").otherwise(record)
    path = scratch_path(spark, name)
    events.select("event_type", text.alias("value")).write.partitionBy("event_type").text(path)
    return path


def ingested_events(spark: SparkSession, d: str) -> DataFrame:
    """Land, scan, extract, validate, append by day, quarantine, archive; then what each table holds."""
    landing = _land(spark, _events(spark, d), "landing")
    target, quarantine, archive = (scratch_path(spark, f"ingest-{n}") for n in ("target", "quarantine", "archive"))
    jsonl.ingest(spark, landing, _specs(LANDING_FIELDS), target, quarantine=quarantine, archive_dir=archive,
                 partition_col="at", pattern="*.txt")
    names = ["event_id", F.col("at").cast("timestamp_ntz").alias("at"), "kind", "reading"]
    # a second run finds nothing: the files were moved to the archive
    left = jsonl.scan_jsonl(spark, landing, "*.txt").select(
        F.lit("left").alias("part"), F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("timestamp_ntz").alias("at"),
        F.col("value").alias("kind"), F.lit(None).cast("double").alias("reading"))
    return (
        spark.read.parquet(target).select(F.lit("accepted").alias("part"), *names)
        .unionByName(spark.read.parquet(quarantine).select(F.lit("rejected").alias("part"), *names))
        .unionByName(left))


def ingest_outcome(spark: SparkSession, d: str) -> DataFrame:
    """What one run told: lines of each file by status, the run's figures, a dry run's, alerts."""
    landing = _land(spark, _events(spark, d).repartition("event_type"), "landing")  # a file per event type
    target, specs = scratch_path(spark, "ingest-target"), _specs(LANDING_FIELDS)
    dry = jsonl.ingest(spark, landing, specs, target, dry_run=True, pattern="*.txt")
    run = jsonl.ingest(spark, landing, specs, target, archive_dir=scratch_path(spark, "ingest-archive"), pattern="*.txt",
                       partition_col="at")
    figures = [(part, str(r.files), r.records_read - r.records_rejected, r.records_rejected, r.bad_lines, r.files_archived)
               for part, r in (("dry run", dry), ("run", run))]
    told = alerts({"records_read": run.records_read, "records_rejected": run.records_rejected}, 0.0)
    schema = "part string, name string, accepted long, rejected long, bad long, moved long"
    rows = spark.createDataFrame(figures + [("alert", text, None, None, None, None) for text in told], schema)
    kind = F.regexp_extract("source_file", "event_type=([a-z]+)", 1)
    return run.outcome.select(F.lit("file").alias("part"), kind.alias("name"), "accepted", "rejected", "bad",
                              F.lit(None).cast("long").alias("moved")).unionByName(rows)


def clustered_table(spark: SparkSession, d: str) -> DataFrame:
    """A table clustered by user, written twice (the second run replaces the first): files and rows per user."""
    ev, path = Tables(spark, d).events, scratch_path(spark, "clustered")
    sinks.append(ev, path, cluster_by=["user_id", "ts"], ranges=8)
    sinks.append(ev.filter(F.col("event_type") != "error"), path, cluster_by=["user_id", "ts"], disposition="truncate",
                 ranges=8)
    table = spark.read.parquet(path).select("user_id", F.col("_metadata.file_path").alias("file"))
    lone = table.groupBy("file").agg(F.min("user_id").alias("low"), F.max("user_id").alias("high"))
    per_user = table.groupBy("user_id", "file").agg(F.count(F.lit(1)).alias("n"))
    # a user lies between the bounds of the files that hold rows of it, and of no other file
    pruned = per_user.join(lone, "file").groupBy("user_id").agg(
        F.sum("n").alias("events"), F.count_if((F.col("low") < F.col("user_id")) & (F.col("user_id") < F.col("high")))
        .alias("inside"))
    return pruned.select("user_id", "events", (F.col("inside") <= 1).alias("pruned"))


# Fixed values of the declared load: five nested fields, as a configuration writes them
EXPLICIT_FIELDS = [
    {"name": "id", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "athlete", "type": "RECORD", "fields": [{"name": "id", "type": "INTEGER"}, {"name": "kind", "type": "STRING"}]},
    {"name": "map", "type": "RECORD", "fields": [
        {"name": "line", "type": "STRING"}, {"name": "points", "type": "RECORD", "mode": "REPEATED", "fields": [
            {"name": "at", "type": "DATETIME"}, {"name": "v", "type": "FLOAT"}]}]},
    {"name": "tags", "type": "STRING", "mode": "REPEATED"},
    {"name": "day", "type": "DATE"},
]


def explicit_schema_load(spark: SparkSession, d: str) -> DataFrame:
    """JSON files loaded by a declared nested schema: unknown fields go, what does not fit is null."""
    ev = _events(spark, d)
    points = F.array(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"), F.col("value").alias("v")),
                     F.struct(F.lit(None).cast("string").alias("at"), F.col("k").alias("v")))
    raw = F.to_json(F.struct(
        F.col("event_id").alias("id"), F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("athlete"),
        F.struct(F.when(_form(3) > 0, F.col("props")).alias("line"), F.when(_form(4) > 0, points).alias("points")).alias("map"),
        F.array(F.col("event_type"), F.lit("z")).alias("tags"),
        F.when(_form(5) > 0, F.date_format("ts", "yyyy-MM-dd")).otherwise("no day").alias("day"), F.lit(1).alias("unknown")))
    landing = scratch_path(spark, "explicit")
    ev.select(raw.alias("value")).write.text(landing)
    load = spark.read.schema(schema_from_config(EXPLICIT_FIELDS)).json(landing)
    return load.select(
        "id", F.col("athlete.id").alias("athlete_id"), F.col("athlete.kind").alias("kind"), F.col("map.line").alias("line"),
        F.when(F.col("map.points").isNotNull(), F.size("map.points")).alias("n_points"),
        F.get("map.points", F.lit(0))["at"].alias("first_at"), F.get("map.points", F.lit(1))["v"].alias("second_v"),
        F.array_join("tags", "|").alias("tags"), "day")


def selected_datasets(spark: SparkSession, d: str) -> DataFrame:
    """What a run takes: a list of datasets if the user gives one, else the files of one owner, else all."""
    ev = _events(spark, d)
    name = F.concat(F.lit("x_app_u"), F.col("user_id").cast("string"), F.lit("_"), F.col("event_type"), F.lit(".jsonl"))
    routed = jsonl.route_by_regex(ev.select("event_id", name.alias("file_name")), ROUTES, default="other")
    owned = jsonl.user_and_type_from_name(routed, "app", ["click", "view"])
    out = None
    for mode, choice in (("list", {"requested": ["sales", "traffic"], "owner": "u7"}), ("owner", {"owner": "u7"}), ("all", {})):
        part = jsonl.select_datasets(owned, **choice).groupBy("dataset").agg(F.count(F.lit(1)).alias("files")).select(
            F.lit(mode).alias("mode"), "dataset", "files")
        out = part if out is None else out.unionByName(part)
    return out


# ---- streams ----------------------------------------------------------------------

def _event_stream(spark: SparkSession, events: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    events.write.parquet(path)
    return spark.readStream.schema(events.schema).parquet(path)


def _drained(df: DataFrame, name: str) -> DataFrame:
    """Run a stream until its files are read, then its sink as a table."""
    spark = df.sparkSession
    sink = scratch_path(spark, f"{name}-sink")
    stream.run_available_now(df, name, sink_path=sink, checkpoint=scratch_path(spark, f"{name}-state"))
    return spark.read.schema(df.schema).parquet(sink)


def _ntz(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
                       for f in df.schema.fields])


def streamed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Days, Monday weeks and sliding weeks that the watermark has closed."""
    ev = Tables(spark, d).events
    days = stream.tumbling_aggregates(_event_stream(spark, ev, "stream-days"), "ts", "value", group=["event_type"])
    weeks = stream.tumbling_aggregates(_event_stream(spark, ev, "stream-weeks"), "ts", "value", unit="week", group=["event_type"])
    slides = stream.sliding_counts(_event_stream(spark, ev, "stream-slides"), "ts", ["event_type"])
    out = None
    for name, df in (("day", days), ("week", weeks), ("slide", slides.withColumnRenamed("plays", "events"))):
        part = _ntz(_drained(df, f"windows-{name}")).select(F.lit(name).alias("unit"), "window_start", "window_end", "event_type", "events")
        out = part if out is None else out.unionByName(part)
    return out


def streamed_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Every event delivered twice, kept once."""
    ev = Tables(spark, d).events.select("event_id", "ts", "user_id")
    twice = _event_stream(spark, ev.unionByName(ev), "stream-twice")
    return _ntz(_drained(stream.dedupe_within_watermark(twice, ["event_id"], "ts"), "dedupe"))


def streamed_merge(spark: SparkSession, d: str) -> DataFrame:
    """Landed lines merged into a table; corrected records land later and win."""
    ev = _events(spark, d)
    fixed = ev.filter(_form(2) == 0).withColumn("value", F.col("value") + 1000).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    target, state = scratch_path(spark, "merge-target"), scratch_path(spark, "merge-state")
    landing = scratch_path(spark, "merge-landing")
    writer = stream.merge_batch_writer(target, ["event_id"], "at", buckets=MERGE_BUCKETS)
    for part in (ev, fixed):  # two deliveries into one landing folder, one checkpoint
        record = F.to_json(F.struct(
            F.col("event_id").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at"),
            F.col("event_type").alias("kind"), F.struct(F.col("value").alias("x")).alias("v")))
        part.select(record.alias("value")).write.mode("append").text(landing)
        lines = stream.landing_stream(spark, landing, pattern="*.txt")
        stream.run_available_now(stream.parsed_stream(lines, _specs(LANDING_FIELDS)), "landed", writer=writer, checkpoint=state)
    return spark.read.parquet(target).select("event_id", F.col("at").cast("timestamp_ntz").alias("at"), "kind", "reading")


def streamed_window_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """The greedy 24-hour dedupe over two deliveries of the events."""
    ev = Tables(spark, d).events.select("user_id", "event_id", "ts")
    half = F.col("ts") < F.lit(SECOND_DELIVERY).cast("timestamp_ntz")
    landing, target, state = (scratch_path(spark, f"greedy-{n}") for n in ("landing", "target", "state"))
    writer = stream.greedy_dedupe_writer(target, "user_id", "ts", 24.0)
    for part in (ev.filter(half), ev.filter(~half)):
        part.write.mode("append").parquet(landing)
        stream.run_available_now(spark.readStream.schema(ev.schema).parquet(landing), "greedy", writer=writer, checkpoint=state)
    return spark.read.parquet(target).select(*ev.columns)


def streamed_months(spark: SparkSession, d: str) -> DataFrame:
    """Calendar months of the order lines that the watermark has closed, from two deliveries."""
    lines = Tables(spark, d).lineitem.select("l_shipdate", "l_returnflag", "l_quantity")
    landing, sink, state = (scratch_path(spark, f"months-{n}") for n in ("landing", "sink", "state"))
    half = F.col("l_shipdate") < F.lit(SECOND_YEARS).cast("timestamp_ntz")
    for part in (lines.filter(half), lines.filter(~half)):  # a month may stay open from one run to the next
        part.write.mode("append").parquet(landing)
        source = spark.readStream.schema(lines.schema).parquet(landing)
        months = stream.tumbling_aggregates(source, "l_shipdate", "l_quantity", unit="month", group=["l_returnflag"])
        stream.run_available_now(months, "months", sink_path=sink, checkpoint=state, state_store=stream.ROCKSDB[1])
    return _ntz(spark.read.schema(months.schema).parquet(sink)).withColumnRenamed("total", "quantity")


def streamed_chain_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """The greedy 24-hour dedupe over four deliveries, each with events of all days: most rows come late."""
    ev = Tables(spark, d).events.select("user_id", "event_id", "ts")
    landing, state = (scratch_path(spark, f"chains-{n}") for n in ("landing", "state"))
    chains = stream.GreedyChains(spark, scratch_path(spark, "chains"), "user_id", "ts", 24.0)
    for form in (2, 0, 3, 1):
        ev.filter(_form(4) == form).write.mode("append").parquet(landing)
        stream.run_available_now(spark.readStream.schema(ev.schema).parquet(landing), "chains", writer=chains.writer(),
                                 checkpoint=state)
    return chains.table().select(*ev.columns)


# ---- written tables ---------------------------------------------------------------

def merged_days(spark: SparkSession, d: str) -> DataFrame:
    """A table by day; a third of its keys come again on the next day and move."""
    ev = Tables(spark, d).events
    day = F.to_date("ts")
    path = scratch_path(spark, "merge-days")
    keep.merge_into_path(spark, ev.select("event_id", "value", day.alias("day")), path, ["event_id"], partition_by=["day"],
                         buckets=MERGE_BUCKETS)
    moved = ev.filter(_form(3) == 0).select("event_id", (F.col("value") + 1).alias("value"), F.date_add(day, 1).alias("day"))
    out = keep.merge_into_path(spark, moved, path, ["event_id"], partition_by=["day"], buckets=MERGE_BUCKETS)
    return out.select("event_id", "value", "day", F.col("_dp_updated_at").isNotNull().alias("stamped"))


def evolved_table(spark: SparkSession, d: str) -> DataFrame:
    """Four deliveries into one table, with a new field, a new nested field, an INTEGER that becomes FLOAT
    and, last, the first form again; all of them read back in the widest form."""
    ev = _events(spark, d).withColumn("form", _form(4))
    table = EvolvingTable(spark, scratch_path(spark, "evolving"))
    part = lambda n: ev.filter(F.col("form") == n)
    k, user = F.col("k"), F.col("user_id")
    table.append(part(0).select("event_id", k.alias("reading"), F.struct(user.alias("id")).alias("owner")))
    table.append(part(1).select("event_id", k.alias("reading"), F.struct(user.alias("id")).alias("owner"), "event_type"))
    table.append(part(2).select(
        F.struct(k.alias("n"), user.alias("id")).alias("owner"), "event_id", F.col("value").alias("reading"),
        F.array(F.struct(k.alias("a"))).alias("marks")))
    table.append(part(3).select("event_id", k.alias("reading"), F.struct(user.alias("id")).alias("owner"),
                                F.array(F.struct(k.alias("a"), F.col("event_type").alias("b"))).alias("marks")))
    return table.read("version").select(
        "event_id", "reading", F.col("owner.id").alias("owner_id"), F.col("owner.n").alias("owner_n"), "event_type",
        F.get("marks", F.lit(0))["a"].alias("mark_a"), F.get("marks", F.lit(0))["b"].alias("mark_b"), "version")


def model_run(spark: SparkSession, d: str) -> DataFrame:
    """A view, a table and an incremental model run twice, the second time over more events."""
    ev = Tables(spark, d).events
    registry = Registry(scratch_path(spark, "models"))
    registry.add(Model("lake_events", lambda e: e.select("event_id", "user_id", "ts"), ["events"], layer="lake"))
    registry.add(Model("hub_user_days", lambda e: e.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n")), ["lake_events"], layer="hub", materialized="table"))
    registry.add(Model("product_users", lambda h: h.groupBy("user_id").agg(
        F.sum("n").alias("events"), F.count(F.lit(1)).alias("days")).withColumn("_dp_inserted_at", F.current_timestamp()),
        ["hub_user_days"], materialized="incremental", unique_key=["user_id"]))
    early = ev.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    registry.run(spark, {"events": early})
    return registry.run(spark, {"events": ev}, select=["product_users"])["product_users"].select("user_id", "events", "days")


def model_increments(spark: SparkSession, d: str) -> DataFrame:
    """The source's high-water mark, carried through a hub model, bounds the next run of an incremental one.

    The second run delivers every event again with another reading, and a seventh of them once more at a later day:
    rows up to the mark of the first run are left alone, newer ones are merged, also over older keys.
    """
    ev, mark = Tables(spark, d).events, "max__dp_inserted_at"
    registry = Registry(scratch_path(spark, "increments"))
    registry.add(Model("lake_deliveries", lambda e: e, ["deliveries"], layer="lake"))
    registry.add(Model("hub_deliveries", lambda e: global_high_water(e, name=mark), ["lake_deliveries"], layer="hub",
                       materialized="table"))
    registry.add(Model("product_readings", lambda h: h, ["hub_deliveries"], materialized="incremental",
                       unique_key=["event_id"], updated_col=mark, stamp=False))
    first = ev.select("event_id", F.col("value").alias("reading"), F.to_date("ts").alias("_dp_inserted_at"), "ts")
    early = first.filter(F.col("ts") < F.lit(SECOND_DELIVERY).cast("timestamp_ntz")).drop("ts")
    late = first.drop("ts").withColumn("reading", F.col("reading") + F.when(_form(7) == 0, 5000).otherwise(1000)).withColumn(
        "_dp_inserted_at", F.when(_form(7) == 0, F.lit(LAST_DELIVERY).cast("date")).otherwise(F.col("_dp_inserted_at")))
    registry.run(spark, {"deliveries": early})
    out = registry.run(spark, {"deliveries": late})["product_readings"]
    return out.select("event_id", "reading", F.col("_dp_inserted_at").alias("delivered"), F.col(mark).alias("high_water"))


def legacy_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Raw files with number lists in records in lists, rewritten, read back, every value."""
    emb = Tables(spark, d).embeddings
    e = F.transform("embedding", lambda x: x.cast("double"))
    rows = lambda w: F.transform(F.sequence(F.lit(0), (F.ceil(F.size("embedding") / w) - 1).cast("int")),
                                 lambda i: F.slice(e, i * w + 1, w))
    pairs = F.filter(rows(2), lambda r: F.size(r) == 2)
    raw = emb.select(F.to_json(F.struct(
        F.col("vec_id").alias("id"), pairs.alias("pair"),
        F.array(F.struct(F.lit("x").alias("name"), F.struct(rows(3).alias("m")).alias("deep"))).alias("list"),
        F.array(F.array(F.struct(pairs.alias("cell")))).alias("grid"))).alias("value"))
    landing, out = scratch_path(spark, "legacy"), scratch_path(spark, "legacy-out")
    raw.write.text(landing)
    jsonl.retransform_legacy(spark, landing, out, pattern="*.txt")
    wide = "array<struct<val_0:double,val_1:double,val_2:double>>"
    pair = "array<struct<timestamp:double,value:double>>"
    back = spark.read.schema(f"id long, pair {pair}, list array<struct<name:string,deep:struct<m:{wide}>>>, "
                             f"grid array<array<struct<cell:{pair}>>>").json(out)
    none = F.lit(None).cast("double")
    two = lambda c, part: back.select("id", F.lit(part).alias("part"), F.posexplode(c).alias("row_no", "r")).select(
        "id", "part", "row_no", F.col("r.timestamp").alias("v0"), F.col("r.value").alias("v1"), none.alias("v2"))
    three = back.select("id", F.lit("deep").alias("part"), F.posexplode(F.get("list", F.lit(0))["deep"]["m"]).alias("row_no", "r"))
    return two("pair", "pair").unionByName(two(F.get(F.get("grid", F.lit(0)), F.lit(0))["cell"], "list")).unionByName(
        three.select("id", "part", "row_no", F.col("r.val_0").alias("v0"), F.col("r.val_1").alias("v1"), F.col("r.val_2").alias("v2")))


QUERIES = {
    f.__name__: f
    for f in (
        landing_names, parsed_lines, raw_envelopes, files_without_records, declared_fields, inferred_fields, ingested_events,
        ingest_outcome, explicit_schema_load, selected_datasets, clustered_table, streamed_windows, streamed_dedupe, streamed_merge, streamed_window_dedupe, streamed_months, streamed_chain_dedupe, merged_days,
        model_run, model_increments, evolved_table, legacy_arrays,
    )
}
