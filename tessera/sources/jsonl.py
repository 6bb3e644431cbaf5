"""Landing-file ingest (S01–S22): newline-delimited JSON → typed, validated rows.

Read path: ``spark.read.text`` over the landing directory (glob filter,
recursive lookup), file name from the ``_metadata`` column, routing by
regex on the name, ``from_json`` parse with a corrupt-record split,
config-driven field extraction (paths, wildcards, nested records,
transforms, casts), rule validation, lineage stamps.  One DataFrame covers
all files; the write is one job; files are archived only after it commits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.nested import json_first_value
from tessera.functions.transforms import apply_transform, cast_value
from tessera.operators import quality
from tessera.sources.schema import spark_type

# Fixed value: landing file names are ``YYYY_MM_DD_HH_MM_{service}_{type}.jsonl``
FILE_NAME_PATTERN = r"^(\d{4})_(\d{2})_(\d{2})_(\d{2})_(\d{2})_([^_]+)_(.+)\.jsonl$"


def scan_jsonl(spark: SparkSession, root: str, pattern: str = "*.jsonl", recursive: bool = True,
               prefix: str | None = None) -> DataFrame:
    """Every line of every matching file, with its source file.

    Columns: ``value`` (line text), ``source_file`` (full path), ``file_name``.
    Splitting across tasks is by file block; no file is read on the driver.
    """
    reader = spark.read.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(root).select("value", F.col("_metadata.file_path").alias("source_file"),
                                  F.col("_metadata.file_name").alias("file_name"))
    if prefix:
        df = df.filter(F.col("file_name").startswith(prefix))
    return df


def file_name_parts(df: DataFrame, col: str = "file_name") -> DataFrame:
    """Parse ``YYYY_MM_DD_HH_MM_{service}_{type}.jsonl`` into columns."""
    c = F.col(col)
    ts = F.concat_ws("", *[F.regexp_extract(c, FILE_NAME_PATTERN, i) for i in range(1, 6)])
    return df.withColumn("file_ts", F.try_to_timestamp(ts, F.lit("yyyyMMddHHmm"))).withColumn(
        "service", F.nullif(F.regexp_extract(c, FILE_NAME_PATTERN, 6), F.lit(""))).withColumn(
        "data_type", F.nullif(F.regexp_extract(c, FILE_NAME_PATTERN, 7), F.lit("")))


def route_by_regex(df: DataFrame, routes: dict[str, str], col: str = "file_name", default=None) -> DataFrame:
    """dataset = first route whose regex matches the file name."""
    expr = None
    for dataset, rx in routes.items():
        cond = F.col(col).rlike(rx)
        expr = F.when(cond, F.lit(dataset)) if expr is None else expr.when(cond, F.lit(dataset))
    return df.withColumn("dataset", expr.otherwise(F.lit(default)) if expr is not None else F.lit(default))


def route_by_keyword(df: DataFrame, keywords: Sequence[tuple[str, str]], col: str = "file_name",
                     default: str = "unknown") -> DataFrame:
    """Ordered first match of ``(keyword, dataset)`` pairs, else ``default``."""
    expr = None
    for kw, dataset in keywords:
        cond = F.lower(F.col(col)).contains(kw.lower())
        expr = F.when(cond, F.lit(dataset)) if expr is None else expr.when(cond, F.lit(dataset))
    return df.withColumn("dataset", expr.otherwise(F.lit(default)) if expr is not None else F.lit(default))


def user_and_type_from_name(df: DataFrame, service: str, types: Sequence[str], col: str = "file_name") -> DataFrame:
    """``…{service}_{user}_{type}.jsonl`` tokens → username + type.

    The token after ``service`` is the user, the next one the type; if the
    type token is missing a known type keyword in the name is used; else
    both fall back to ``unknown``.
    """
    stem = F.regexp_replace(F.col(col), r"\.jsonl$", "")
    tokens = F.split(stem, "_")
    pos = F.array_position(tokens, F.lit(service))  # 1-based, 0 when absent
    user = F.when(pos > 0, F.get(tokens, pos.cast("int")))
    typ = F.when(pos > 0, F.get(tokens, (pos + 1).cast("int")))
    kw = None
    for t in types:
        cond = F.lower(stem).contains(t.lower())
        kw = F.when(cond, F.lit(t)) if kw is None else kw.when(cond, F.lit(t))
    return df.withColumn("username", F.coalesce(user, F.lit("unknown"))).withColumn(
        "data_type", F.coalesce(typ, kw, F.lit("unknown")))


def is_json_object(value: Column) -> Column:
    """Line is syntactically valid JSON and an object (not an array or scalar)."""
    return F.try_parse_json(value).isNotNull() & F.ltrim(value).startswith("{")


def parse_lines(lines: DataFrame, schema: T.StructType, value_col: str = "value"):
    """``(good, bad)`` — blank lines are skipped, malformed lines go to ``bad``.

    A line is bad when it is not a JSON object (syntax error, top-level
    array or scalar).  A good line whose field does not fit the schema keeps
    the rest of its fields and gets null there (§7.4 #7: a promoted struct
    nulls the scalar values), via ``from_json`` PERMISSIVE partial results.
    """
    non_blank = lines.filter(F.trim(F.col(value_col)) != "")
    ok = is_json_object(F.col(value_col))
    others = [c for c in lines.columns if c != value_col]
    parsed = non_blank.filter(ok).withColumn("_p", F.from_json(F.col(value_col), schema, {"mode": "PERMISSIVE"}))
    good = parsed.select(*[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields],
                         F.col(value_col).alias("raw_data"), *others)
    bad = non_blank.filter(~ok).select(F.col(value_col).alias("raw_line"), *others)
    return good, bad


def with_lineage(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Ingestion time (one value for the whole write) + source file."""
    return df.withColumn("_dp_inserted_at", F.current_timestamp()).withColumn("source_file", F.col(file_col))


def raw_envelope(lines: DataFrame, data_type: str | Column, value_col: str = "value",
                 extra: dict[str, Column] | None = None) -> DataFrame:
    """Whole record as ``raw_data`` + ``data_type`` + lineage; invalid JSON dropped."""
    valid = is_json_object(F.col(value_col))
    dt = data_type if isinstance(data_type, Column) else F.lit(data_type)
    out = lines.filter(valid).select(F.col(value_col).alias("raw_data"), dt.alias("data_type"),
                                     *[c for c in lines.columns if c != value_col and c != "data_type"])
    for name, c in (extra or {}).items():
        out = out.withColumn(name, c)
    return with_lineage(out) if "source_file" in out.columns else out


def files_without_valid_records(lines: DataFrame, good_flag: Column, file_col: str = "source_file") -> DataFrame:
    """Files where no line produced a valid record (one row per file)."""
    return lines.groupBy(file_col).agg(F.count_if(good_flag).alias("_valid")).filter(
        F.col("_valid") == 0).select(file_col)


# ---- config-driven extraction (S14, N01–N07, T01–T09) --------------------------------

def _rule_map(d: dict) -> dict:
    """A field's rules by name, from the mapping form or the list form (``- type: range``, ``min: 0``)."""
    rules = d.get("validations") or {}
    if not isinstance(rules, dict):
        out: dict = {}
        for r in rules:
            kind, rest = r["type"], {k: v for k, v in r.items() if k != "type"}
            if kind in ("not_null", "positive"):
                out[kind] = True
            elif kind in ("range", "date_range", "max_length"):
                out |= {"max_length": rest.get("max_length", rest.get("max"))} if kind == "max_length" else rest
            else:
                raise ValueError(f"unknown rule {kind!r} of field {d.get('name')!r}")
        rules = out
    return rules if d.get("max_length") is None else rules | {"max_length": d["max_length"]}


@dataclass
class FieldSpec:
    """One declared field: JSON path, type, mode, transform, rules, nested fields."""

    name: str
    json_path: str | None = None
    type: str = "STRING"
    mode: str = "NULLABLE"
    transform: str | None = None
    json_path_base: str | None = None
    array_index: int | None = None
    validations: dict = field(default_factory=dict)
    fields: list["FieldSpec"] = field(default_factory=list)

    @staticmethod
    def from_dict(d: dict) -> "FieldSpec":
        return FieldSpec(
            name=d["name"], json_path=d.get("json_path"), type=d.get("bq_type") or d.get("type", "STRING"),
            mode=d.get("mode", "NULLABLE"), transform=d.get("transform"), json_path_base=d.get("json_path_base"),
            array_index=d.get("array_index"), validations=_rule_map(d),
            fields=[FieldSpec.from_dict(x) for x in d.get("fields") or []],
        )


def _get_path(json_text: Column, path: str | None) -> Column:
    """JSON text at ``path``; ``*`` takes the first member of an object."""
    if not path or path == "$":
        return json_text
    p = path if path.startswith("$") else f"$.{path}"
    if ".*" in p:
        head, _, tail = p.partition(".*")
        first = json_first_value(json_text, head)
        return _get_path(first, "$" + tail) if tail else first
    return F.get_json_object(json_text, p)


def _typed(value_text: Column, spec: FieldSpec) -> Column:
    if spec.transform:
        v = apply_transform(spec.transform, value_text)
        return v.cast(spark_type(spec.type)) if spec.type.upper() not in ("TIMESTAMP", "DATE", "DATETIME") else v
    t = spec.type.upper()
    if t in ("INTEGER", "INT64", "FLOAT", "FLOAT64", "BOOLEAN", "BOOL", "STRING"):
        return cast_value(value_text, t)
    if t == "TIMESTAMP":
        return F.try_to_timestamp(value_text)
    if t == "DATE":
        return F.try_to_date(value_text)
    return value_text.cast(spark_type(spec.type))


def field_column(json_text: Column, spec: FieldSpec) -> Column:
    """Build the typed column for one spec from the record's JSON text."""
    is_record = spec.type.upper() == "RECORD" and spec.fields
    if not is_record:
        raw = _get_path(json_text, spec.json_path)
        if spec.array_index is not None:
            raw = F.get(F.from_json(raw, T.ArrayType(T.StringType())), F.lit(spec.array_index))
        return _typed(raw, spec)
    base = _get_path(json_text, spec.json_path_base or spec.json_path)
    if spec.mode.upper() == "REPEATED":
        elements = F.from_json(base, T.ArrayType(T.StringType()))

        def one(el):
            is_list = F.ltrim(el).startswith("[")
            cols = []
            for sub in spec.fields:
                if sub.array_index is not None:
                    positional = F.get(F.from_json(el, T.ArrayType(T.StringType())), F.lit(sub.array_index))
                    cols.append(F.when(is_list, _typed(positional, sub)).otherwise(
                        field_column(el, sub) if sub.json_path else F.lit(None).cast(spark_type(sub.type))
                    ).alias(sub.name))
                else:
                    cols.append(F.when(~is_list, field_column(el, sub)).alias(sub.name))
            return F.struct(*cols)

        return F.when(F.ltrim(base).startswith("["), F.transform(elements, one))
    members = [field_column(base, sub).alias(sub.name) for sub in spec.fields]
    return F.when(F.ltrim(base).startswith("{"), F.struct(*members))


def extract_fields(df: DataFrame, specs: Sequence[FieldSpec], raw_col: str = "value",
                   keep_raw: bool = True) -> DataFrame:
    """S14 + N04–N07: one select building every declared column (hybrid mode keeps ``raw_data``)."""
    text = F.col(raw_col)
    cols = [field_column(text, s).alias(s.name) for s in specs]
    extra = [c for c in df.columns if c != raw_col]
    if keep_raw:
        cols.append(text.alias("raw_data"))
    return df.select(*cols, *extra)


def rules_from_specs(specs: Sequence[FieldSpec], required: Sequence[str] = ()) -> list[quality.Rule]:
    """Q01–Q06 from declared validations (top-level fields)."""
    rules: list[quality.Rule] = []
    for s in specs:
        v = s.validations or {}
        if v.get("not_null") or s.mode.upper() == "REQUIRED":
            rules.append(quality.not_null(s.name))
        if v.get("positive"):
            rules.append(quality.positive(s.name))
        if "min" in v or "max" in v:
            rules.append(quality.in_range(s.name, v.get("min"), v.get("max")))
        if "min_date" in v or "max_date" in v:
            rules.append(quality.date_range(s.name, v.get("min_date"), v.get("max_date")))
        if "max_length" in v:
            rules.append(quality.max_length(s.name, v["max_length"]))
    rules += quality.required_fields(required)
    return rules


# ---- the ingest job (S18–S21) ---------------------------------------------------------

@dataclass
class IngestResult:
    """Figures of a run; ``outcome`` has one row per file: source_file, accepted, rejected, bad, blank (lines)."""

    files: int
    records_read: int
    records_rejected: int
    bad_lines: int
    files_without_records: int
    outcome: DataFrame
    files_archived: int = 0
    _archive: tuple[str, str] | None = None

    @property
    def rejection_rate(self) -> float:
        return self.records_rejected / self.records_read if self.records_read else 0.0

    @property
    def rejected_files(self) -> list[str]:
        """Files without a record, gathered when asked for."""
        return [r.source_file for r in self.outcome.filter("accepted + rejected = 0").select("source_file").toLocalIterator()]

    @property
    def archived(self) -> list[str]:
        """Where the archived files went, gathered when asked for."""
        from tessera.sources import sinks

        if not self._archive:
            return []
        archive_dir, landing = self._archive
        rows = self.outcome.filter("accepted + rejected > 0").select("source_file").toLocalIterator()
        return [sinks.moved_path(self.outcome.sparkSession, r.source_file, archive_dir, landing) for r in rows]


def classified(lines: DataFrame, specs: Sequence[FieldSpec], rules: Sequence[quality.Rule]) -> DataFrame:
    """Every line once: its declared columns, its errors and its ``_status``: accepted, rejected, bad or blank."""
    kind = (F.when(F.trim("value") == "", F.lit("blank")).when(is_json_object(F.col("value")), F.lit("record"))
            .otherwise(F.lit("bad")))
    told = lines.withColumn("_line", kind)
    records = with_lineage(extract_fields(told, specs))  # of lines that are no records, no column has a value
    checked = quality.with_errors(records, rules)
    status = F.when(F.col("_line") != "record", F.col("_line")).when(F.size("_errors") == 0, "accepted").otherwise("rejected")
    return checked.withColumn("_status", status).drop("_line")


def ingest(
    spark: SparkSession,
    landing: str,
    specs: Sequence[FieldSpec],
    target: str | None,
    mode: str = "strict",
    quarantine: str | None = None,
    archive_dir: str | None = None,
    rejected_dir: str | None = None,
    partition_col: str | None = None,
    partition_unit: str = "DAY",
    dry_run: bool = False,
    required: Sequence[str] = (),
    pattern: str = "*.jsonl",
    cluster_by: Sequence[str] = (),
    disposition: str = "append",
) -> IngestResult:
    """Read and parse every landing line once → validate → ONE append → archive.

    One job scans the text and writes all lines, by status, to the shared scratch folder, and counts them on the way
    (S20).  What follows reads that table, a folder per status: the append of accepted rows (with the rejected ones
    unless ``mode`` is strict), the quarantine, and the counts per file, which stay a table.  So a landing file that
    changes in between cannot split a run, and a run that is repeated after a failure starts from the landing files.

    Files are moved to ``archive_dir`` only after the append committed; files without a single record go to
    ``rejected_dir`` instead.  Their names pass the driver one at a time.  ``dry_run`` (S21) parses, validates and
    counts without writing to a table or moving anything.
    """
    from pyspark.sql import Observation

    from tessera.session import scratch_path
    from tessera.sources import sinks

    rules = [] if mode == "skip" else rules_from_specs(specs, required)
    lines = classified(scan_jsonl(spark, landing, pattern), specs, rules)
    is_in = lambda *names: F.count_if(F.col("_status").isin(*names))
    staged = scratch_path(spark, "ingest")
    metrics = Observation("ingest")
    lines.observe(metrics, is_in("accepted", "rejected").alias("read"), is_in("rejected").alias("rejected"),
                  is_in("bad").alias("bad")).write.partitionBy("_status").parquet(staged)
    table = spark.read.schema(lines.schema).parquet(staged)
    counts = scratch_path(spark, "ingest-files")
    per_file = table.groupBy("source_file").agg(*[is_in(n).alias(n) for n in ("accepted", "rejected", "bad", "blank")])
    per_file.write.parquet(counts)
    outcome = spark.read.schema(per_file.schema).parquet(counts)
    n_files, empty = outcome.agg(F.count(F.lit(1)), F.count_if(F.col("accepted") + F.col("rejected") == 0)).first()
    numbers = metrics.get
    result = IngestResult(n_files, numbers["read"], numbers["rejected"], numbers["bad"], empty, outcome)
    if dry_run or target is None:
        return result
    good = table.filter(F.col("_status") == "accepted" if mode == "strict" else F.col("_status").isin("accepted", "rejected"))
    sinks.append(good.drop("_errors", "_status"), target, partition_col=partition_col, unit=partition_unit,
                 cluster_by=cluster_by, disposition=disposition)
    if quarantine and mode == "strict":
        table.filter(F.col("_status") == "rejected").drop("_status").write.mode("append").parquet(quarantine)
    if archive_dir:
        whole = outcome.filter("accepted + rejected > 0").select("source_file").toLocalIterator()
        result.files_archived = sum(1 for _ in sinks.move_each(spark, (r.source_file for r in whole), archive_dir, landing))
        result._archive = (archive_dir, landing)
    if rejected_dir:
        none = outcome.filter("accepted + rejected = 0").select("source_file").toLocalIterator()
        for _ in sinks.move_each(spark, (r.source_file for r in none), rejected_dir, landing):
            pass
    return result


def select_datasets(routed: DataFrame, requested: Sequence[str] | None = None, owner: str | None = None,
                    dataset_col: str = "dataset", owner_col: str = "username") -> DataFrame:
    """The user's dataset list if given; else the files of one owner; else all."""
    if requested:
        return routed.filter(F.col(dataset_col).isin(list(requested)))
    if owner and owner_col in routed.columns:
        return routed.filter(F.col(owner_col) == F.lit(owner))
    return routed


def retransform_legacy(spark: SparkSession, raw_dir: str, out_dir: str, widths: dict[str, int] | None = None,
                       pattern: str = "*.jsonl") -> int:
    """Read raw landing files, rewrite numeric ``[[…]]`` arrays as arrays of
    structs (N10–N14) using the inferred schema, and write a JSON-lines mirror."""
    from tessera.functions.nested import flatten_nested_arrays, matrix_widths
    from tessera.sources.schema import infer_schema
    from tessera.sources.sinks import write_jsonl

    lines = scan_jsonl(spark, raw_dir, pattern)
    schema = infer_schema(lines)
    good, _ = parse_lines(lines, schema)
    widths = matrix_widths(good) | (widths or {})
    flat = good.select(*[flatten_nested_arrays(F.col(f.name), f.dataType, widths, f.name).alias(f.name)
                         for f in schema.fields])
    write_jsonl(flat, out_dir)
    return len(schema.fields)
