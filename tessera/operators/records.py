"""Record-level operators N15–N29 (explode, enrich, pivot, dedupe, time filters)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path


def envelope(df: DataFrame, payload: str, date, data_type: str) -> DataFrame:
    """List payload → one row per element, scalar → ``{data}``; stamp date + type."""
    dt = df.schema[payload].dataType
    rows = df.select(F.explode_outer(payload).alias("data")) if isinstance(dt, T.ArrayType) else df.select(
        F.col(payload).alias("data"))
    return rows.withColumn("date", F.lit(date) if not isinstance(date, Column) else date).withColumn(
        "data_type", F.lit(data_type))


def explode_entries(df: DataFrame, list_col: str, inherit: dict[str, str]) -> DataFrame:
    """Explode a list column; entries inherit parent fields they lack.

    ``inherit``: entry field → parent column, e.g. ``{'summaryDate': 'summaryDate'}``.
    """
    parent_cols = [c for c in df.columns if c != list_col]
    ex = df.select(*[F.col(c).alias(f"_p_{c}") for c in parent_cols], F.explode(list_col).alias("_e"))
    fields = ex.schema["_e"].dataType.fieldNames() if isinstance(ex.schema["_e"].dataType, T.StructType) else []
    cols = [F.col(f"_e.{f}").alias(f) for f in fields if f not in inherit]
    cols += [F.coalesce(F.col(f"_e.{f}") if f in fields else F.lit(None), F.col(f"_p_{p}")).alias(f)
             for f, p in inherit.items()]
    return ex.select(*cols)


def enrich(parent: DataFrame, child: DataFrame, key: str, as_col: str) -> DataFrame:
    """Attach a child payload as one struct column (left join on key)."""
    payload = child.select(F.col(key), F.struct(*[c for c in child.columns if c != key]).alias(as_col))
    return parent.join(payload, key, "left")


def enrich_all(parent: DataFrame, children: dict[str, DataFrame], key: str) -> DataFrame:
    """Attach several child payloads, a struct column each, in one shuffle on ``key``.

    Parents and children are stacked and pivoted by one aggregate per key, instead of a join per child.  Parents
    and each child hold a key once (keep-latest staging) and have a key; a missing child is a null struct, children
    without a parent go.
    """
    kinds = {name: F.struct(*[c for c in child.columns if c != key]) for name, child in children.items()}
    frames = {"_parent": parent.select(F.col(key), F.struct(*parent.columns).alias("_parent"))}
    frames |= {name: child.select(F.col(key), kinds[name].alias(name)) for name, child in children.items()}
    stacked = None
    for frame in frames.values():
        stacked = frame if stacked is None else stacked.unionByName(frame, allowMissingColumns=True)
    held = stacked.groupBy(key).agg(*[F.first(n, ignorenulls=True).alias(n) for n in frames])
    return held.filter(F.col("_parent").isNotNull()).select("_parent.*", *children)


def recover_key(df: DataFrame, key: str, file_col: str, pattern: str = r"^(\d+)_") -> DataFrame:
    """N21 + N22: fill a missing id from the file name prefix, else drop the row."""
    name = F.regexp_extract(F.col(file_col), r"([^/]*)$", 1)
    from_name = F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).try_cast("bigint")
    return df.withColumn(key, F.coalesce(F.col(key).cast("bigint"), from_name)).filter(F.col(key).isNotNull())


def pivot_measures(
    df: DataFrame,
    keys: Sequence[str],
    measures_col: str,
    types: dict[int, str],
    keep_if: str | None = None,
) -> DataFrame:
    """``[{type, value, unit}]`` → one column per known type, ``value * 10^unit``.

    The pivot values are the fixed type list, so Spark needs no extra pass
    to discover them.  Later duplicates of a type win (``max_by`` on the
    element position), matching a dict assignment.
    """
    ex = df.select(*keys, F.posexplode(measures_col).alias("_pos", "_m"))
    val = F.col("_m.value") * F.pow(F.lit(10.0), F.col("_m.unit"))
    names = None
    for code, name in types.items():
        cond = F.col("_m.type") == code
        names = F.when(cond, F.lit(name)) if names is None else names.when(cond, F.lit(name))
    ex = ex.withColumn("_name", names).withColumn("_val", val).filter(F.col("_name").isNotNull())
    out = ex.groupBy(*keys).pivot("_name", list(types.values())).agg(F.max_by("_val", "_pos"))
    if keep_if:
        out = out.filter(F.col(keep_if).isNotNull())
    return out


def device_sourced(df: DataFrame, attrib_col: str = "attrib", allowed=(0, 2)) -> DataFrame:
    """Keep groups measured by a device."""
    return df.filter(F.col(attrib_col).isin(list(allowed)))


def body_metrics(df: DataFrame, weight: str, height: str, hydration: str | None = None) -> DataFrame:
    """BMI = kg / m², hydration % = hydration / weight × 100 (1 decimal)."""
    out = df.withColumn("bmi", F.round(F.col(weight) / (F.col(height) * F.col(height)), 1))
    if hydration:
        out = out.withColumn("hydration_pct", F.round(F.lit(100.0) * F.col(hydration) / F.nullif(F.col(weight), F.lit(0)), 1))
    return out


# Buckets of the window dedupe: minutes within days (UTC, of the epoch)
_MINUTE_US, _DAY_US = 60_000_000, 86_400_000_000


def _micros(ts_col: str) -> Column:
    return F.unix_micros(F.col(ts_col).cast("timestamp"))


def first_at_or_after(times: DataFrame, ahead_us: int) -> DataFrame:
    """(_k, _t long, distinct) -> (_k, _t, _n): the key's first time at or after ``_t + ahead_us``; none gives no row.

    Asked and present times meet in minute buckets of their key.  What a bucket
    cannot answer takes the first time of the key's next bucket: of the later
    minutes of the day, else of the later days (one row per key and day), so no
    window spans a key's whole history.
    """
    start = lambda width: F.col("_x") - F.pmod(F.col("_x"), F.lit(width))
    none = F.lit(None).cast("long")
    points = (
        times.select("_k", F.col("_t").alias("_x"), F.col("_t").alias("_u"), none.alias("_q"))
        .unionByName(times.select("_k", (F.col("_t") + ahead_us).alias("_x"), none.alias("_u"), F.col("_t").alias("_q")))
        .withColumn("_b", start(_MINUTE_US))
    )
    # latest first, present times before asked ones: the least so far is the first at or after
    here = Window.partitionBy("_k", "_b").orderBy(F.col("_x").desc(), F.col("_u").desc_nulls_last())
    asked = points.withColumn("_in", F.min("_u").over(here.rowsBetween(Window.unboundedPreceding, 0))).filter("_q is not null")
    cells = points.groupBy("_k", "_b").agg(F.min("_u").alias("_first")).withColumn(
        "_d", F.col("_b") - F.pmod(F.col("_b"), F.lit(_DAY_US)))
    before = (Window.unboundedPreceding, -1)
    minutes = Window.partitionBy("_k", "_d").orderBy(F.col("_b").desc()).rowsBetween(*before)
    days = Window.partitionBy("_k").orderBy(F.col("_d").desc()).rowsBetween(*before)
    per_day = cells.groupBy("_k", "_d").agg(F.min("_first").alias("_first")).select(
        F.col("_k").alias("_dk"), F.col("_d").alias("_dd"), F.min("_first").over(days).alias("_days"))
    later = cells.withColumn("_minutes", F.min("_first").over(minutes)).join(
        per_day, F.col("_k").eqNullSafe(F.col("_dk")) & (F.col("_d") == F.col("_dd"))).select(
        F.col("_k").alias("_ck"), F.col("_b").alias("_cb"), F.coalesce("_minutes", "_days").alias("_later"))
    return asked.join(later, F.col("_k").eqNullSafe(F.col("_ck")) & (F.col("_b") == F.col("_cb"))).select(
        "_k", F.col("_q").alias("_t"), F.coalesce("_in", "_later").alias("_n")).filter("_n is not null")


# Keys with more rows than this are spread over their times by the window dedupe; others are walked, one array each
WALKED_ROWS = 20_000


def _written(part: DataFrame, name: str) -> DataFrame:
    """A frame written to the shared checkpoint folder and read back."""
    path = scratch_path(part.sparkSession, f"dedupe-{name}")
    part.write.parquet(path)
    return part.sparkSession.read.schema(part.schema).parquet(path)


def _walked_chains(times: DataFrame, ahead_us: int) -> DataFrame:
    """(_k, _t long) -> the kept (_k, _t): a key's times in one sorted array, walked once."""
    none = F.array().cast("array<bigint>")
    step = lambda kept, t: F.when(F.size(kept) == 0, F.array(t)).when(
        t >= F.element_at(kept, -1) + ahead_us, F.array_append(kept, t)).otherwise(kept)
    walked = times.groupBy("_k").agg(F.sort_array(F.collect_list("_t")).alias("_ts"))
    return walked.select("_k", F.explode(F.aggregate("_ts", none, step)).alias("_t"))


def _spread_chains(times: DataFrame, ahead_us: int) -> DataFrame:
    """(_k, _t long, distinct and written) -> the kept (_k, _t), by jumps of 1, 2, 4, … links."""
    starts = times.groupBy("_k").agg(F.min("_t").alias("_t"), F.max("_t").alias("_last"))
    span = starts.agg(F.coalesce(F.max(F.col("_last") - F.col("_t")), F.lit(0))).first()[0]  # one number
    target = lambda jump: jump.select(F.col("_k").alias("_jk"), F.col("_t").alias("_jt"), F.col("_n").alias("_to"))
    here = lambda c: F.col("_k").eqNullSafe(F.col("_jk")) & (F.col(c) == F.col("_jt"))
    jumps = [_written(first_at_or_after(times, ahead_us), "jump")] if span >= ahead_us else []
    for _ in range((span // ahead_us).bit_length() - 1):
        last = jumps[-1]
        jumps.append(_written(last.join(target(last), here("_n")).select("_k", "_t", F.col("_to").alias("_n")), "jump"))
    kept = starts.select("_k", "_t")
    for jump in reversed(jumps):
        known = F.explode(F.array_compact(F.array("_t", "_to")))
        kept = kept.join(target(jump), here("_t"), "left").select("_k", known.alias("_t"))
    return kept


def greedy_window_dedupe(
    df: DataFrame, key: str, ts_col: str, window_hours: float, tie_col: str | None = None, walked_rows: int = WALKED_ROWS
) -> DataFrame:
    """Per key, keep the first row, then drop every row closer than
    ``window_hours`` to the last KEPT row.

    A key of at most ``walked_rows`` rows is one sorted array of its times,
    walked once: its times are shuffled once, packed.

    A longer key is spread over its times and never folded in one task.  The
    row kept after one at ``t`` is the key's first at or after ``t`` plus
    the window, so the kept times are a chain from the key's first time.  Jumps
    of 1, 2, 4, … links are made by joining a jump to itself; going down from
    the longest, every known time adds the one its jump leads to.  As links are
    at least a window apart, the longest span of a key bounds the number of
    jumps: its logarithm.  Jumps are written to the shared checkpoint folder.

    Of rows at one kept time the first by ``tie_col`` stays (else by a hash of
    the row); rows without a time stay; null keys are one key.  ``df`` is read
    several times.
    """
    ahead = int(window_hours * 3600 * 1_000_000)
    times = df.select(F.col(key).alias("_k"), _micros(ts_col).alias("_t")).filter("_t is not null")
    long = _written(times.groupBy(F.col("_k").alias("_lk")).agg(F.count(F.lit(1)).alias("_rows")).filter(
        F.col("_rows") > walked_rows).select("_lk"), "long")
    if long.isEmpty():
        kept = _walked_chains(times, ahead)
    else:
        is_long = F.col("_k").eqNullSafe(F.col("_lk"))
        kept = _walked_chains(times.join(long, is_long, "left_anti"), ahead).unionByName(
            _spread_chains(_written(times.join(long, is_long, "left_semi").distinct(), "times"), ahead))
    order = [F.col(tie_col)] if tie_col else [F.xxhash64(*df.columns)]
    same = F.col(key).eqNullSafe(F.col("_k")) & (_micros(ts_col) == F.col("_t"))
    nth = F.row_number().over(Window.partitionBy(key, ts_col).orderBy(*order))
    stay = df.filter(F.col(ts_col).isNotNull()).join(kept, same, "left_semi")
    return stay.withColumn("_nth", nth).filter("_nth = 1").drop("_nth").unionByName(df.filter(F.col(ts_col).isNull()))


def skip_existing_minutes(
    source: DataFrame, target: DataFrame, ts_col: str, keys: Sequence[str] = (), target_ts_col: str | None = None
) -> DataFrame:
    """Drop source rows whose (keys, minute) already exists in the target."""
    tcol = target_ts_col or ts_col
    s = source.withColumn("_minute", F.date_trunc("minute", F.col(ts_col)))
    t = target.select(*keys, F.date_trunc("minute", F.col(tcol)).alias("_minute")).distinct()
    return s.join(t, [*keys, "_minute"], "left_anti").drop("_minute")


def epoch_range_filter(df: DataFrame, epoch_col: str, start, end, data_type: str | None = None) -> DataFrame:
    """Keep rows whose epoch-seconds end time falls in ``[start, end]`` (dates)."""
    ts = F.timestamp_seconds(F.col(epoch_col))
    out = df.filter((ts >= F.to_timestamp(F.lit(str(start)))) & (ts < F.date_add(F.to_date(F.lit(str(end))), 1)))
    if data_type:
        out = out.withColumn("data_type", F.lit(data_type)).withColumn("fetched_at", F.current_timestamp())
    return out


def since_yesterday_hour(ts_col: str, tz: str, hour: int = 23, now: Column | None = None) -> Column:
    """Predicate ``ts >= (start of today in tz) - (24 - hour) h``, as UTC."""
    now = now if now is not None else F.current_timestamp()
    local_midnight = F.date_trunc("day", F.from_utc_timestamp(now, tz))
    bound = F.to_utc_timestamp(local_midnight - F.expr(f"INTERVAL {24 - hour} HOURS"), tz)
    return F.col(ts_col) >= bound
