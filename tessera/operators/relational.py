"""Relational building blocks the composite queries share.

period_rollup (A22), top_k_per_group (W01/W03/F15), global_top_k (O04/W02),
interval_join (J06), spine (U04/J12), current_streak (W10),
share_of_total (A20), page (O07), bucketed_row_number / bucketed_lead (W06, P03), batch_ids (E03).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

# The five look-back periods of the ranking queries, in
# display order, with their day offsets from ``as_of`` (None = all time)
# and their row limits.  ``yesterday`` includes today (DATE >= as_of - 1).
PERIODS: tuple[tuple[str, int | None, int], ...] = (
    ("all_time", None, 20),
    ("last_365_days", 365, 20),
    ("last_30_days", 30, 20),
    ("last_7_days", 7, 20),
    ("yesterday", 1, 10),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return F.to_date(F.lit(d))


def period_rollup(
    df: DataFrame,
    ts_col: str,
    as_of,
    keys: Sequence[str],
    sums: dict[str, Column] | None = None,
    periods=PERIODS,
    count_name: str = "n",
) -> DataFrame:
    """Aggregate ``df`` over nested look-back periods in ONE scan.

    Instead of one UNION ALL arm per period (five scans, five shuffles),
    every row feeds conditional aggregates for each period it falls into;
    the map-side partial aggregate keeps one row per key per task.  The
    per-key result is then unpivoted to ``(period, keys…, sums…, n)``;
    keys with no row in a period do not appear for it.  When no period is
    all-time, rows older than the longest look-back are filtered on the raw
    timestamp first, so the bound reaches the Parquet scan.
    """
    sums = sums or {}
    windows = [days for _, days, _ in periods]
    if None not in windows:  # every period is bounded: prune the scan to the longest look-back
        lo = F.date_sub(as_date(as_of), max(windows))
        df = df.filter(F.col(ts_col) >= lo.cast(df.schema[ts_col].dataType))
    day = F.to_date(F.col(ts_col))
    aggs = []
    for i, (_, days, _) in enumerate(periods):
        cond = F.lit(True) if days is None else day >= F.date_sub(as_date(as_of), days)
        for name, expr in sums.items():
            aggs.append(F.sum(F.when(cond, expr)).alias(f"{name}__{i}"))
        aggs.append(F.count_if(cond).alias(f"{count_name}__{i}"))
    grouped = df.groupBy(*keys).agg(*aggs)
    arms = [
        F.struct(
            F.lit(name).alias("period"),
            *[F.col(f"{m}__{i}").alias(m) for m in sums],
            F.col(f"{count_name}__{i}").alias(count_name),
        )
        for i, (name, _, _) in enumerate(periods)
    ]
    return (
        grouped.select(*keys, F.inline(F.array(*arms)))
        .filter(F.col(count_name) > 0)
    )


def period_limit(period_col: str = "period", periods=PERIODS) -> Column:
    """per-period row limit (``IF(period='yesterday', 10, 20)``)."""
    expr = None
    for name, _, limit in periods:
        expr = F.when(F.col(period_col) == name, F.lit(limit)) if expr is None else expr.when(
            F.col(period_col) == name, F.lit(limit))
    return expr


def period_order(period_col: str = "period", periods=PERIODS) -> Column:
    """Display order of periods (all_time first)."""
    expr = None
    for i, (name, _, _) in enumerate(periods):
        expr = F.when(F.col(period_col) == name, F.lit(i + 1)) if expr is None else expr.when(
            F.col(period_col) == name, F.lit(i + 1))
    return expr


def top_k_per_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column],
    k: int,
    rank_col: str = "rank",
    per_group_limit: Column | None = None,
) -> DataFrame:
    """W01 + W03: ``row_number() over (partition by g order by …) <= k``.

    The literal bound lets Catalyst insert a partial ``WindowGroupLimit``
    below the shuffle, so each map task ships at most k rows per group —
    a hot group never arrives whole at one reducer.  ``per_group_limit``
    (F15) can tighten the bound per group after that.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    out = df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
    if per_group_limit is not None:
        out = out.filter(F.col(rank_col) <= per_group_limit)
    return out


def global_top_k(df: DataFrame, order_cols: Sequence[Column], k: int, rank_col: str | None = "rank") -> DataFrame:
    """O04 + W02: ``ORDER BY … LIMIT k`` then a rank over the k rows.

    The limit plans as ``TakeOrderedAndProject`` (per-task top-k, then a
    k-row merge), so the global window only ever sees k rows.
    """
    top = df.orderBy(*order_cols).limit(k)
    if rank_col is None:
        return top
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order_cols)))


def time_buckets(ts: Column) -> tuple[Column, Column]:
    """Day and minute of a time, as the two bucket levels of an order that leads with it."""
    minute = F.floor(_micros(ts) / 60_000_000)
    return F.floor(minute / 1440), minute


class Buckets:
    """Rows cut by value: (keys, coarse bucket, fine bucket), for orders that lead with the buckets.

    Both bucket columns must never fall along the order, the fine one inside
    a coarse one.  They depend on values only, so every evaluation (a retry, a
    second scan, another partitioning) cuts the rows alike.  Keys and buckets
    are held null-free, so that the plain joins below keep null keys and
    share the windows' partitioning.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], buckets: tuple[Column, Column]):
        self.columns = df.columns
        for i, k in enumerate(keys):
            df = df.withColumn(f"_k{i}", F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")))
        lowest = F.lit(-(2**63)).cast("bigint")  # nulls stand first
        for name, b in zip(("_b1", "_b2"), buckets):
            df = df.withColumn(name, F.coalesce(b.cast("bigint"), lowest))
        self.rows = df
        self.keys = [f"_k{i}" for i in range(len(keys))]
        self.coarse = [*self.keys, "_b1"]
        self.fine = [*self.coarse, "_b2"]

    def inside(self, order_cols: Sequence) -> WindowSpec:
        """The rows of one fine bucket, in order."""
        return Window.partitionBy(*self.fine).orderBy(*order_cols)

    def combine(self, per_bucket: Column, up: Column, fine_over, coarse_over) -> DataFrame:
        """One row per fine bucket: ``_f`` over its coarse bucket's fine rows, ``_c`` over its key's coarse rows."""
        fine = self.rows.groupBy(*self.fine).agg(per_bucket.alias("_v"))
        coarse = fine.groupBy(*self.coarse).agg(up.alias("_v"))
        by_fine = Window.partitionBy(*self.coarse).orderBy("_b2")
        by_coarse = Window.partitionBy(*self.keys).orderBy("_b1")
        coarse = coarse.select(*self.coarse, coarse_over(by_coarse).alias("_c"))
        return fine.select(*self.fine, fine_over(by_fine).alias("_f")).join(coarse, self.coarse)


def _sum_before(w: WindowSpec) -> Column:
    return F.coalesce(F.sum("_v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def bucketed_row_number(df: DataFrame, keys: Sequence[str], buckets: tuple[Column, Column], order_cols: Sequence,
                        name: str = "row_number", count_col: str | None = None) -> DataFrame:
    """1-based ``row_number() over (partition by keys order by …)`` with no key in one task.

    Rows are numbered inside their fine bucket; the counts of earlier buckets
    (one row per bucket, summed fine within coarse within key) are joined back
    on the bucket.  A hot key is spread over its buckets.  The order must be
    total and lead with the buckets; ``count_col`` adds the key's row count.
    """
    b = Buckets(df, keys, buckets)
    before = b.combine(F.count(F.lit(1)), F.sum("_v"), _sum_before, _sum_before)
    numbered = b.rows.withColumn("_in", F.row_number().over(b.inside(order_cols))).join(before, b.fine)
    numbered = numbered.withColumn(name, F.col("_c") + F.col("_f") + F.col("_in"))
    extra = [name]
    if count_col:
        totals = b.rows.groupBy(*b.keys).agg(F.count(F.lit(1)).alias(count_col))
        numbered = numbered.join(totals, b.keys)
        extra.append(count_col)
    return numbered.select(*b.columns, *extra)


def bucketed_lead(df: DataFrame, keys: Sequence[str], ts_col: str, tie_cols: Sequence[str], name: str) -> DataFrame:
    """``LEAD(ts) over (partition by keys order by ts, ties)`` with no key in one task.

    Inside a fine bucket the next row's time is a window; a bucket's last row
    takes the first time of the key's next bucket (one row per bucket).
    """
    b = Buckets(df, keys, time_buckets(F.col(ts_col)))
    following = b.combine(F.min(ts_col), F.min("_v"), lambda w: F.lead("_v").over(w), lambda w: F.lead("_v").over(w))
    w = b.inside([ts_col, *tie_cols])
    led = b.rows.withColumn("_in", F.lead(ts_col).over(w)).withColumn("_more", F.lead(F.lit(True)).over(w))
    led = led.join(following, b.fine)
    return led.withColumn(name, F.when(F.col("_more"), F.col("_in")).otherwise(F.coalesce("_f", "_c"))).select(
        *b.columns, name)


def batch_ids(df: DataFrame, buckets: tuple[Column, Column], order_cols: Sequence[Column], size: int,
              name: str = "batch_id") -> DataFrame:
    """Split a wholly ordered work list into fixed batches of ``size``."""
    numbered = bucketed_row_number(df, [], buckets, order_cols, "position")
    return numbered.withColumn(name, F.floor((F.col("position") - 1) / size).cast("bigint"))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def interval_join(
    intervals: DataFrame,
    points: DataFrame,
    start_col: str,
    end_col: str,
    point_col: str,
    keys: Sequence[str] = (),
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Pairs where ``start <= point <= end`` (both ends inclusive).

    A plain inequality join plans as a nested loop.  Here each interval is
    exploded into the fixed time buckets it overlaps, each point gets its
    one bucket, the join is an equi join on ``(keys…, bucket)`` and the
    exact bound check runs as a residual.  A pair is produced exactly once
    because a point lives in exactly one bucket.  Choose ``bucket_seconds``
    near the typical interval length.
    """
    b = bucket_seconds * 1_000_000
    iv = intervals.withColumn(
        "_bucket",
        F.explode(F.sequence(F.floor(_micros(F.col(start_col)) / b), F.floor(_micros(F.col(end_col)) / b))),
    )
    pt = points.withColumn("_bucket", F.floor(_micros(F.col(point_col)) / b))
    cond = [iv["_bucket"] == pt["_bucket"]] + [iv[k] == pt[k] for k in keys]
    cond += [pt[point_col] >= iv[start_col], pt[point_col] <= iv[end_col]]
    return iv.join(pt, cond, "inner").drop(iv["_bucket"]).drop(pt["_bucket"])


def date_spine(spark, as_of, days_back: int, name: str = "date") -> DataFrame:
    """U04 by day: ``as_of - days_back … as_of`` (bounded by the parameter)."""
    return spark.range(0, days_back + 1).select(F.date_sub(as_date(as_of), F.col("id").cast("int")).alias(name))


def week_spine(spark, as_of, weeks_back: int, name: str = "week_start") -> DataFrame:
    """U04 by Monday week: the Monday of ``as_of`` and the ``weeks_back`` before it."""
    monday = F.to_date(F.date_trunc("week", as_date(as_of)))
    return spark.range(0, weeks_back + 1).select(F.date_sub(monday, (F.col("id") * 7).cast("int")).alias(name))


def spine_fill(spine: DataFrame, agg: DataFrame, on: str, fill: dict[str, object]) -> DataFrame:
    """Left join an aggregate onto a spine and fill the gaps."""
    out = spine.join(agg, on, "left")
    for c, v in fill.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def current_streak(
    df: DataFrame, key: str, date_col: str, as_of, name: str = "current_streak"
) -> DataFrame:
    """Consecutive active days ending exactly on ``as_of`` per key.

    Distinct (key, day) first — partial aggregation bounds each key to its
    number of calendar days — then ``days_ago = rn - 1`` marks the run that
    touches ``as_of``.  Keys whose latest day is before ``as_of`` get 0 via
    the caller's left join + coalesce.
    """
    days = (
        df.select(F.col(key), F.to_date(F.col(date_col)).alias("_d"))
        .filter(F.col(key).isNotNull() & (F.col("_d") <= as_date(as_of)))
        .distinct()
    )
    w = Window.partitionBy(key).orderBy(F.col("_d").desc())
    numbered = days.withColumn("_rn", F.row_number().over(w)).withColumn(
        "_ago", F.datediff(as_date(as_of), F.col("_d")))
    return numbered.filter(F.col("_ago") == F.col("_rn") - 1).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def share_of_total(df: DataFrame, group_cols: Sequence[str], measure: str, name: str, digits: int = 1) -> DataFrame:
    """A20 + A21: ``round(100 * m / sum(m) over group, digits)``.

    The totals are a partial aggregate joined back (nulls group together), so
    a group with a third of the rows is summed by all tasks, not one window.
    """
    totals = df.groupBy(*[F.col(c).alias(f"_t_{c}") for c in group_cols]).agg(F.sum(measure).alias("_total"))
    same = reduce(and_, [df[c].eqNullSafe(totals[f"_t_{c}"]) for c in group_cols], F.lit(True))
    share = F.round(F.lit(100.0) * F.col(measure) / F.nullif(F.col("_total"), F.lit(0)), digits)
    return df.join(totals, same).withColumn(name, share).select(*df.columns, name)


def page(df: DataFrame, order_cols: Sequence[Column], page_no: int, size: int) -> DataFrame:
    """1-based page of an ordered result (``OFFSET (p-1)*size LIMIT size``)."""
    if page_no < 1 or size < 1:
        raise ValueError("page and size must be >= 1")
    return df.orderBy(*order_cols).offset((page_no - 1) * size).limit(size)


def conjunction(preds: Sequence[Column | None]) -> Column:
    """AND of the optional predicates that are set (TRUE when none)."""
    out = F.lit(True)
    for p in preds:
        if p is not None:
            out = out & p
    return out


def thin_points(df: DataFrame, key: str, buckets: tuple[Column, Column], order_cols: Sequence[str], max_points: int,
                index_col: str = "point_idx") -> DataFrame:
    """P03 polyline thinning: keep every ``ceil(n / max_points)``-th point per key.

    Numbers and point counts come from :func:`bucketed_row_number`, so a key
    with a third of all points is numbered by many tasks.
    """
    numbered = bucketed_row_number(df, [key], buckets, order_cols, "_rn", count_col="_n").withColumn(
        index_col, F.col("_rn") - 1)
    step = F.ceil(F.col("_n") / F.lit(max_points))
    return numbered.filter(F.pmod(F.col(index_col), step) == 0).withColumn("step", step).drop("_n", "_rn")


def first_per_bucket(df: DataFrame, bucket: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The first row of every bucket (for example key and day) by ``order_cols``, which are the columns it keeps.

    A partial aggregate: a hot key reaches the shuffle as one row per bucket and task, so arrays gathered from the
    result are bounded by the number of buckets.
    """
    return df.groupBy(*bucket).agg(F.min(F.struct(*order_cols)).alias("_first")).select(*bucket, "_first.*")


def limited_ordered_array(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
                          value: Column, n: int, name: str, distinct: bool = False) -> DataFrame:
    """``ARRAY_AGG([DISTINCT] v ORDER BY … LIMIT n)`` per group.

    The group is cut to n rows with a bounded ``row_number`` (partial
    group limit before the shuffle) before anything is collected, so a hot
    group never materialises whole.  ``order_cols`` are ascending value
    expressions (negate numbers for descending).
    """
    src = df.select(*group_cols, *[o.alias(f"_o{i}") for i, o in enumerate(order_cols)], value.alias("_v"))
    if distinct:
        src = src.dropDuplicates([*group_cols, "_v"])
    ords = [F.col(f"_o{i}") for i in range(len(order_cols))]
    top = top_k_per_group(src, group_cols, [*ords, F.col("_v")], n, rank_col="_r")
    return top.groupBy(*group_cols).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("_r"), F.col("_v")))), lambda x: x["_v"]).alias(name))


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a relation of at most one row to every row.

    ``LEFT JOIN … ON TRUE``: rows survive, with nulls, when the relation is
    empty.  It is one scalar subquery, so no join runs; a second row is an error.
    """
    packed = one_row.select(F.struct(*one_row.columns).alias("_r")).scalar()
    return df.withColumn("_r", packed).select(*df.columns, *[F.col("_r")[c].alias(c) for c in one_row.columns])
