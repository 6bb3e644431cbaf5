"""Structured Streaming.

The reference re-pulls on a schedule and appends; here the landing folder
is a streaming file source run with ``Trigger.AvailableNow`` (process what
has landed, then stop — a scheduled micro-batch), the checkpoint replaces
the incremental high-water mark, and ``foreachBatch`` applies the
keep-latest merge so a re-delivered file or a corrected record is absorbed
(at-least-once delivery, idempotent result).  Checkpoints live under the
shared ``spark.checkpoint.dir``, so a restarted query resumes after an
executor or driver loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tessera.operators import keep, records
from tessera.session import checkpoint_root, scratch_path
from tessera.sources.jsonl import FieldSpec, extract_fields, with_lineage


def landing_stream(spark: SparkSession, landing: str, archive_dir: str | None = None,
                   max_files_per_trigger: int | None = None, pattern: str = "*.jsonl") -> DataFrame:
    """JSONL lines of newly landed files; processed files are moved
    to ``archive_dir`` by the source itself once their batch committed."""
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", "true")
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing).select("value", F.col("_metadata.file_path").alias("source_file"))


def parsed_stream(lines: DataFrame, specs: Sequence[FieldSpec]) -> DataFrame:
    """Config-driven extraction on a stream (same code path as batch)."""
    valid = F.try_parse_json(F.col("value")).isNotNull() & F.ltrim(F.col("value")).startswith("{")
    return with_lineage(extract_fields(lines.filter(valid), specs))


def merge_batch_writer(target_path: str, keys: Sequence[str], order_col: str, partition_by: Sequence[str] = (),
                       buckets: int | None = None):
    """``foreachBatch`` body — keep-latest within the micro-batch, then
    upsert into the Parquet target (staged write + swap; with ``partition_by``
    only the partitions the batch touches are rewritten, with ``buckets`` only
    the hash buckets of its keys)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = keep.keep_latest(batch, list(keys), [F.col(order_col).desc()])
        keep.merge_into_path(spark, latest, target_path, list(keys), partition_by=partition_by, buckets=buckets)

    return write


#: Setting of queries with timers or keyed state of their own.
ROCKSDB = ("spark.sql.streaming.stateStore.providerClass",
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_available_now(df: DataFrame, name: str, writer=None, sink_path: str | None = None,
                      output_mode: str = "append", checkpoint: str | None = None,
                      state_store: str | None = None) -> StreamingQuery:
    """Start a query with ``Trigger.AvailableNow`` and wait for it to drain.

    ``writer`` → ``foreachBatch``; otherwise Parquet at ``sink_path``.
    ``state_store`` names the provider of this query's state (a query keeps the one that it started with).
    """
    spark = df.sparkSession
    ckpt = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/streams/{name}"
    before = spark.conf.get(ROCKSDB[0], None)
    if state_store:
        spark.conf.set(ROCKSDB[0], state_store)
    w = df.writeStream.queryName(name).option("checkpointLocation", ckpt).outputMode(output_mode).trigger(
        availableNow=True)
    try:
        q = w.foreachBatch(writer).start() if writer is not None else w.format("parquet").option("path", sink_path).start()
        q.awaitTermination()
    finally:
        if state_store and before is None:
            spark.conf.unset(ROCKSDB[0])
        elif state_store:
            spark.conf.set(ROCKSDB[0], before)
    return q


def _event_time(df: DataFrame, ts_col: str) -> DataFrame:
    """Watermarks need an instant (TIMESTAMP): a zone-less column is read as
    UTC wall-clock time (the session zone), i.e. the same instant."""
    if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        return df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df


def dedupe_within_watermark(df: DataFrame, key: Sequence[str], ts_col: str, delay: str = "25 hours") -> DataFrame:
    """Drop re-delivered records (overlap buffer) with bounded state."""
    return _event_time(df, ts_col).withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(key))


def tumbling_aggregates(df: DataFrame, ts_col: str, value_col: str, unit: str = "day",
                        delay: str = "1 day", group: Sequence[str] = ()) -> DataFrame:
    """Daily, Monday-weekly or calendar-month tumbling windows, finalised by the watermark.

    Weekly windows start on Mondays: the epoch (1970-01-01) is a Thursday,
    so a 7-day window offset by 4 days starts each Monday.
    """
    if unit == "day":
        win = F.window(ts_col, "1 day")
    elif unit == "week":
        win = F.window(ts_col, "7 days", "7 days", "4 days")
    elif unit == "month":
        return monthly_aggregates(df, ts_col, value_col, delay, group)
    else:
        raise ValueError("unit must be 'day', 'week' or 'month'")
    return (
        _event_time(df, ts_col).withWatermark(ts_col, delay)
        .groupBy(win.alias("window"), *group)
        .agg(F.count(F.lit(1)).alias("events"), F.sum(value_col).alias("total"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *group,
                "events", "total")
    )


def monthly_aggregates(df: DataFrame, ts_col: str, value_col: str, delay: str = "1 day",
                       group: Sequence[str] = ()) -> DataFrame:
    """X06 by calendar month, whose length varies, so no ``window`` expresses it.

    Days are native windows, closed by the watermark.  A closed day is one row per group, and a month's state adds up
    its days (at most 31 rows per group, however many events they hold).  An event-time timer at the month's end
    closes it, or the closing row itself does when the watermark has passed the end already.  The state store that
    such timers need is RocksDB, which the session has to name (``ROCKSDB``); it lives beside the query's checkpoint.
    """
    days = (
        _event_time(df, ts_col).withWatermark(ts_col, delay)
        .groupBy(F.window(ts_col, "1 day").alias("window"), *group)
        .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col(value_col).cast("double")).alias("total"))
        .select(F.window_time("window").alias("at"), F.date_trunc("month", F.col("window.start")).alias("window_start"),
                *group, "events", "total")
    )
    kinds = ", ".join(f"{g} {df.schema[g].dataType.simpleString()}" for g in group)
    schema = f"window_start timestamp, window_end timestamp, {kinds + ', ' if kinds else ''}events long, total double"

    return days.groupBy("window_start", *group).transformWithStateInPandas(
        _Months(list(group)), schema, "Append", "EventTime")


class _Months(StatefulProcessor):
    """A month of one group: closed days are added up, a timer at the month's end emits them."""

    def __init__(self, group: list[str]):
        self.group = group

    def init(self, handle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "events long, total double")

    def _row(self, key, events, total):
        import pandas as pd

        start = pd.Timestamp(key[0])
        yield pd.DataFrame([(start, start + pd.DateOffset(months=1), *key[1:], events, total)],
                           columns=["window_start", "window_end", *self.group, "events", "total"])

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        import pandas as pd

        events, total = self.sums.get() if self.sums.exists() else (0, None)
        for part in rows:
            events += int(part["events"].sum())
            held = part["total"].dropna()
            if len(held):
                total = (total or 0.0) + float(held.sum())
        end = (pd.Timestamp(key[0]) + pd.DateOffset(months=1)).value // 1_000_000
        if end > timerValues.getCurrentWatermarkInMs():
            if not self.sums.exists():
                self.handle.registerTimer(end)
            self.sums.update((events, total))
        else:
            if self.sums.exists():  # its timer finds nothing left
                self.sums.clear()
            yield from self._row(key, events, total)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        if self.sums.exists():
            yield from self._row(key, *self.sums.get())
            self.sums.clear()


def sliding_counts(df: DataFrame, ts_col: str, keys: Sequence[str], days: int = 7, slide: str = "1 day",
                   delay: str = "1 day") -> DataFrame:
    """X07 for short spans: plays per key over a ``days``-long window that
    slides every ``slide``, finalised by the watermark (state per open window
    and key).  Long look-backs (30 / 365 days, all time) stay batch
    recomputations with ``period_rollup``: their state would hold a year of
    keys."""
    win = F.window(ts_col, f"{days} days", slide)
    return (
        _event_time(df, ts_col).withWatermark(ts_col, delay)
        .groupBy(win.alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("plays"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "plays")
    )


def greedy_dedupe_writer(target_path: str, key: str, ts_col: str, window_hours: float, tie_col: str | None = None):
    """``foreachBatch`` body — the greedy window dedupe (N26) across micro-batches.

    A key's state is the last time it kept, read from the target itself: rows
    less than the window after it, and late rows before it, go; the rest is
    deduplicated as in batch, spread over all tasks.  Only kept rows within one
    window of the batch's earliest row can matter, so no more of the target is
    read.  A batch writes its own folder, and reads those of earlier batches
    only, so a batch that is run again gives the same rows.
    """
    window = F.expr(f"INTERVAL {int(window_hours * 3_600_000_000)} MICROSECOND")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if keep.path_exists(spark, target_path):
            since = batch.select(F.min(ts_col) - window).scalar()
            kept = spark.read.parquet(target_path).filter((F.col("_batch") < batch_id) & (F.col(ts_col) > since))
            last = kept.groupBy(F.col(key).alias("_lk")).agg(F.max(ts_col).alias("_last"))
            far = F.col("_last").isNull() | (F.col(ts_col) >= F.col("_last") + window)
            rows = batch.join(last, F.col(key).eqNullSafe(F.col("_lk")), "left").filter(far).select(*batch.columns)
        out = records.greedy_window_dedupe(rows, key, ts_col, window_hours, tie_col)
        out.write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/_batch={batch_id}")

    return write


class GreedyChains:
    """The greedy window dedupe (N26) over deliveries in any order of time.

    ``writer()`` is a ``foreachBatch`` body.  A late row can change every row that its key keeps from then on, so a
    batch answers it by emitting the key's chain again: from the last row kept before the key's earliest new row,
    over all rows delivered so far.  Three tables below ``path`` are appended to, a folder per batch:

    * ``rows``  what was delivered;
    * ``kept``  the rows of re-emitted chains;
    * ``cuts``  per key and batch, the time from which earlier chains of the key no longer hold.

    ``table()`` is what stands: kept rows that no later batch cut off.  After any deliveries it equals the batch
    dedupe of all of them.  A batch writes its own folders and reads those of earlier batches only, so running it
    again gives the same tables.  Only keys of the batch, and of these only rows from their chain's last fixed point
    on, are deduplicated again, spread over all tasks as in batch.  Rows without a time stay.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, ts_col: str, window_hours: float, tie_col: str | None = None):
        self.spark, self.path, self.key, self.ts, self.hours, self.tie = spark, path.rstrip("/"), key, ts_col, window_hours, tie_col

    def _read(self, part: str, before: int | None = None) -> DataFrame:
        df = self.spark.read.parquet(f"{self.path}/{part}")
        return df if before is None else df.filter(F.col("_batch") < before)

    def _once(self, late: DataFrame) -> DataFrame:
        """Chains to emit again, written: the dedupe reads them several times, and they are joins of all three tables."""
        path = scratch_path(self.spark, "chains-again")
        late.write.parquet(path)
        return self.spark.read.schema(late.schema).parquet(path)

    def table(self, before: int | None = None) -> DataFrame:
        """The rows kept so far (by the batches below ``before``)."""
        later = Window.partitionBy(self.key).orderBy(F.col("_batch").desc()).rowsBetween(Window.unboundedPreceding, -1)
        cuts = self._read("cuts", before).select(
            F.col(self.key).alias("_ck"), F.col("_batch").alias("_cb"), F.min("_from").over(later).alias("_until"))
        kept = self._read("kept", before)
        same = F.col(self.key).eqNullSafe(F.col("_ck")) & (F.col("_batch") == F.col("_cb"))
        stands = F.col("_until").isNull() | F.col(self.ts).isNull() | (F.col(self.ts) < F.col("_until"))
        return kept.join(cuts, same, "left").filter(stands).drop("_ck", "_cb", "_until", "_batch")

    def writer(self):
        key, ts = self.key, self.ts
        window = F.expr(f"INTERVAL {int(self.hours * 3_600_000_000)} MICROSECOND")

        def write(batch: DataFrame, batch_id: int) -> None:
            put = lambda df, part: df.write.mode("overwrite").parquet(f"{self.path}/{part}/_batch={batch_id}")
            earlier = keep.path_exists(self.spark, f"{self.path}/cuts")
            put(batch, "rows")
            new = self.spark.read.schema(batch.schema).parquet(f"{self.path}/rows/_batch={batch_id}")
            cuts = new.groupBy(key).agg(F.min(ts).alias("_from"))
            again = new
            if earlier:
                held = self.table(batch_id).select(F.col(key).alias("_hk"), F.col(ts).alias("_ht"))
                fixed = cuts.join(held, F.col(key).eqNullSafe(F.col("_hk")) & (F.col("_ht") < F.col("_from")), "left").groupBy(
                    F.col(key).alias("_fk")).agg(F.max("_ht").alias("_fixed"))
                delivered = self._read("rows", batch_id).drop("_batch").filter(F.col(ts).isNotNull())
                known = delivered.unionByName(new)  # rows without a time stand once, in their own batch
                past = F.col("_fixed").isNull() | F.col(ts).isNull() | (F.col(ts) >= F.col("_fixed") + window)
                late = known.join(fixed, F.col(key).eqNullSafe(F.col("_fk"))).filter(past).select(*batch.columns)
                again = self._once(late)
            put(records.greedy_window_dedupe(again, key, ts, self.hours, self.tie), "kept")
            put(cuts, "cuts")

        return write
