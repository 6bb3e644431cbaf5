"""Sinks and exports.

Writes are single Spark jobs; file moves (archive / reject) are Hadoop
FileSystem renames issued after the write committed.  Exports build one
nested document per entity with ``groupBy(key).agg(collect_list(struct))``
over already-aggregated, per-entity-bounded views, written with
``partitionBy(key)`` — one job for all entities instead of one query per id.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {"DAY": "yyyy-MM-dd", "MONTH": "yyyy-MM", "YEAR": "yyyy"}


def partition_value(col: str, unit: str = "DAY") -> Column:
    """S15 partition key for DAY / MONTH / YEAR."""
    return F.date_format(F.col(col), _UNITS[unit.upper()])


def append(df: DataFrame, path: str, partition_col: str | None = None, unit: str = "DAY",
           cluster_by: Sequence[str] = (), disposition: str = "append", ranges: int | None = None) -> None:
    """S15 + S16 + S17: append (or truncate) with optional time partitioning and clustering.

    Clustering deals rows out by ranges of (partition, ``cluster_by``) and sorts them, so files of a partition hold
    ranges that do not overlap, and their minima and maxima let a filtered scan skip row groups.  Ranges are cut by
    sampled sizes: a hot value of the leading column is split by the next ones.  ``ranges`` sets their number (else the
    shuffle's partitions, which AQE joins up to its advisory size).
    """
    out = df
    writer_cols: list[str] = []
    if partition_col:
        out = out.withColumn("_partition", partition_value(partition_col, unit))
        writer_cols = ["_partition"]
    if cluster_by:
        order = [*writer_cols, *cluster_by]
        dealt = out.repartitionByRange(ranges, *order) if ranges else out.repartitionByRange(*order)
        out = dealt.sortWithinPartitions(*order)
    mode = "overwrite" if disposition.lower() in ("truncate", "overwrite", "write_truncate") else "append"
    w = out.write.mode(mode)
    if writer_cols:
        w = w.partitionBy(*writer_cols)
    w.parquet(path)


def _partition_end(value: str) -> _dt.date | None:
    """Last day of a ``YYYY-MM-DD``, ``YYYY-MM`` or ``YYYY`` partition; None for any other name."""
    m = re.fullmatch(r"(\d{4})(?:-(\d{2}))?(?:-(\d{2}))?", value)
    if not m:
        return None
    year, month, day = (int(x) if x else None for x in m.groups())
    if day:
        return _dt.date(year, month, day)
    after = _dt.date(year + 1, 1, 1) if month in (None, 12) else _dt.date(year, month + 1, 1)
    return after - _dt.timedelta(days=1)


def expire_partitions(spark: SparkSession, path: str, keep_days: int, today: _dt.date | None = None) -> list[str]:
    """S15 expiry: delete day, month and year partitions whose last day is older than ``keep_days``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    today = today or _dt.date.today()
    cutoff = today - _dt.timedelta(days=keep_days)
    removed = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("_partition="):
            end = _partition_end(name.split("=", 1)[1])
            if end is not None and end < cutoff:
                fs.delete(st.getPath(), True)
                removed.append(name)
    return removed


def _target(spark: SparkSession, file: str, dest_dir: str, root: str | None):
    """(source, target) Hadoop paths of a moved file: its path below ``root``, else its name, below ``dest_dir``."""
    path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    src, base = path(file), None
    if root:
        base = path(root).getFileSystem(conf).makeQualified(path(root)).toUri().getPath().rstrip("/") + "/"
    whole = src.toUri().getPath()
    return src, path(path(dest_dir), whole[len(base) :] if base and whole.startswith(base) else src.getName())


def moved_path(spark: SparkSession, file: str, dest_dir: str, root: str | None = None) -> str:
    """Where :func:`move_each` puts a file."""
    return str(_target(spark, file, dest_dir, root)[1])


def move_each(spark: SparkSession, files: Iterable[str], dest_dir: str, root: str | None = None) -> Iterator[str]:
    """Move files to ``dest_dir`` (archive / rejected) one by one, keeping their path below ``root`` (else their name).

    Yields where each went; raises if one could not be moved, as it would be read again.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in files:
        src, target = _target(spark, f, dest_dir, root)
        target.getFileSystem(conf).mkdirs(target.getParent())
        if not src.getFileSystem(conf).rename(src, target):
            raise OSError(f"could not move {f} to {target}")
        yield str(target)


def move_files(spark: SparkSession, files: Iterable[str], dest_dir: str, root: str | None = None) -> list[str]:
    """:func:`move_each` of all files."""
    return list(move_each(spark, files, dest_dir, root))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (nested values kept)."""
    df.write.mode(mode).json(path)


def stringify_nested(df: DataFrame) -> DataFrame:
    """Struct / array / map columns as JSON text (for CSV)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, nested columns stringified."""
    stringify_nested(df).write.mode(mode).option("header", "true").csv(path)


def export_values(df: DataFrame) -> DataFrame:
    """Dates / timestamps → ISO text, decimals → double (JSON-safe)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            cols.append(c.cast("double").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def entity_documents(key: str, parts: dict[str, DataFrame], order: dict[str, Sequence[Column]] | None = None) -> DataFrame:
    """One nested document per entity from several per-entity views.

    Every part is grouped by ``key`` into an ordered list of structs and the
    lists are joined on the key (equi joins on the aggregated, one-row-per-
    entity frames).  Parts must be bounded per entity (top-k lists, calendar
    rows), as the product views are.  ``order`` lists value expressions
    sorted ascending (negate a number for descending).
    """
    order = order or {}
    doc = None
    for name, part in parts.items():
        p = export_values(part)
        payload = [c for c in p.columns if c != key]
        sort_cols = [c for c in order.get(name, [])]
        item = F.struct(*[F.col(c) for c in payload])
        if sort_cols:
            keyed = F.struct(*[s.alias(f"_s{i}") for i, s in enumerate(sort_cols)], item.alias("_v"))
            agg = F.transform(F.array_sort(F.collect_list(keyed)), lambda x: x["_v"])
        else:
            agg = F.collect_list(item)
        g = p.groupBy(key).agg(agg.alias(name))
        doc = g if doc is None else doc.join(g, key, "full_outer")
    return doc


def write_documents(docs: DataFrame, key: str, path: str) -> None:
    """One JSON document per entity under ``path/{key}=…/``."""
    docs.repartition(key).write.mode("overwrite").partitionBy(key).json(path)


class DocumentStore:
    """S26–S29 for many entities: JSON documents in a fixed number of files, found by key.

    ``documents/_bucket=<n>/`` holds one file of JSON lines, in key order: the documents whose key hashes to ``n``.
    ``index/`` (Parquet, by bucket too) says for each key its file, its line there (from 0) and its length, so a
    reader of plain files can fetch one document.  A million entities are a few hundred files, not a million folders,
    and reading some keys reads their buckets only.  ``buckets`` bounds the files; choose it so that a bucket fits a task.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int").alias("_bucket")

    def write(self, docs: DataFrame) -> None:
        """Replace the store by these documents: one row each, ``key`` unique and not null."""
        exported = export_values(docs)
        text = exported.select(self._bucket(F.col(self.key)), F.col(self.key).cast("string").alias("key"),
                               F.to_json(F.struct("*")).alias("value"))
        # one task per bucket writes its file in key order
        placed = text.repartition(self.buckets, "_bucket").sortWithinPartitions("_bucket", "key")
        placed.select("_bucket", "value").write.mode("overwrite").partitionBy("_bucket").text(f"{self.path}/documents")
        # the index is taken from what was written: the documents are not built a second time
        own = T.StructType([T.StructField(self.key, exported.schema[self.key].dataType)])
        written = self.lines().select("_bucket", F.from_json("value", own)[self.key].cast("string").alias("key"),
                                      F.octet_length("value").alias("bytes"), "file")
        line = F.row_number().over(Window.partitionBy("_bucket").orderBy("key")) - 1
        index = written.select("_bucket", "key", line.cast("long").alias("line"), "bytes", "file")
        index.repartition(self.buckets, "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/index")

    def lines(self) -> DataFrame:
        """All documents as text: _bucket, value, file."""
        read = self.spark.read.schema("value string, _bucket int").text(f"{self.path}/documents")
        return read.select("_bucket", "value", F.col("_metadata.file_name").alias("file"))

    def index(self) -> DataFrame:
        """key, file, line, bytes of every document."""
        return self.spark.read.parquet(f"{self.path}/index")

    def read(self, schema: T.StructType, keys: Sequence | None = None) -> DataFrame:
        """The documents as rows; with ``keys`` only those, from their buckets only."""
        found = self.lines()
        if keys is not None:
            names = [str(k) for k in keys]
            own = self.spark.createDataFrame([(n,) for n in names], "key string").select(self._bucket(F.col("key")))
            found = found.filter(F.col("_bucket").isin([r[0] for r in own.distinct().collect()])).filter(
                F.get_json_object("value", f"$.{self.key}").isin(names))
        return found.select(F.from_json("value", schema).alias("d")).select("d.*")


def bundle(parts: dict[str, DataFrame]) -> DataFrame:
    """One row holding each (small, bounded) dataset as an array of structs, each a scalar subquery."""
    columns = []
    for name, part in parts.items():
        p = export_values(part)
        columns.append(p.agg(F.collect_list(F.struct(*p.columns))).scalar().alias(name))
    return next(iter(parts.values())).sparkSession.range(1).select(*columns)


def export_population(stats: DataFrame, key: str, plays_col: str, last_col: str, top_n: int, since) -> DataFrame:
    """Entities in the top ``top_n`` by plays OR active since ``since``.

    The top-N is a ``TakeOrderedAndProject`` (per-task top-N, then an
    N-row merge), never a global window over every entity.
    """
    from tessera.operators.relational import global_top_k

    top = global_top_k(stats, [F.col(plays_col).desc(), F.col(key)], top_n, rank_col=None).select(key)
    active = stats.filter(F.col(last_col) >= F.lit(since)).select(key)
    keys = top.unionByName(active).distinct()
    return stats.join(keys, key, "left_semi")


# ---- backfill slicing (S32–S34) ----------------------------------------------------------

def month_slices(spark: SparkSession, start, end) -> DataFrame:
    """Calendar-month ranges clipped to ``[start, end]``."""
    s, e = F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end)))
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(s, "MM"), e, F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return months.select(
        F.greatest(F.col("m"), s).alias("slice_start"),
        F.least(F.last_day(F.col("m")), e).alias("slice_end"))


def day_chunks(spark: SparkSession, start, end, days: int) -> DataFrame:
    """Fixed ``days``-day chunks; the next starts the day after the previous end."""
    s, e = F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end)))
    starts = spark.range(1).select(F.explode(F.sequence(s, e, F.expr(f"INTERVAL {days} DAYS"))).alias("slice_start"))
    return starts.select("slice_start", F.least(F.date_add("slice_start", days - 1), e).alias("slice_end"))


def pending_slices(slices: DataFrame, progress: DataFrame) -> DataFrame:
    """Slices not yet completed (``progress`` has slice_start, status)."""
    done = progress.filter(F.col("status") == "completed").select("slice_start")
    return slices.join(done, "slice_start", "left_anti")
