"""Incremental operators I01–I09: keep-latest, high-water filter, merge/upsert.

No table format is assumed (plain Parquet).  A merge writes the new version
of the target to a staging path under the shared checkpoint folder and then
swaps it in with a Hadoop FileSystem rename, so readers never see a half
written table and an executor loss only reruns tasks of the write job.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _cols(cs: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    tie_break: Sequence[Column | str] = (),
    drop_null_keys: bool = False,
) -> DataFrame:
    """One row per key, the first by ``order`` (pass ``F.col(x).desc()``).

    ``row_number() … = 1`` lets Catalyst add a partial ``WindowGroupLimit``
    before the shuffle, so every map task forwards one row per key: a key
    holding a third of the rows still reaches its reducer as one row per
    task.  Rows with a null key form one group, as in the warehouse
    (``drop_null_keys`` removes them instead).  ``tie_break`` makes the
    winner deterministic when order values tie.
    """
    w = Window.partitionBy(*keys).orderBy(*_cols(order), *_cols(tie_break))
    src = df
    if drop_null_keys:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        src = df.filter(cond)
    return src.withColumn("_kl_rn", F.row_number().over(w)).filter(F.col("_kl_rn") == 1).drop("_kl_rn")


def high_water(target: DataFrame, col: str) -> Column:
    """``max(col)`` of ``target`` as a scalar-subquery column."""
    return target.select(F.max(col)).scalar()


def incremental_filter(
    source: DataFrame,
    target: DataFrame | None,
    source_col: str,
    target_col: str,
    overlap: str | None = None,
) -> DataFrame:
    """Rows of ``source`` newer than the target's high-water mark.

    No target (first run / full refresh) → the whole source.  ``overlap``
    (e.g. ``'1 hour'``) re-reads a margin below the mark to catch rows that
    were committed late (§7.4 #9); a later merge absorbs the repeats.
    The mark is an uncorrelated scalar subquery, so the comparison is a
    literal by the time the source scan runs and is pushed into it.
    """
    if target is None:
        return source
    mark = high_water(target, target_col)
    if overlap:
        mark = mark - F.expr(f"INTERVAL {overlap}")
    return source.filter((F.col(source_col) > mark) | mark.isNull())


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``source``, plus all ``source`` rows.

    ``left_anti`` + ``unionByName``: rows with a null key never match, so
    they are kept from the target and inserted again from the source, as a
    warehouse MERGE does.  New source columns are allowed (null-filled in
    old rows).
    """
    kept = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def stamp_updated(df: DataFrame, col: str = "_dp_updated_at") -> DataFrame:
    """Processing-time stamp on merged rows."""
    return df.withColumn(col, F.current_timestamp())


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def replace_path(spark: SparkSession, staging: str, final: str) -> None:
    """Swap a fully written staging directory into place.

    The old version is renamed aside first and removed only after the new one
    stands; if the second rename fails the old version is put back.
    """
    fs, dst = _fs(spark, final)
    _, src = _fs(spark, staging)
    _, aside = _fs(spark, f"{final.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
    had = fs.exists(dst)
    if had and not fs.rename(dst, aside):
        raise OSError(f"rename {final} aside failed")
    try:
        done, why = fs.rename(src, dst), None
    except Py4JJavaError as e:  # some file systems raise where others return false
        done, why = False, e
    if not done:
        if had:
            fs.rename(aside, dst)
        raise OSError(f"rename {staging} -> {final} failed") from why
    if had:
        fs.delete(aside, True)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """A key's bucket; null keys have one like any other."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _numbers(df: DataFrame, col: str) -> list[int]:
    """Distinct bucket numbers of a frame: at most as many as there are buckets."""
    return sorted(r[0] for r in df.select(col).distinct().collect())


def merge_bucketed(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """I03 on a table laid out by hash buckets of its keys: a merge reads and writes the buckets of its keys only.

    The layout is the index: a key has one place, ``_bucket=<n>``, so nothing of other buckets is read, not even
    their key columns, and their files stay as they are.  Touched buckets are written to the shared scratch folder
    and then put in place by dynamic partition overwrite.  ``buckets`` (fixed at the first write; the number of
    folders is the bound) should let a bucket be one to a few files.
    """
    from tessera.session import scratch_path

    placed = source.withColumn("_bucket", _bucket(keys, buckets))
    if not path_exists(spark, path):
        placed.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(path)  # a bucket's rows together
        return spark.read.parquet(path)
    staging = scratch_path(spark, "merge")
    placed.write.partitionBy("_bucket").parquet(f"{staging}/source")  # once: it is read for its buckets and its rows
    new = spark.read.schema(placed.schema).parquet(f"{staging}/source")
    touched = F.col("_bucket").isin(_numbers(new, "_bucket"))
    target = spark.read.parquet(path)
    merged = merge_upsert(target.filter(touched), new, [*keys, "_bucket"])
    merged.write.partitionBy("_bucket").parquet(f"{staging}/merged")
    (spark.read.schema(merged.schema).parquet(f"{staging}/merged").hint("rebalance", "_bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path))
    return spark.read.parquet(path)


def merge_into_path(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    full_refresh: bool = False,
    partition_by: Sequence[str] = (),
    updated_col: str | None = "_dp_updated_at",
    buckets: int | None = None,
) -> DataFrame:
    """I03 + I05 + I06 on a Parquet directory.

    First run or ``full_refresh`` → the source is written as the table.
    Otherwise: new version = merge_upsert(target, source); written to a
    staging directory, then swapped in.  With ``partition_by`` only the
    partitions that the source writes to or whose keys move are rewritten
    (dynamic partition overwrite).  With ``buckets`` a merge finds its keys by
    hash buckets: without partitions the table itself lies in them
    (:func:`merge_bucketed`, column ``_bucket``); with partitions an index of
    (keys, partition) in the table's folder does, so that moved keys are found
    without reading any other key of the table.
    """
    from tessera.session import scratch_path

    src = stamp_updated(source, updated_col) if updated_col else source
    index = f"{path.rstrip('/')}/_key_index"  # readers of the table pass over names that begin with an underscore
    place = [*keys, *[c for c in partition_by if c not in keys]]
    if full_refresh or not path_exists(spark, path):
        if buckets and not partition_by:
            placed = src.withColumn("_bucket", _bucket(keys, buckets))
            placed.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)
            return spark.read.parquet(path)
        writer = src.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        if buckets:
            merge_bucketed(spark, spark.read.parquet(path).select(*place), index, keys, buckets)
        return spark.read.parquet(path)
    if buckets and not partition_by:
        return merge_bucketed(spark, src, path, keys, buckets)
    target = spark.read.parquet(path)
    if partition_by:
        # partitions the source writes to, and those that hold a key that moves
        if buckets:
            known = src.select(*keys).distinct().withColumn("_bucket", _bucket(keys, buckets))
            held = spark.read.parquet(index).filter(F.col("_bucket").isin(_numbers(known, "_bucket"))).join(
                known, [*keys, "_bucket"], "left_semi").select(*partition_by)
        else:  # keys and partitions only are read
            held = target.join(src.select(*keys).distinct(), list(keys), "left_semi").select(*partition_by)
        touched = src.select(*partition_by).unionByName(held).distinct()
        affected = target.join(touched, list(partition_by), "left_semi")
        merged = merge_upsert(affected, src, keys)
        staged = scratch_path(spark, "merge")
        merged.write.mode("overwrite").partitionBy(*partition_by).parquet(staged)
        written = spark.read.schema(merged.schema).parquet(staged)
        emptied = touched.join(written.select(*partition_by).distinct(), list(partition_by), "left_anti").collect()
        (written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(path))
        if buckets:
            moved = written.join(src.select(*keys).distinct(), list(keys), "left_semi").select(*place)
            merge_bucketed(spark, moved, index, keys, buckets)
        for row in emptied:  # partition directories whose keys all moved away
            fs, gone = _fs(spark, path.rstrip("/") + "".join(f"/{c}={row[c]}" for c in partition_by))
            fs.delete(gone, True)
        return spark.read.parquet(path)
    merged = merge_upsert(target, src, keys)
    staged = scratch_path(spark, "merge")
    merged.write.mode("overwrite").parquet(staged)
    replace_path(spark, staged, path)
    return spark.read.parquet(path)


def unique_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q09 ``unique``: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)
