"""Shared helpers: words, staged tables, bounded slices of Arrow batches, split prefix sums."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Fixed value: the white space that separates words (space and U+0009..U+000D).
WHITE = r"[\x20\x09-\x0D]+"
#: Bytes of text handled at once inside a task; keeps a Python worker's memory flat.
SLICE_BYTES = 1 << 20


#: Bytes of rows sent to a Python worker at once by the stages of the corpus pipeline.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """Let Arrow batches end at ``limit`` bytes too, not at a number of rows alone (a row beyond it is a batch).

    A session setting that is read when a plan is made; results don't depend on it.  Stages of several kinds share
    the Python workers of a long session, which keep the memory of their largest batch.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


def free_names(columns: Sequence[str], *names: str) -> list[str]:
    """Helper column names that none of ``columns`` has (compared without case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs of a text; null counts as empty."""
    parts = F.split(F.coalesce(text, F.lit("")), WHITE)
    edges = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when(
        (F.element_at(parts, -1) == "") & (F.size(parts) > 1), 1
    ).otherwise(0)
    return (F.size(parts) - edges).cast("long")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts lineage, survives lost executors)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # a given schema: an empty table reads back too


def slices(texts: Sequence[bytes | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of whole texts of about ``limit`` bytes (one longer text is a run of its own)."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def running_total(counts: DataFrame, key: str, pos: str, value: str, out: str, width: int = 1024) -> DataFrame:
    """Add ``out``: the sum of ``value`` over smaller ``pos`` of the same ``key``, never one window over a whole key.

    ``pos`` is a non-negative long, unique within the key.  Rows are summed
    inside blocks of ``width`` positions; only one row per block meets in a
    window over the key.
    """
    blocks = counts.withColumn("__block", F.expr(f"`{pos}` div {width}"))
    inside = Window.partitionBy(key, "__block").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    over = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        counts.groupBy(key, F.expr(f"`{pos}` div {width}").alias("__block"))
        .agg(F.sum(value).alias("__sum"))
        .select(key, "__block", F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__before"))
    )
    return (
        blocks.join(before, [key, "__block"])
        .withColumn(out, F.col("__inside") + F.col("__before"))
        .drop("__block", "__inside", "__before")
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
