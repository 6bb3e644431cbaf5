"""Mixing sources to target weights with a low-discrepancy schedule (operator 1).

1. A source's target is its weight's share of the mix, stopped at twice the
   source's size, the excess reshared by weight (water level).
2. Slot ``i`` of the schedule has the golden-ratio point ``i * F45 mod F46``
   (exact in longs); mapped through the cumulative targets it names a source.
   Slots are ranked per source by counts per run of slots plus prefix sums.
3. A source's documents, shuffled by a hash of their id and text, are one long stream
   of words read up to twice, cut into blocks of ``block`` words.  Slot rank
   ``r`` takes block ``r``; the last block is cut so that the source ends at
   its target.  A source whose slots fall short by the schedule's discrepancy
   (a few) gets its last slots at the end.

No window or group spans a whole source: offsets and ranks are split prefix
sums, so a source with a third of all rows is spread over many tasks.

Defined results: a null source is a source of its own (last in order); a null
id is an id like any other; a null, empty or wordless text has size 0 and
takes 0; every row of a repeated id is a document of its own; an empty table
gives an empty result; columns other than the three read are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_names, running_total, staged, word_count

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Words of a block (the unit a slot takes) and slots numbered together.
BLOCK, RUN = 128, 4096
#: Two neighbouring Fibonacci numbers: their ratio is the golden ratio's, and products stay below 2^63.
STEP, MODULUS = 1_134_903_170, 1_836_311_903
CELLS = 4096


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(key, source, source_size) -> the same with ``target``; one row per source."""
    total = Window.partitionBy(F.lit(0))
    ordered = total.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("ord", F.row_number().over(ordered) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("ord") % len(weights) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(MOST))
    ranked = ranked.withColumn("ratio", F.col("most") / F.col("weight"))
    by_ratio = total.orderBy("ratio", "ord")
    before = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = ((F.sum("source_size").over(total) * F.lit(share)) - before) / rest
    ranked = ranked.withColumn("level", level)
    water = F.first(F.when(F.col("ratio") > F.col("level"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    ranked = ranked.withColumn("water", water)
    target = F.when(F.col("ratio") > F.col("water"), F.col("water") * F.col("weight")).otherwise(F.col("most"))
    return ranked.select("key", "source", "ord", "source_size", target.alias("target"))


def schedule(plan: DataFrame, block: int) -> DataFrame:
    """(ord, target) per source -> (slot, ord, rank): which block each slot takes, ``need`` slots a source."""
    spark = plan.sparkSession
    whole = Window.partitionBy(F.lit(0))
    upto = whole.orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("target").over(upto) / F.sum("target").over(whole)
    bounds = (
        plan.filter("target > 0")
        .withColumn("need", F.ceil(F.col("target") / block))
        .withColumn("hi", F.floor(share * MODULUS).cast("long"))
        .withColumn("lo", F.coalesce(F.lag("hi").over(whole.orderBy("ord")), F.lit(0).cast("long")))
        .select("ord", "need", "lo", "hi")
    )
    n_slots = bounds.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]
    cell = f"(%s * {CELLS}) div {MODULUS}"
    cells = bounds.filter("hi > lo").withColumn(
        "cell", F.explode(F.expr(f"sequence({cell % 'lo'}, {cell % '(hi - 1)'})"))
    )
    points = (
        spark.range(n_slots)
        .withColumnRenamed("id", "slot")
        .withColumn("point", F.expr(f"((slot % {MODULUS}) * {STEP}) % {MODULUS}"))
        .withColumn("cell", F.expr(cell % "point"))
    )
    drawn = points.join(cells, "cell").filter("point >= lo and point < hi")
    drawn = drawn.select("slot", "ord", "need", F.expr(f"slot div {RUN}").alias("run"))
    runs = running_total(drawn.groupBy("ord", "run").agg(F.count("*").alias("n")), "ord", "run", "n", "before")
    place = F.row_number().over(Window.partitionBy("ord", "run").orderBy("slot"))
    ranked = drawn.withColumn("place", place).join(runs.select("ord", "run", "before"), ["ord", "run"])
    ranked = ranked.select("slot", "ord", "need", (F.col("before") + F.col("place") - 1).alias("rank"))
    have = drawn.groupBy("ord").agg(F.count("*").alias("have"))
    short = (
        bounds.join(have, "ord", "left")
        .withColumn("have", F.coalesce("have", F.lit(0).cast("long")))
        .filter("have < need")
        .withColumn("rank", F.explode(F.expr("sequence(have, need - 1)")))
    )
    closing = short.select(F.lit(n_slots).cast("long").alias("slot"), "ord", "need", "rank")
    return ranked.filter("rank < need").unionByName(closing).select("slot", "ord", "rank")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """documents -> one row each: doc_id, size, source_size, target, taken, slot, source, text_hash.

    ``slot`` is the first slot of the schedule that takes words of the document (null if none does): read in this
    order, the mix holds its sources at their target weights all along.
    """
    sized = staged(
        docs.select(
            "doc_id",
            "source",
            F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")).alias("key"),
            word_count(F.col("text")).alias("size"),
            F.xxhash64("doc_id", "text").alias("hash"),  # rows of one id (or none) do not share a bucket
            F.xxhash64("text").alias("text_hash"),
        ),
        "mix-sizes",
    )
    bits = max(8, (sized.count() // 64).bit_length())
    sized = sized.withColumn("bucket", F.shiftrightunsigned("hash", 64 - bits))
    buckets = sized.groupBy("key", "bucket").agg(F.sum("size").alias("words"), F.first("source").alias("source"))
    per_source = buckets.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    plan = staged(targets(per_source, weights, share), "mix-targets")
    offsets = running_total(buckets.drop("source"), "key", "bucket", "words", "before").drop("words")
    offsets = offsets.join(plan.drop("source"), "key")

    within = Window.partitionBy("key", "bucket").orderBy("hash", "doc_id", "text_hash")
    spread = (
        sized.withColumn("row", F.row_number().over(within))
        .withColumn("ahead", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(offsets, ["key", "bucket"])
        .withColumn("limit", F.least(F.round("target").cast("long"), (F.col("source_size") * F.lit(MOST)).cast("long")))
    )
    start = F.col("before") + F.col("ahead")
    first = F.col("start")
    last = F.least(F.col("start") + F.col("size"), F.col("limit")) - 1
    passes = F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long")))
    pieces = (
        spread.select("doc_id", "source", "text_hash", "ord", "bucket", "row", "size", "source_size", "target", "limit",
                      start.alias("offset"), passes.alias("pass"))
        .withColumn("start", F.col("pass") * F.col("source_size") + F.col("offset"))
        .withColumn(
            "block",
            F.explode_outer(F.when(last >= first, F.expr(
                f"sequence(start div {block}, (least(start + size, limit) - 1) div {block})"))),
        )
    )
    stop = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block, F.col("limit"))
    words = stop - F.greatest(F.col("start"), F.col("block") * block)
    slots = schedule(plan, block).select("slot", F.col("ord").alias("s_ord"), F.col("rank").alias("s_rank"))
    joined = pieces.join(slots, (pieces.ord == slots.s_ord) & (pieces.block == slots.s_rank), "left")
    taken = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), words)), F.lit(0)).cast("long").alias("taken")
    return (
        joined.groupBy("ord", "bucket", "row", "doc_id", "source", "text_hash", "size", "source_size", "target")
        .agg(taken, F.min("slot").alias("slot"))
        .select("doc_id", "size", "source_size", "target", "taken", "slot", "source", "text_hash")
    )


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def first_words(text: str, n: int) -> str:
    """``text`` up to the end of its ``n``-th word."""
    return text[: next(islice(_WORD.finditer(text), n - 1, None)).end()]


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, with all their columns.

    What a document takes beyond whole readings is a row cut after that many
    words (``n_chars``, where there is such a column, follows).  Rows equal in
    id, source and text share evenly what they take.  Documents that take
    nothing leave.  Every partition is in the order of the schedule's slots, so
    a reader meets the sources at their target weights from its first rows on.
    """
    own_id, own_source, own_hash, own_size, own_taken, own_slot = free_names(
        docs.columns, "__id", "__source", "__hash", "__size", "__taken", "__slot")
    takes = (
        mix(docs, weights, share, block)
        .groupBy(F.col("doc_id").alias(own_id), F.col("source").alias(own_source), F.col("text_hash").alias(own_hash))
        .agg(F.first("size").alias(own_size), F.expr("sum(taken) div count(*)").alias(own_taken),
             F.min("slot").alias(own_slot))
        .filter(F.col(own_taken) > 0)
    )
    same = (
        docs.doc_id.eqNullSafe(F.col(own_id)) & docs.source.eqNullSafe(F.col(own_source))
        & (F.xxhash64(docs.text) == F.col(own_hash))
    )
    chosen = docs.join(takes, same).select(*docs.columns, own_size, own_taken, own_slot).sortWithinPartitions(own_slot)
    names = docs.columns

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            sizes, taken = batch.column(own_size).to_pylist(), batch.column(own_taken).to_pylist()
            for row, (text, size, left) in enumerate(zip(batch.column("text").to_pylist(), sizes, taken, strict=True)):
                while left > 0:
                    rows.append(row)
                    texts.append(text if left >= size else first_words(text, left))
                    left -= size
            out = batch.select(names).take(pa.array(rows, pa.int64()))
            columns = {n: out.column(n) for n in names}
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([len(t) for t in texts], pa.int64()).cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return chosen.mapInArrow(read, docs.schema)
