"""Quality rules by cross-document line frequency (operator 5).

Every document is read once: its base figures, and a hash of each of its
normalised lines (lower case, single spaces) with the number of words it
holds.  Per host (the source) the documents of a line are counted, and how many
of them are distinct: copies and near copies of one document are not.  A
document is told apart by its rarest line, as the smallest digest of that
line's three-word runs, which an edit here or there seldom changes; if even
that line is in more than ``LINE_DOCS`` documents, by its set of lines.  Lines in
more than ``LINE_DOCS`` distinct documents, making up at least ``DISTINCT`` of
the line's documents with different sets of lines, are removed: copies never
switch a removal off.  A document with less than ``LEFT`` of its
words left is rejected.

A line's counts are pre-aggregated per task and never collected; joins on a
line read written tables, so Spark may split one that holds a third of all rows.

Defined results: a null text counts as empty and fails the base rules; a null
source is a host of its own; every input row gives one row, so repeated rows
stay; a text of any length is read whole; lines without a word are neither
counted nor removed; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_names, staged

#: Fixed values of the base rules.
LEAST_WORDS, MOST_REPEATED, SYMBOLS = 50, 50, b"#*$%&|<>"
#: The method's limits: distinct documents of a line, share of them among its different sets of lines, words left.
LINE_DOCS, DISTINCT, LEFT = 20, 0.5, 0.2
_WHITE = b" \t\n\x0b\x0c\r"


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that stand in the text twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered = [False] * len(words)
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered[i] = covered[i + 1] = covered[i + 2] = True
    return sum(covered)


def base_figures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    words = raw.split()  # on bytes: exactly the six ASCII white-space characters
    lines = [x for x in raw.split(b"\n") if x.strip(_WHITE)]
    white = len(raw) - len(raw.translate(None, _WHITE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return len(words), len(text) - white, symbols, len(lines) - len(set(lines)), repeat_words(words)


def line_hashes(text: str) -> list[tuple[int, int, int]]:
    """(hash, smallest run digest, words) of each different line with a word; repeats add their words."""
    found: dict[int, list[int]] = {}
    for line in text.lower().encode().split(b"\n"):
        words = line.split()
        if not words:
            continue
        whole = b" ".join(words)
        h = xxhash.xxh64_intdigest(whole) - (1 << 63)
        if h in found:
            found[h][1] += len(words)
        else:
            runs = map(b" ".join, zip(words, words[1:], words[2:], strict=False)) if len(words) > 3 else (whole,)
            found[h] = [min(map(crc32, runs)), len(words)]
    return [(h, c, n) for h, (c, n) in found.items()]


_LINE = pa.struct([("h", pa.int64()), ("c", pa.int64()), ("n", pa.int64())])
_FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        figures = list(zip(*map(base_figures, texts), strict=True)) or [()] * len(_FIGURES)
        lines = [[{"h": h, "c": c, "n": n} for h, c, n in line_hashes(t)] for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), batch.column("text_hash"),
             *(pa.array(f, pa.int64()) for f in figures), pa.array(lines, pa.list_(_LINE))],
            names=["doc_id", "host", "text_hash", *_FIGURES, "lines"],
        )


def _host(docs: DataFrame) -> Column:
    return F.when(docs.source.isNull(), "n").otherwise(F.concat(F.lit("s"), docs.source))


def _judged(docs: DataFrame, line_docs: int, distinct: float, left: float) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, host string, text_hash long, {', '.join(f'{n} long' for n in _FIGURES)}, "
    read = docs.select("doc_id", _host(docs).alias("host"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _read, schema + "lines array<struct<h:long,c:long,n:long>>"
    )
    # an opaque row id, fixed by the write: ids of documents may be null or repeated
    base = staged(read.withColumn("row", F.monotonically_increasing_id()), "quality")
    lines = base.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.h", "l.c", "l.n")
    found = staged(lines.groupBy("host", "h").agg(F.count("*").alias("docs")), "quality-lines")
    rarest = F.min(F.struct("docs", -F.col("n"), "h", "c"))
    whole = F.bit_xor(F.xxhash64("h"))  # of the set of lines; tells a document without a line of its own apart
    own = F.when(rarest["docs"] > line_docs, whole).otherwise(rarest["c"])
    known = lines.join(found, ["host", "h"]).groupBy("row").agg(own.alias("own"), whole.alias("whole"))
    known = staged(known, "quality-rarest")
    often = staged(lines.join(found.filter(F.col("docs") > line_docs), ["host", "h"]), "quality-often")
    frequent = (
        often.join(known, "row")
        .select("host", "h", "own", "whole").distinct()
        .groupBy("host", "h", "own").agg(F.count("*").alias("n"))
        .groupBy("host", "h").agg(F.sum("n").alias("wholes"), F.count("*").alias("distinct"))
        .filter((F.col("distinct") > line_docs) & (F.col("distinct") >= F.col("wholes") * distinct))
        .select("host", "h")
    )
    removed = often.join(staged(frequent, "quality-frequent"), ["host", "h"]).groupBy("row").agg(
        F.sum("n").alias("n_removed_words")
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    enough = F.col("n_words") - F.col("n_removed_words") >= left * F.col("n_words")
    return (
        base.drop("lines").join(removed, "row", "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & enough)
    )


def judge(docs: DataFrame, line_docs: int = LINE_DOCS, distinct: float = DISTINCT, left: float = LEFT) -> DataFrame:
    """documents -> doc_id, the base figures, base_failed, kept, n_removed_words."""
    judged = _judged(docs, line_docs, distinct, left)
    return judged.select("doc_id", *_FIGURES, "base_failed", "kept", "n_removed_words")


def keep(docs: DataFrame, line_docs: int = LINE_DOCS, distinct: float = DISTINCT, left: float = LEFT) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The verdict is a function of id, source and text, so rows equal in these share it.
    """
    own_id, own_host, own_hash = free_names(docs.columns, "__id", "__host", "__hash")
    out = _judged(docs, line_docs, distinct, left).filter("not kept")
    out = out.select(F.col("doc_id").alias(own_id), F.col("host").alias(own_host), F.col("text_hash").alias(own_hash))
    same = (
        docs.doc_id.eqNullSafe(F.col(own_id)) & (F.xxhash64(docs.text) == F.col(own_hash)) & (_host(docs) == F.col(own_host))
    )
    return docs.join(out, same, "left_anti")
