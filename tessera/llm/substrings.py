"""Substring dedup: repeated 35-word windows by FM-index shards (operator 9).

1. Every window of ``WINDOW`` words has a minimiser, the smallest hash among its
   runs of ``GRAM`` words; the windows in a row that share one are a segment.
   Equal windows have equal minimisers, so they meet wherever their segments
   are gathered by minimiser.  Only hashes are gathered at first.
2. A minimiser that occurs once repeats nothing.  One whose segments are all
   equal repeats all their windows.  The others are ambiguous: copies that part
   in the middle, passages in different surroundings.
3. One text of each different ambiguous segment goes to the shard of its
   minimiser.  A shard builds compressed FM-indexes of its segments (cut between
   minimisers, so of bounded size) and streams them through backward search;
   matching statistics of ``WINDOW`` words held twice mark repeated windows.
4. A minimiser with more than ``MOST`` different segments would be one task's
   work: its windows are counted by their exact 128-bit digests instead,
   pre-aggregated, so any number of them spreads over all tasks.
5. Each document gathers the marks of its own segments and drops the words
   they cover.

Windows are judged on the input.  Defined results: a null, empty or wordless
text has no words and the digest of the empty string; texts of fewer than
``WINDOW`` words keep all; every input row gives one row, and a repeated row is
a second place where its windows start; ids may be null; a text of any length
is read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, staged
from tessera.llm.fmindex import FMIndex

#: Contract: words of a window.  Words of a minimiser's run; windows that can share a minimiser.
WINDOW, GRAM = 35, 5
SPAN = WINDOW - GRAM + 1
#: Different segments of one minimiser that a shard takes; words of one FM-index; words of a shard.
MOST, INDEX_WORDS, SHARD_WORDS = 4_000, 100_000, 2_000_000
_BASE = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        out[1:] = np.uint64(base)
        return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts in a row, with prefix digests."""

    def __init__(self, texts: list[bytes]):
        words = [t.split() for t in texts]  # on bytes: the six ASCII white-space characters
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        digests = b"".join(xxhash.xxh3_128_digest(w) for ws in words for w in ws)
        self.pair = np.frombuffer(digests, np.uint64).reshape(-1, 2)
        self.count = len(self.pair)
        self.power = [_powers(b, WINDOW + SPAN + 1) for b in _BASE]

    def digest(self, start: np.ndarray, size: np.ndarray, which: int) -> np.ndarray:
        """Digest of the words [start, start + size), size at most WINDOW + SPAN."""
        with np.errstate(over="ignore"):
            out = np.zeros(len(start), np.uint64)
            for j in range(int(size.max()) if len(size) else 0):
                live = j < size
                out[live] = out[live] * np.uint64(_BASE[which]) + self.pair[start[live] + j, which]
        return _mix(out)

    def rolling(self, size: int, which: int) -> np.ndarray:
        n = self.count - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            out = np.zeros(n, np.uint64)
            for j in range(size):
                out = out * np.uint64(_BASE[which]) + self.pair[j : j + n, which]
        return _mix(out)


def segments(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, minimiser digest) of all segments of the texts."""
    grams = words.rolling(GRAM, 0)
    windows = words.count - WINDOW + 1
    if windows <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64)
    # smallest gram of each window, the leftmost of equal ones: doubling runs of positions
    best, run = np.arange(len(grams)), 1
    smaller = lambda a, b: np.where(grams[b] < grams[a], b, a)
    while run * 2 <= SPAN:
        best = smaller(best[: len(best) - run], best[run:])
        run *= 2
    best = smaller(best[:windows], best[SPAN - run : SPAN - run + windows])
    owner = np.repeat(np.arange(len(words.sizes)), words.sizes)
    inside = owner[:windows] == owner[WINDOW - 1 :]  # windows that lie in one text
    new = np.ones(windows, bool)
    new[1:] = (best[1:] != best[:-1]) | ~inside[:-1] | (owner[1:windows] != owner[: windows - 1])
    at = np.flatnonzero(new & inside)
    stop = np.append(np.flatnonzero(new | ~inside), windows)
    size = stop[np.searchsorted(stop, at, side="right")] - at
    return owner[at], at, size, grams[best[at]]


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        rows = batch.column("row").to_numpy()
        for a, b in slices(texts):
            words = Words(texts[a:b])
            text, at, size, key = segments(words)
            digest = words.digest(at, size + WINDOW - 1, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[a:b][text]), pa.array((at - words.starts[text]).astype(np.int32)),
                 pa.array(size.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(digest.view(np.int64))],
                names=["row", "start", "windows", "key", "digest"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the places of segments -> the segments' words, joined by spaces."""
    for batch in batches:
        out: list[tuple] = []
        for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True):
            words = text.split()
            for p in places:
                out.append((p["key"], p["digest"], p["windows"], p["n"],
                            b" ".join(words[p["start"] : p["start"] + p["windows"] + WINDOW - 1])))
        key, digest, windows, n, held = zip(*out, strict=True) if out else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(digest, pa.int64()), pa.array(windows, pa.int32()),
             pa.array(n, pa.int64()), pa.array(held, pa.binary())],
            names=["key", "digest", "windows", "n", "words"],
        )


def marks(parts: list[list[bytes]], weights: list[int]) -> list[int]:
    """Bit masks of the repeated windows of each segment, by an FM-index over all of them."""
    number: dict[bytes, int] = {}
    coded = [np.array([number.setdefault(w, len(number) + 1) for w in p], np.int64) for p in parts]
    index = FMIndex(coded, WINDOW)
    starts = np.cumsum([0] + [len(c) + 1 for c in coded])
    text = np.concatenate([x for c in coded for x in (c, np.zeros(1, np.int64))])
    # segments that stand in several places repeat whole; the windows of the others are looked up
    alone = [i for i, n in enumerate(weights) if n == 1]
    ends = [np.arange(starts[i] + WINDOW - 1, starts[i] + len(coded[i])) for i in alone]
    repeated = index.matching_statistics(text, np.concatenate(ends), 2) >= WINDOW if ends else np.zeros(0, bool)
    out, at = [(1 << (len(c) - WINDOW + 1)) - 1 for c in coded], 0
    for i in alone:
        m = len(coded[i]) - WINDOW + 1
        out[i] = int((repeated[at : at + m].astype(np.int64) << np.arange(m)).sum())
        at += m
    return out


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard, sorted by minimiser: FM-indexes over whole groups of about ``INDEX_WORDS`` words."""
    held: list[tuple] = []
    size, last = 0, None

    def flush() -> pa.RecordBatch:
        found = marks([h[4].split() for h in held], [h[3] for h in held])
        return pa.RecordBatch.from_arrays(
            [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()),
             pa.array([h[2] for h in held], pa.int32()), pa.array(found, pa.int64())],
            names=["key", "digest", "windows", "mask"],
        )

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "digest", "windows", "n", "words")), strict=True):
            if size >= INDEX_WORDS and row[0] != last:
                yield flush()
                held, size = [], 0
            held.append(row)
            size += row[2] + WINDOW
            last = row[0]
    if held:
        yield flush()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a hot minimiser -> one row per window, with its 128-bit digest."""
    for batch in batches:
        words = Words(batch.column("words").to_pylist())
        windows = np.array(batch.column("windows").to_pylist(), np.int64)
        owner = np.repeat(np.arange(len(windows)), windows)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = words.starts[owner] + place
        take = lambda c: batch.column(c).take(pa.array(owner))
        one, two = (words.digest(at, np.full(len(at), WINDOW), i).view(np.int64) for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [take("key"), take("digest"), take("windows"), take("n"), pa.array(one), pa.array(two),
             pa.array(np.left_shift(np.int64(1), place))],
            names=["key", "digest", "windows", "n", "h1", "h2", "bit"],
        )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, places in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist(), strict=True):
            words = (text or b"").split()
            n = len(words)
            if places:
                edge = np.zeros(n + 1, np.int32)
                for p in places:
                    hits = np.flatnonzero((p["mask"] >> np.arange(p["windows"])) & 1) + p["start"]
                    np.add.at(edge, hits, 1)
                    np.add.at(edge, hits + WINDOW, -1)
                keep = np.cumsum(edge[:-1]) == 0
                words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
            out.append((n, n - len(words), b" ".join(words)))
        n, gone, kept = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _removed(batches):
        digests = [hashlib.sha256(k).hexdigest() for k in batch.column("kept").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"]
        )


def repeated_segments(texts: DataFrame, most: int = MOST) -> DataFrame:
    """(row long, text binary) -> (row, start, windows, mask): segments with at least one repeated window."""
    spark = texts.sparkSession
    found = staged(
        texts.mapInArrow(_segment_rows, "row long, start int, windows int, key long, digest long"), "substr-segments"
    )
    keys = (
        found.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi"),
             F.min("windows").alias("w_lo"), F.max("windows").alias("w_hi"))
        .filter("n > 1").select("key", F.expr("lo = hi and w_lo = w_hi").alias("alike"))
    )
    repeated = staged(found.join(staged(keys, "substr-keys"), "key"), "substr-repeated")
    alike = repeated.filter("alike").select("row", "start", "windows", F.expr("shiftleft(1L, windows) - 1").alias("mask"))
    unlike = repeated.filter("not alike").drop("alike")

    classes = staged(
        unlike.groupBy("key", "digest", "windows").agg(
            F.count("*").alias("n"), F.min(F.struct("row", "start")).alias("at")), "substr-classes")
    hot = staged(classes.groupBy("key").count().filter(F.col("count") > most).select("key"), "substr-hot")
    places = classes.groupBy(F.col("at.row").alias("row")).agg(
        F.collect_list(F.struct("key", "digest", "windows", "n", F.col("at.start").alias("start"))).alias("places"))
    held = staged(
        texts.join(places, "row").select("text", "places")
        .mapInArrow(_cut, "key long, digest long, windows int, n long, words binary"), "substr-words")

    size = held.agg(F.coalesce(F.sum(F.col("windows") + WINDOW), F.lit(0))).first()[0]
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(wide, -(-size // SHARD_WORDS))
    result = "key long, digest long, windows int, mask long"
    by_index = (
        held.join(hot, "key", "left_anti").repartition(shards, "key").sortWithinPartitions("key").mapInArrow(_shard, result)
    )
    windows = staged(
        held.join(hot, "key", "left_semi")
        .mapInArrow(_windows, "key long, digest long, windows int, n long, h1 long, h2 long, bit long"), "substr-windows")
    twice = windows.groupBy("h1", "h2").agg(F.sum("n").alias("times")).filter("times > 1").select("h1", "h2")
    twice = staged(twice, "substr-twice")  # a plain join below, which Spark may split at a hot window
    by_digest = windows.join(twice, ["h1", "h2"]).groupBy("key", "digest", "windows").agg(F.bit_or("bit").alias("mask"))
    marked = staged(by_index.unionByName(by_digest).filter("mask <> 0"), "substr-marks")
    some = unlike.join(marked, ["key", "digest", "windows"]).select("row", "start", "windows", "mask")
    return alike.unionByName(some)


def _with_marks(docs: DataFrame) -> DataFrame:
    texts = staged(
        docs.select("doc_id", F.col("text").cast("binary").alias("text")).withColumn("row", F.monotonically_increasing_id()),
        "substr-texts",
    )
    found = repeated_segments(texts.filter("text is not null").select("row", "text"))
    per_row = found.groupBy("row").agg(F.collect_list(F.struct("start", "windows", "mask")).alias("marks"))  # of one text
    return texts.join(per_row, "row", "left").select("doc_id", "text", "marks")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, n_words, n_removed, kept (the kept words joined by one space, as binary)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _with_marks(docs).mapInArrow(_removed, f"doc_id {kind}, n_words long, n_removed long, kept binary")


def removal_digests(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, n_words, n_removed, kept_sha256."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _with_marks(docs).mapInArrow(_digests, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
