"""Benchmark decontamination by SimHash windows and multi-index blocks (operator 8).

Texts are compared as lower-case words without punctuation marks, as weighted
sets of five-word shingles (repeats count; an item of fewer words is one
shingle).  For each benchmark item the windows of its length that share any
shingle with it are fingerprinted.  The item fingerprints of one length are
kept in ``RADIUS + 1`` block tables: fingerprints within the radius agree in at
least one block, so the tables return all of them.  Candidates within the
radius are verified by the exact weighted similarity of the shingles.

A window without a shared shingle has similarity 0, so leaving it out loses
nothing.  The benchmark is read in blocks of at most about ``BLOCK_WORDS``
words; each block's index is broadcast and all documents are read against it.
Equal item texts are one entry of one block, however many items have them; their
ids are joined back on Spark.

Defined results: null, empty or wordless items and documents match nothing; a
document shorter than an item is one window; repeated rows each give their
rows; a repeated item id gives a row per item text it matches; of windows
equally similar to an item the first counts; a document of any length is read
whole; other columns, whatever their names, are not looked at; empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tessera.llm.common import word_count

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 20
BLOCK_WORDS = 1_000_000
#: Window starts, and words they spread over, that are fingerprinted at once: bounds a task's memory on very long texts.
WINDOWS, SPAN = 4_096, 65_536
_MARKS = b".,;:!?\"'()[]{}"
_LOWER = bytes(range(256)).lower()
_MULTIPLIER = 0x9E3779B97F4A7C15
_BITS = np.array([bin(v).count("1") for v in range(256)], np.int16)


def plain_words(text: bytes | None) -> list[bytes]:
    return text.translate(_LOWER, _MARKS).split() if text else []


def shingles(words: list[bytes], size: int = SHINGLE) -> list[int]:
    """64-bit hashes of the runs of ``size`` words; fewer words are one run, none no run."""
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words))] if words else []
    return [xxhash.xxh64_intdigest(b" ".join(words[i : i + size])) for i in range(len(words) - size + 1)]


def similarity(one: Counter, other: Counter) -> float:
    """Weighted Jaccard similarity of two shingle counts."""
    shared = sum(min(n, other[s]) for s, n in one.items() if s in other)
    whole = one.total() + other.total() - shared
    return shared / whole if whole else 0.0


def window_fingerprints(hashes: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """SimHash (uint64) of ``count`` shingles from each start: a bit is set if more than half of them set it."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    upto = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=upto[1:])
    ones = upto[starts + count] - upto[starts]
    return np.packbits(2 * ones > count, axis=1, bitorder="little").view(np.uint64).ravel()


def _spans(starts: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of sorted window starts, of at most ``WINDOWS`` starts over at most ``SPAN`` words."""
    at = 0
    while at < len(starts):
        stop = min(at + WINDOWS, int(np.searchsorted(starts, starts[at] + SPAN, "right")))
        yield starts[at:stop]
        at = stop


class BlockTables:
    """Multi-index Hamming lookup of the fingerprints of all items of one length."""

    def __init__(self, fingerprints: np.ndarray, radius: int):
        self.fingerprints, self.radius = fingerprints, radius
        edges = np.linspace(0, 64, radius + 2).astype(int)
        self.shifts = edges[:-1].astype(np.uint64)
        self.masks = np.array([(1 << int(w)) - 1 for w in np.diff(edges)], np.uint64)
        self.tables: list[dict[int, np.ndarray]] = []
        for values in self._values(fingerprints).T:
            self.tables.append({int(v): np.flatnonzero(values == v) for v in np.unique(values)})

    def _values(self, fingerprints: np.ndarray) -> np.ndarray:
        return (fingerprints[:, None] >> self.shifts) & self.masks

    def within(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all pairs within the radius."""
        found = np.zeros((len(windows), len(self.fingerprints)), bool)
        for values, held in zip(self._values(windows).T, self.tables, strict=True):
            for v in np.unique(values).tolist():
                if v in held:
                    found[np.ix_(values == v, held[v])] = True
        at, item = np.nonzero(found)
        apart = _BITS[(windows[at] ^ self.fingerprints[item])[:, None].view(np.uint8)].sum(1)
        return at[apart <= self.radius], item[apart <= self.radius]


class Index:
    """Items of one block of the benchmark: shared shingles, block tables per length, exact shingle counts."""

    def __init__(self, items: list[tuple[object, bytes]], radius: int = RADIUS):
        self.radius = radius
        held = [(i, w) for i, w in ((i, plain_words(t)) for i, t in items) if w]
        self.ids = [i for i, _ in held]
        self.words = {w: n for n, w in enumerate(sorted({w for _, ws in held for w in ws}), 1)}
        self.sizes = [len(w) for _, w in held]
        self.counts = [Counter(shingles(w)) for _, w in held]
        # number -> items that hold the shingle, per shingle length
        self.owners: dict[int, dict[int, list[int]]] = {}
        for n, (_, w) in enumerate(held):
            size = min(SHINGLE, len(w))
            keys = self.keys(np.array([self.words[x] for x in w], np.uint64), size)
            for key in np.unique(keys).tolist():
                self.owners.setdefault(size, {}).setdefault(key, []).append(n)
        self.sorted = {size: np.array(sorted(keys), np.uint64) for size, keys in self.owners.items()}
        self.by_size = {n: np.flatnonzero(np.array(self.sizes) == n) for n in set(self.sizes)}
        whole = np.array([self._whole(w) for _, w in held], np.uint64)
        self.tables = {n: BlockTables(whole[at], radius) for n, at in self.by_size.items()}

    @staticmethod
    def _whole(words: list[bytes]) -> int:
        hashes = np.array(shingles(words), np.uint64)
        return int(window_fingerprints(hashes, np.zeros(1, int), len(hashes))[0])

    @staticmethod
    def keys(numbers: np.ndarray, size: int) -> np.ndarray:
        """Rolling numbers of the runs of ``size`` words; runs with a foreign word (0) are 0."""
        n = len(numbers) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out, known = np.zeros(n, np.uint64), np.ones(n, bool)
        with np.errstate(over="ignore"):
            for j in range(size):
                out = out * np.uint64(_MULTIPLIER) + numbers[j : j + n]
                known &= numbers[j : j + n] > 0
        return np.where(known, out, np.uint64(0))

    def matches(self, text: bytes | None, least: float) -> list[tuple[object, float, int]]:
        """(item id, best similarity, first word of the best window) of all items found in a whole text."""
        words = plain_words(text)
        number = self.words.get
        numbers = np.array([number(w, 0) for w in words], np.uint64)
        starts: dict[int, set[int]] = {}  # window length -> starts of windows that share a shingle with an item
        for size, known in self.sorted.items():
            keys = self.keys(numbers, size)
            at = np.searchsorted(known, keys)
            at[at == len(known)] = 0
            for q in np.flatnonzero((known[at] == keys) & (keys > 0)).tolist():
                for item in self.owners[size][int(keys[q])]:
                    n = self.sizes[item]
                    last = max(0, len(words) - n)
                    starts.setdefault(n, set()).update(range(max(0, min(q - n + size, last)), min(q, last) + 1))
        best: dict[int, tuple[float, int]] = {}
        for n, begun in starts.items():
            every = np.array(sorted(begun))
            size = min(SHINGLE, n)
            count = min(n, len(words)) - size + 1
            for first in _spans(every):  # bounded runs of windows, the earliest first
                low, high = int(first[0]), min(int(first[-1]) + n, len(words))
                hashes = shingles(words[low:high], size)
                windows = window_fingerprints(np.array(hashes, np.uint64), first - low, count)
                at, item = self.tables[n].within(windows)
                for w in np.unique(at).tolist():
                    start = int(first[w])
                    held = Counter(hashes[start - low : start - low + count])
                    for i in item[at == w].tolist():
                        i = int(self.by_size[n][i])
                        alike = similarity(held, self.counts[i])
                        if alike >= least and alike > best.get(i, (0.0, 0))[0]:
                            best[i] = (alike, start)
        return [(self.ids[i], s, start) for i, (s, start) in sorted(best.items())]


def indexes(benchmark: DataFrame, radius: int = RADIUS, block_words: int = BLOCK_WORDS) -> Iterator[Index]:
    """The index of the benchmark's texts by their hash, a block of about ``block_words`` words at a time; at least one."""
    items = benchmark.filter("text IS NOT NULL").select("text").distinct()
    total = items.agg(F.coalesce(F.sum(word_count(F.col("text"))), F.lit(0))).first()[0]
    parts = max(1, -(-total // block_words))
    for part in range(parts):
        own = items.withColumn("key", F.xxhash64("text")).filter(F.pmod("key", F.lit(parts)) == part)
        yield Index([(r.key, r.text.encode()) for r in own.toLocalIterator()], radius)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """documents, benchmark -> doc_id, item_id, similarity, word_start: every item found in a document."""
    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("key", LongType()),
        StructField("similarity", DoubleType()), StructField("word_start", LongType()),
    ])
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def against(index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)  # one block of items

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    found += [(row, *m) for m in shared.value.matches(text, least)]
                row, item, alike, start = zip(*found, strict=True) if found else ((),) * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(item, pa.int64()),
                     pa.array(alike, pa.float64()), pa.array(start, pa.int64())],
                    names=["doc_id", "key", "similarity", "word_start"],
                )

        return texts.mapInArrow(run, schema)

    found = reduce(DataFrame.unionByName, map(against, indexes(benchmark, radius, block_words)))
    ids = benchmark.filter("text IS NOT NULL").select("item_id", F.xxhash64("text").alias("key"))
    return found.join(ids, "key").select("doc_id", "item_id", "similarity", "word_start")


def clean(
    docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns; nothing is shuffled."""

    def against(df: DataFrame, index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = (t.encode() if t else None for t in batch.column("text").to_pylist())
                yield batch.filter(pa.array([not shared.value.matches(t, least) for t in texts], pa.bool_()))

        return df.mapInArrow(run, docs.schema)

    return reduce(against, indexes(benchmark, radius, block_words), docs)
