"""Phrase collocations by multikey three-way quicksort of suffix pointers (operator 11).

A suffix is a word of a piece of text with the words behind it.  Its first d
words are a d-gram, and the number of suffixes that begin with it is its count.
One pass over the texts per depth d = 1, 2, ..., ``longest``:

* a task turns slices of texts into integers, adds up equal d-grams of a slice
  (so that a common one reaches its bucket once per slice, however many rows
  hold it) and routes them by a hash of their language and leading words;
* each bucket sorts pointers to its d-grams by multikey quicksort, all
  partitions at once: a partition is split three ways (less, equal, greater) by
  a pivot word at its depth, the equal part goes one word deeper, and the size
  of an equal part of full depth is the count.  A partition whose size is below
  the least count is abandoned on the spot;
* the d-grams that are left form a bitmap of fixed size by their hashes.  The
  next pass leaves out a (d+1)-gram unless the d-grams in it have their bit
  set.  A bit set by chance costs a little work and no more: counts are made of
  the words themselves.

No parts of frequent phrases are infrequent, so the tables of the passes hold
every count that the scores need.  The number of buckets follows the amount of
text, which bounds what one of them holds.

Defined results: null and empty texts hold no words; a null language is
``und``; repeated rows count each; an empty table gives an empty result; texts
of any length are read whole; other columns, whatever their names, are not
looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged

LEAST, LONGEST, TOP, COVERED = 10, 3, 2000, 50
#: Positions added up at once in a task, words a task's lexicon may hold, bytes of text per bucket.
SLICE, LEXICON, BUCKET_BYTES = 1 << 20, 400_000, 16 << 20
#: Parts of a language that are ranked by themselves first.
PARTS = 16
#: Bitmap of frequent d-grams: a bit per 8 bytes of text, between these powers of two (128 KB to 32 MB).
LEAST_BITS, MOST_BITS = 20, 28
#: Fixed values of the rule: what ends a piece, and what separates words; A-Z are lower-cased.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_MAP = bytes(10 if c in ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words of a whole text, with a full stop wherever a piece ends."""
    return text.translate(_MAP).replace(b"\n", b" . ").split()


def gram_hash(words: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of d-grams from the hashes of their words (which know their language)."""
    h = words[0]
    for w in words[1:]:
        h = (h ^ (h >> np.uint64(29))) * _ODD[0] + w * _ODD[1]
    h = (h ^ (h >> np.uint64(32))) * _ODD[0]
    return h ^ (h >> np.uint64(31))


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 42)


class Bits:
    """Fixed-size bitmap of hashes."""

    def __init__(self, data: bytes, power: int):
        self.data, self.shift = np.frombuffer(data, np.uint8), np.uint64(64 - power)

    def test(self, h: np.ndarray) -> np.ndarray:
        at = h >> self.shift
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


class Lexicon(dict):
    """Words of one language as small integers; 0 stands for the end of a piece."""

    def __init__(self, lang: str):
        super().__init__({b".": 0})
        self.seed, self.words, self.hashes = _seed(lang), [b"."], [0]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        return n


def add_up(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(first positions, counts) of the different d-grams of a slice; ``ids`` are the positions' windows, a row each."""
    bits = int(ids.max(initial=1)).bit_length()
    code, room = ids[:, 0].astype(np.int64), bits
    for j in range(1, depth):
        if room + bits > 62:
            code = np.unique(code, return_inverse=True)[1]
            room = len(code).bit_length()
        code, room = code << bits | ids[:, j], room + bits
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return first, counts


def _slice_rows(lang: str, lexicon: Lexicon, parts: list[np.ndarray], depth: int, filters: list[Bits], buckets: int):
    """A slice's d-grams, added up and packed by bucket."""
    ids = np.concatenate(parts)
    hashes = np.array(lexicon.hashes, np.uint64)
    good = ids > 0
    if depth > 1:  # words that are not frequent end a piece like full stops do
        frequent = filters[0].test(gram_hash([hashes]))
        frequent[0] = False
        good = frequent[ids]
    n = len(ids) - depth + 1
    start = good[:n].copy() if n > 0 else np.zeros(0, bool)
    for j in range(1, depth):
        start &= good[j : j + n]
    at = np.flatnonzero(start)
    if depth > 2 and len(at):  # both shorter grams inside must be frequent
        whole = hashes[ids]
        inner = np.zeros(len(ids), bool)
        ends = np.unique(np.concatenate((at, at + 1)))
        inner[ends] = filters[depth - 2].test(gram_hash([whole[ends + j] for j in range(depth - 1)]))
        at = at[inner[at] & inner[at + 1]]
    if not len(at):
        return
    windows = np.stack([ids[at + j] for j in range(depth)], axis=1)
    first, counts = add_up(windows, depth)
    grams = windows[first]
    bucket = (gram_hash([hashes[grams[:, j]] for j in range(depth)]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    grams, counts, bucket = grams[order], counts[order], bucket[order]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        used, local = np.unique(grams[a:b], return_inverse=True)
        yield (int(bucket[a]), lang, b" ".join([lexicon.words[i] for i in used.tolist()]),
               local.astype(np.int32).tobytes(), counts[a:b].tobytes())


_ROUTED = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("words", pa.binary()), ("grams", pa.binary()),
                     ("counts", pa.binary())])


def _record(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ROUTED.types, strict=True)], schema=_ROUTED)


def partitions(keys: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of pointers to rows of ``keys``: (a pointer, size) of each equal partition.

    The rows are words from the first on; a row weighs ``weights``.  All partitions are split at the same time; those
    of a size below ``least`` are abandoned.
    """
    depth_of = np.zeros(1, np.int64)
    order, part = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    rng, found, sizes = np.random.default_rng(7), [], []
    while len(order):
        members = np.bincount(part, minlength=len(depth_of))
        word = keys[order, depth_of[part]]
        pivot = word[np.cumsum(members) - 1 - rng.integers(0, members)][part]
        side = (word >= pivot).astype(np.int64) + (word > pivot)
        split = part * 3 + side
        size = np.bincount(split, weights[order], minlength=3 * len(depth_of)).astype(np.int64)
        depth_of = np.repeat(depth_of, 3)
        depth_of[1::3] += 1
        live = size >= least
        whole = live & (depth_of == keys.shape[1])
        if whole.any():
            any_of = np.zeros(len(size), np.int64)
            any_of[split] = order
            found.append(any_of[whole])
            sizes.append(size[whole])
        live &= ~whole
        stay = live[split]
        split, order = split[stay], order[stay]
        # move the pointers of each side together inside their partition, keeping their order
        held = np.bincount(split, minlength=len(size))
        shift = np.cumsum(held) - held - (np.cumsum(held.reshape(-1, 3), axis=0) - held.reshape(-1, 3)).ravel()
        moved, label = np.empty_like(order), np.empty_like(split)
        side = split % 3
        for s in range(3):
            at = np.flatnonzero(side == s)
            to = np.arange(len(at)) + shift[split[at]]
            moved[to], label[to] = order[at], split[at]
        order, part, depth_of = moved, (np.cumsum(live) - 1)[label], depth_of[live]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(sizes)


_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64()), ("h", pa.int64())])


def _counted(depth: int, least: int):
    """Buckets of routed grams -> lang, phrase, f, h of those with at least ``least`` (depth 1: and a row of all words)."""

    def count(lang: str, number: dict[bytes, int], grams: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        keys, weights = np.concatenate(grams), np.concatenate(counts)
        grams.clear()
        counts.clear()
        at, sizes = partitions(keys, weights, least)
        rows, names, seed = keys[at], list(number), _seed(lang)
        hashes = np.zeros(len(names), np.uint64)
        for w in np.unique(rows).tolist():
            hashes[w] = xxhash.xxh64_intdigest(names[w], seed)
        phrases = [b" ".join([names[w] for w in r]).decode() for r in rows.tolist()]
        h = gram_hash([hashes[rows[:, j]] for j in range(depth)]).view(np.int64).tolist()
        total = [(lang, None, int(weights.sum()), None)] if depth == 1 else []
        out = [*zip([lang] * len(at), phrases, sizes.tolist(), h, strict=True), *total]
        return pa.RecordBatch.from_pylist([dict(zip(_COUNTED.names, r, strict=True)) for r in out], schema=_COUNTED)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, grams, counts = None, {}, [], []
        for batch in batches:
            buckets, langs = batch.column("bucket").to_pylist(), batch.column("lang").to_pylist()
            for i, place in enumerate(zip(buckets, langs, strict=True)):
                if place != now:
                    if grams:
                        yield count(now[1], number, grams, counts)
                    now, number, grams, counts = place, {}, [], []
                words = batch.column("words")[i].as_py().split(b" ")
                ids = np.array([number.setdefault(w, len(number)) for w in words], np.int32)
                grams.append(ids[np.frombuffer(batch.column("grams")[i].as_py(), np.int32)].reshape(-1, depth))
                counts.append(np.frombuffer(batch.column("counts")[i].as_py(), np.int64))
        if grams:
            yield count(now[1], number, grams, counts)

    return work


_READ: dict[str, list[Bits]] = {}


def _grams(docs: DataFrame, depth: int, least: int, buckets: int, power: int, filters: list[bytes]) -> DataFrame:
    """lang, phrase, f, h of the d-grams of one depth with at least ``least`` occurrences."""
    shared, name = docs.sparkSession.sparkContext.broadcast(filters), uuid.uuid4().hex

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _READ:  # once per worker process
            _READ.clear()
            _READ[name] = [Bits(x, power) for x in shared.value]
        bits = _READ[name]
        lexicons: dict[str, Lexicon] = {}
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                rows, weight = [], 0
                for row in _slice_rows(lang, lexicons[lang], parts, depth, bits, buckets):
                    rows.append(row)
                    weight += sum(map(len, row[2:]))
                    if weight > 4 << 20:
                        yield _record(rows)
                        rows, weight = [], 0
                if rows:
                    yield _record(rows)
            held.clear()
            if sum(map(len, lexicons.values())) > LEXICON:
                lexicons.clear()

        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                if not text.is_valid:
                    continue
                if lang not in lexicons:
                    lexicons[lang] = Lexicon(lang)
                words = [0, *map(lexicons[lang].__getitem__, tokens(text.as_py().encode()))]
                held.setdefault(lang, []).append(np.array(words, np.int32))
                size += len(words)
                if size >= SLICE:
                    yield from flush()
                    size = 0
        yield from flush()

    routed = docs.mapInArrow(route, "bucket int, lang string, words binary, grams binary, counts binary")
    # a bucket is a partition, whose rows come sorted by language
    placed = routed.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "lang")
    return placed.mapInArrow(_counted(depth, least), "lang string, phrase string, f long, h long")


def _bitmap(grams: DataFrame, power: int) -> bytes:
    """The hashes of a table as a bitmap of 2^power bits, 4 KB of it per row of the aggregate."""
    at = F.shiftrightunsigned("h", 64 - power)
    size = min(1 << power, 1 << 15)
    parts = (
        grams.filter("h IS NOT NULL")
        .groupBy(F.floor(at / size).alias("part"))
        .agg(F.bitmap_construct_agg(at % size).alias("bits"))
        .toArrow()
    )
    out = np.zeros((max(1, (1 << power) // size), 4096), np.uint8)
    for part, bits in zip(parts.column("part").to_pylist(), parts.column("bits").to_pylist(), strict=True):
        out[part] = np.frombuffer(bits, np.uint8)
    return out.tobytes()


def counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> list[DataFrame]:
    """Tables lang, phrase, f per depth 1..longest of all phrases with at least ``least`` occurrences.

    The first one also has a row per language and bucket with a null phrase: its words in all.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, size // BUCKET_BYTES)
    power = min(MOST_BITS, max(LEAST_BITS, (size // 8).bit_length()))
    tables, filters = [], []
    for depth in range(1, longest + 1):
        tables.append(staged(_grams(docs, depth, least, buckets, power, filters), f"collocations-{depth}"))
        if depth < longest:
            filters.append(_bitmap(tables[-1], power))
    return tables


def _cut(first: str, last: str):
    return F.array_join(F.expr(f"slice(w, {first}, {last})"), " ")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """documents -> lang, rank, phrase, a, l, r, n, score: the best phrases of two to ``longest`` words of each language.

    A phrase whose words lie inside a longer candidate with at least ``covered`` per cent of its count is left out.
    """
    tables = counts(docs, least, longest)
    total = tables[0].filter("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    grams = tables[0].filter("phrase IS NOT NULL").select("lang", "phrase", "f")
    candidates = None
    for t in tables[1:]:
        part = t.select("lang", "phrase", F.col("f").alias("a"))
        candidates = part if candidates is None else candidates.unionByName(part)
        grams = grams.unionByName(t.select("lang", "phrase", "f"))
    words = candidates.withColumn("w", F.split("phrase", " "))
    cuts = words.withColumn("k", F.explode(F.expr("sequence(1, size(w) - 1)"))).select(
        "lang", "phrase", "a", "k", _cut("1", "k").alias("head"), _cut("k + 1", "size(w)").alias("tail"))
    part = lambda name, count: grams.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    exact = [F.col(c).cast("decimal(14,0)").alias(c) for c in ("a", "l", "r")]
    scored = (
        cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
        .select("lang", "phrase", "k", *exact)
        .withColumn("score", F.expr("(CAST(1000000 AS DECIMAL(7,0)) * a * a) div (l * r)"))
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("s"))
        .select("lang", "phrase", "s.score", *[F.col(f"s.{c}").cast("long").alias(c) for c in ("a", "l", "r")])
    )
    if longest > 2:
        inside = words.filter("size(w) > 2").select(
            "lang", "a", F.explode(F.expr(
                "flatten(transform(sequence(2, size(w) - 1), m -> "
                "transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))")).alias("phrase"))
        longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
        scored = scored.join(longer, ["lang", "phrase"], "left").filter(
            F.col("most").isNull() | (100 * F.col("most") < covered * F.col("a")))
    # the best of each of PARTS parts of a language first: what its last window sorts does not grow with the text
    best = (F.desc("score"), F.desc("a"), "phrase")
    part_of = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best)
    scored = scored.withColumn("rank", F.row_number().over(part_of)).filter(F.col("rank") <= top)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(
        F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
