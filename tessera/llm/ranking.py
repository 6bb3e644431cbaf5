"""Ranked lexical search with term-pair bounds (operator 12).

The best documents of every item of a query set, exactly, over all documents.

1. One pass over the texts writes a posting table: per document its number of
   terms and the query terms that it holds, with their counts.  Sums over that
   table give the corpus statistics (documents, terms, documents per term).
2. Each task streams its part of the table in blocks.  A block becomes an index:
   for every query term its posting list with integer impacts and the list's
   maximum, and for every pair of neighbouring terms of an item (by weight) the
   intersection of the two lists with its largest joint impact.  The most a
   document can gain from a pair is the largest of the two maxima and the joint
   maximum, since documents outside the intersection hold one term at most.
3. An item's terms are walked from the lightest.  The bound on a prefix of them
   is the least sum over single maxima and pair bounds that covers it, so it is
   never looser than the sum of the maxima.  Lists of the longest prefix whose
   bound stays below the item's threshold (its k-th best score so far) cannot
   lift a document by themselves: only documents of the other lists are
   candidates, and a prefix list is read at the candidates only, which are
   dropped as soon as their score and the bound of what is left fall short.
4. Each task ends with at most k rows per item; the best k of those are ranked.

Documents are partitioned as they are stored; nothing but those rows (and one
row per task and term for the statistics) is shuffled, so no term, however
common, meets in one task.  Items go in blocks of at most ``BLOCK_BYTES`` of
text, which bounds what is broadcast; each further block is one more pass.

Defined results: null, empty or blank texts hold no term and are not counted;
items without terms, or whose terms no document holds, have no rows; repeated
rows of documents each take a rank; equal scores go by ascending doc_id, null
last; rows of items equal in both columns count once; an empty table gives an
empty result; texts are read whole; other columns, whatever their names, are
not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import slices, staged

#: Rows kept per item, bytes of item text per broadcast block, bytes of postings per index block.
TOP, BLOCK_BYTES, INDEX_BYTES = 50, 4 << 20, 4 << 20
#: Fixed values of the term rule: ASCII letters and digits and all bytes of other characters, only A-Z lower-cased.
_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a whole UTF-8 text, in order."""
    return text.translate(_TERMS).split() if text else []


class Items:
    """A block of the query set: distinct terms, and per item its terms."""

    def __init__(self, rows: list[tuple]):
        self.ids = [i for i, _ in rows]
        held = [sorted(set(terms(t.encode() if t else None))) for _, t in rows]
        self.vocabulary = {t: n for n, t in enumerate(sorted({t for h in held for t in h}))}
        self.terms = [np.array([self.vocabulary[t] for t in h], np.int64) for h in held]


def postings(docs: DataFrame, items: Items) -> DataFrame:
    """documents -> doc_id, n (terms, with repeats), terms and counts (packed 32-bit integers) of the query terms."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        number, wanted = known.__getitem__, known.__contains__
        for batch in batches:
            sizes, packed, counts = [], [], []
            for value in batch.column("text"):
                found = terms(value.as_py().encode() if value.is_valid else None)
                sizes.append(len(found))
                of = Counter(filter(wanted, found))
                packed.append(np.fromiter(map(number, of), np.int32, len(of)).tobytes())
                counts.append(np.fromiter(of.values(), np.int32, len(of)).tobytes())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": pa.array(sizes, pa.int64()),
                "terms": pa.array(packed, pa.binary()), "counts": pa.array(counts, pa.binary()),
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n long, terms binary, counts binary")


def _document_counts(table: DataFrame, size: int) -> np.ndarray:
    """Documents per query term: one row per task and term, added up."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32)
            df += np.bincount(held, minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int64()), "df": pa.array(df[at], pa.int64())})

    summed = table.select("terms").mapInArrow(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    got = summed.toArrow()  # at most one row per term of a block
    out = np.zeros(size, np.int64)
    out[got.column("term").to_numpy()] = got.column("df").to_numpy()
    return out


class Index:
    """Posting lists with impacts over one block of documents, list maxima and pair bounds."""

    def __init__(self, doc_of: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        order = np.argsort(term, kind="stable")
        self.n_docs, self.docs, self.impacts = n_docs, doc_of[order], impact[order]
        self.edges = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.most = np.zeros(n_terms, np.int64)
        held = np.flatnonzero(np.diff(self.edges))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.impacts, self.edges[held])
        self.pairs: dict[tuple[int, int], int] = {}

    def list(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.edges[t], self.edges[t + 1]
        return self.docs[a:b], self.impacts[a:b]

    def add_pair(self, t: int, u: int) -> None:
        """Bound of what a document gains from a pair: its intersection list gives the joint maximum."""
        (d, x), (e, y) = self.list(t), self.list(u)
        _, i, j = np.intersect1d(d, e, assume_unique=True, return_indices=True)
        joint = int((x[i] + y[j]).max()) if len(i) else 0
        self.pairs[t, u] = max(int(self.most[t]), int(self.most[u]), joint)

    def bounds(self, walk: list[int]) -> list[int]:
        """Least cover of each prefix of an item's terms by single maxima and pair bounds."""
        out = [0]
        for i, t in enumerate(walk):
            alone = out[-1] + int(self.most[t])
            pair = self.pairs.get((walk[i - 1], t)) if i else None
            out.append(alone if pair is None else min(alone, out[-2] + pair))
        return out

    def search(self, walk: list[int], threshold: int, read: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all documents of the block that reach the threshold, and perhaps others below it.

        ``walk`` holds the item's terms from the lightest; ``read`` collects the number of postings looked at.
        """
        bounds = self.bounds(walk)
        first = max(i for i, b in enumerate(bounds) if b < threshold)
        score = np.zeros(self.n_docs, np.int64)
        for t in walk[first:]:
            d, x = self.list(t)
            score[d] += x
            if read is not None:
                read.append(len(d))
        docs = np.flatnonzero(score)
        found = score[docs]
        for i in range(first - 1, -1, -1):
            stay = found + bounds[i + 1] >= threshold
            docs, found = docs[stay], found[stay]
            if not len(docs):
                break
            d, x = self.list(walk[i])
            if len(d):
                at = np.minimum(np.searchsorted(d, docs), len(d) - 1)
                found = found + np.where(d[at] == docs, x[at], 0)
                if read is not None:
                    read.append(min(len(docs), len(d)))
        stay = found >= threshold
        return docs[stay], found[stay]


def _walks(items: Items, weight: np.ndarray) -> list[list[int]]:
    """Each item's terms from the lightest."""
    return [t[np.lexsort((t, weight[t]))].tolist() for t in items.terms]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of posting rows of bounded size: doc ids, n, rows' lengths, terms, counts."""
    for batch in batches:
        held, counts = batch.column("terms").to_pylist(), batch.column("counts").to_pylist()
        for a, b in slices(held, INDEX_BYTES):
            yield (batch.column("doc_id").slice(a, b - a), batch.column("n").slice(a, b - a).to_numpy(),
                   np.array([len(x) // 4 for x in held[a:b]]), np.frombuffer(b"".join(held[a:b]), np.int32),
                   np.frombuffer(b"".join(counts[a:b]), np.int32))


def impacts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Contribution of a term to a document's score, in 64-bit integers."""
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def _best(table: DataFrame, items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """At most k rows per task and item: item (position), doc_id, score."""
    walks = _walks(items, weight)
    shared = table.sparkSession.sparkContext.broadcast((walks, weight))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks, weight = shared.value
        pairs = sorted({p for w in walks for p in zip(w, w[1:])})
        kept: list[list[tuple]] = [[] for _ in walks]  # (-score, doc_id is null, doc_id), best first
        for ids, n, lengths, term, tf in _blocks(batches):
            doc_of = np.repeat(np.arange(len(n)), lengths)
            m = 50 + 50 * n * n_docs // n_terms
            index = Index(doc_of, term, impacts(weight[term], tf.astype(np.int64), m[doc_of]), len(n), len(weight))
            for t, u in pairs:
                index.add_pair(t, u)
            ids = ids.to_pylist()
            for rows, walk in zip(kept, walks, strict=True):
                docs, score = index.search(walk, -rows[-1][0] if len(rows) >= k else 1)
                if len(docs) > k:  # what is below the block's own k-th best cannot stay
                    best = score >= np.partition(score, -k)[-k]
                    docs, score = docs[best], score[best]
                if len(docs):
                    new = [(-s, ids[d] is None, ids[d]) for d, s in zip(docs.tolist(), score.tolist(), strict=True)]
                    rows[:] = sorted(rows + new, key=lambda r: r if not r[1] else (r[0], True))[:k]
        flat = [(i, r[2], -r[0]) for i, rows in enumerate(kept) for r in rows]
        for a in range(0, len(flat), 10_000):
            item, doc, score = zip(*flat[a : a + 10_000], strict=True)
            yield pa.RecordBatch.from_pydict({"item": pa.array(item, pa.int32()), "doc_id": pa.array(doc, arrow_kind),
                                              "score": pa.array(score, pa.int64())})

    field = table.schema["doc_id"]
    arrow_kind = table.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    return table.mapInArrow(work, f"item int, doc_id {field.dataType.simpleString()}, score long")


def _block(docs: DataFrame, items: Items, ids: DataFrame, k: int) -> DataFrame | None:
    table = staged(postings(docs, items), "ranking-postings")
    n_docs, n_terms = table.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    df = _document_counts(table, len(items.vocabulary))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    best = _best(table, items, weight, n_docs, n_terms, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """documents, benchmark -> item_id, rank, doc_id, score: the k best documents of each item."""
    spark = docs.sparkSession
    queries = benchmark.select("item_id", "text").distinct()
    # items are numbered into blocks of bounded text; one block at a time reaches the driver
    size = queries.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    n_blocks = max(1, math.ceil(size / block_bytes))
    outs = []
    for b in range(n_blocks):
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b
        rows = [tuple(r) for r in queries.filter(part).orderBy("item_id", "text").collect()]
        items = Items(rows)
        if items.vocabulary:
            kind = benchmark.schema["item_id"].dataType.simpleString()
            ids = spark.createDataFrame([(i, x) for i, x in enumerate(items.ids)], f"item int, item_id {kind}")
            if (out := _block(docs, items, ids, k)) is not None:
                outs.append(out)
    if not outs:
        kinds = [t.schema[c].dataType.simpleString() for t, c in ((benchmark, "item_id"), (docs, "doc_id"))]
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    result = outs[0]
    for out in outs[1:]:
        result = result.unionByName(out)
    return result
