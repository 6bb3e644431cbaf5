"""Cross-entropy difference of two matched bigram models (operator 4).

The target model counts the documents labelled good and not toxic, the
background model all documents.  Both share one vocabulary (the different words
of all documents; each has the same prior share) and one mass: the background's counts are scaled to
the target's number of tokens.  A document's score is the mean per-token loss
under the target model less that under the background model; lower is closer
to the target.  A document is left out of the counts that score it, or it
would be its own best evidence.

Every different word and bigram of the corpus has a count of its own,
told apart by 64-bit hashes.  The counts are nowhere held as a whole: documents
are packed, and each pack sends each of its different hashes once, with its own
counts, to the hash's range; the range adds up and sends the corpus's counts
back in the same order.  A hot word or bigram is thus one entry per pack, and
the number of ranges grows with the text.

Defined results: a null, empty or wordless text has 0 tokens and 0.0 in all
figures; every input row of documents gives one row; an id labelled more than
once is a target only if all its labels agree; without any target tokens both
models are uniform and all scores 0.0; a text of any length is scored whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, staged

#: Pseudo-counts of the two smoothing steps: the unigram's share in a bigram, the uniform prior's share in the unigram.
PRIOR_PAIR, PRIOR_WORD = 50.0, 1000.0
#: Bytes of text of a pack; least bits of the hash ranges, and bytes of text for each range beyond them.
PACK_BYTES, RANGE_BITS, RANGE_BYTES = 1 << 23, 10, 1 << 23
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def bins(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens per text, word, context, bigram hash) of all tokens of the texts; a text starts in context 0."""
    words = [t.lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    digests = b"".join(xxhash.xxh64_digest(w) for ws in words for w in ws)
    word = np.frombuffer(digests, ">u8").astype(np.uint64)
    context = np.empty_like(word)
    context[1:] = word[:-1]
    starts = np.cumsum(sizes) - sizes
    context[starts[sizes > 0]] = 0
    with np.errstate(over="ignore"):
        return sizes, word, context, ((context * _ODD[0]) ^ word) * _ODD[1]


def keyed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens per text; sorted different hashes of words and bigrams and 0, the start; places among
    them of each token's word, context and bigram; places of each text's start and last token, of those with any."""
    parts = [bins(texts[a:b]) for a, b in slices(texts)]
    sizes, word, _, pair = (np.concatenate(x) for x in zip(*parts, strict=True))
    keys, at = np.unique(np.concatenate([np.zeros(1, np.uint64), word, pair]), return_inverse=True)
    word, pair = at[1 : 1 + len(word)], at[1 + len(word) :]
    ends = np.cumsum(sizes)[sizes > 0]
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[ends - sizes[sizes > 0]] = 0  # hash 0 is the lowest
    return sizes, keys, np.stack([word, context, pair]), np.stack([np.zeros(len(ends), int), word[ends - 1]])


def planes(x: np.ndarray) -> bytes:
    """Unsigned numbers as byte planes, lowest first, without the empty ones on top."""
    top = max(1, (int(x.max()).bit_length() + 7) // 8)
    return np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :top].T.tobytes()


def numbers(held: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``planes``."""
    some = np.frombuffer(held, np.uint8).reshape(-1, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, : len(some)] = some.T
    return out.view("<u8").ravel()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # one row per run of whole documents: ids and tokens of each, the texts compressed, and their size
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        for a, b in slices(texts, PACK_BYTES):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                out.write_batch(batch.slice(a, b - a))
            whole = pa.array([0, b - a], pa.int32())
            sizes = pa.array([len(t.split()) for t in texts[a:b]], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(whole, batch.column("doc_id").slice(a, b - a)), pa.ListArray.from_arrays(whole, sizes),
                 pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([sum(map(len, texts[a:b]))])],
                names=["ids", "sizes", "pack", "bytes"],
            )


def _open(pack: bytes, places: list[int]) -> tuple[pa.Array, list[bytes], np.ndarray]:
    # ids, texts, and which stand at the places of targets
    table = pa.ipc.open_stream(pack).read_all().combine_chunks()
    chosen = np.zeros(len(table), bool)
    chosen[places] = True
    return table["doc_id"].combine_chunks(), [t or b"" for t in table["text"].to_pylist()], chosen


def own_counts(owner: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """For each token: how often its word, context or bigram (by its place) stands in its own text."""
    _, at, n = np.unique(owner << 32 | kind, return_inverse=True, return_counts=True)
    return n[at]


class Model:
    """Smoothed bigram model over the counts of one pack's hashes."""

    def __init__(self, counts: np.ndarray, total: float, mass: float, words: int):
        """``counts`` of each hash in the corpus and at ends of texts, scaled so that ``total`` tokens become ``mass``.

        ``words``: size of the vocabulary; the unigram's shares of its words sum to one.
        """
        self.prior = PRIOR_WORD / max(words, 1)
        # a word is the context of the next token wherever it does not end its text
        self.counts, self.mass, self.scale = (counts[0], counts[0] - counts[1], counts[0]), mass, mass / total if total else 0.0

    def losses(self, at: np.ndarray, own: list[np.ndarray], size: np.ndarray) -> np.ndarray:
        """Loss of each token; ``own``: what its own text (of ``size`` tokens) added to its three counts."""
        word, context, pair = (
            np.maximum(self.scale * (held[k] - mine), 0.0) for held, k, mine in zip(self.counts, at, own, strict=True)
        )
        unigram = (word + self.prior) / (np.maximum(self.mass - self.scale * size, 0.0) + PRIOR_WORD)
        return -np.log((np.minimum(pair, context) + PRIOR_PAIR * unigram) / (context + PRIOR_PAIR))


def packed(docs: DataFrame) -> DataFrame:
    """id, ids, sizes, pack, bytes of runs of documents; written once, as counting and scoring both read it."""
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    packs = texts.mapInArrow(_pack, f"ids array<{kind}>, sizes array<bigint>, pack binary, bytes long")
    return staged(packs.withColumn("id", F.monotonically_increasing_id()), "scoring")  # the write fixes the ids


def targets(packs: DataFrame, labels: DataFrame) -> DataFrame:
    """id, places, tokens: of each pack's documents with all labels of the id good and not toxic, if there are any."""
    chosen = (
        labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .filter("quality = 1 and toxic = 0").select(F.col("doc_id").alias("label_id"))
    )
    each = packs.select("id", F.posexplode(F.arrays_zip("ids", "sizes")).alias("place", "doc"))
    # a sort-merge join at every size; only ids meet, not texts
    met = each.join(chosen.hint("merge"), F.col("doc.ids") == F.col("label_id"))
    return staged(met.groupBy("id").agg(F.collect_list("place").alias("places"), F.sum("doc.sizes").alias("tokens")), "scoring-targets")


def _places(table: pa.Table) -> list[int]:
    return [p for places in table["places"].to_pylist() for p in places or ()]


def totals(packs: DataFrame, chosen: DataFrame, bits: int) -> DataFrame:
    """id, range, n, counts of each pack's different hashes, in 2^``bits`` ranges of the hashes.

    Counts are the corpus's: in all documents, in targets, and then how often each ends a document, likewise.
    """

    def ask(pack: pa.Table, known: pa.Table) -> pa.Table:
        _, texts, inside = _open(pack["pack"][0].as_py(), _places(known))
        sizes, keys, at, edges = keyed(texts)
        tokens, ends = np.repeat(inside, sizes), inside[sizes > 0]
        count = lambda *x: np.bincount(np.concatenate(x), minlength=len(keys))
        counts = np.stack([count(at[0], at[2], edges[0]), count(at[0][tokens], at[2][tokens], edges[0][ends]),
                           count(edges[1]), count(edges[1][ends])])
        part = (keys >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        return pa.table({
            "id": pa.array(pack["id"].to_pylist() * len(spans), pa.int64()), "range": part[cuts[:-1]],
            "n": np.diff(cuts).astype(np.int32),
            "keys": pa.array([planes(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in spans], pa.binary()),
            "counts": pa.array([zlib.compress(planes(counts[:, a:b].ravel()), 1) for a, b in spans], pa.binary()),
        })

    def add(asked: pa.Table) -> pa.Table:
        sizes = asked["n"].to_pylist()
        keys = np.concatenate([np.cumsum(numbers(k, n)) for k, n in zip(asked["keys"].to_pylist(), sizes, strict=True)])
        _, at = np.unique(keys, return_inverse=True)
        sums = np.stack([np.bincount(at, c) for c in _counts(asked)])[:, at].astype(np.uint64)  # exact to 2^53
        ends = np.cumsum(sizes).tolist()
        back = [zlib.compress(planes(sums[:, b - n : b].ravel()), 1) for b, n in zip(ends, sizes, strict=True)]
        return pa.table({"id": asked["id"], "range": asked["range"], "n": asked["n"], "counts": pa.array(back, pa.binary())})

    asked = packs.select("id", "pack").groupBy("id").cogroup(chosen.select("id", "places").groupBy("id")).applyInArrow(
        ask, "id long, range long, n int, keys binary, counts binary"
    )
    return asked.groupBy("range").applyInArrow(add, "id long, range long, n int, counts binary")


def _counts(table: pa.Table) -> np.ndarray:
    held = zip(table["counts"].to_pylist(), table["n"].to_pylist(), strict=True)
    return np.concatenate([numbers(zlib.decompress(c), 4 * n).reshape(4, n) for c, n in held], 1)


def vocabulary(packs: DataFrame) -> int:
    """Number of different words of all documents; a pack sends each of its words once."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.column("pack"):
                _, texts, _ = _open(pack.as_py(), [])
                parts = [np.unique(bins(texts[a:b])[1]) for a, b in slices(texts)]
                held = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64))], names=["h"])

    return packs.select("pack").mapInArrow(words, "h long").distinct().count()


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """documents, labels -> doc_id, n_tokens, target_loss, background_loss, score (their difference)."""
    packs = packed(docs)
    chosen = targets(packs, labels)
    total = F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))
    size, background = packs.agg(F.coalesce(F.sum("bytes"), F.lit(0)), total).first()
    target = chosen.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    bits = max(RANGE_BITS, (size // RANGE_BYTES).bit_length())
    words = vocabulary(packs)

    def run(pack: pa.Table, known: pa.Table) -> pa.Table:
        ids, texts, inside = _open(pack["pack"][0].as_py(), _places(known))
        sizes, _, at, _ = keyed(texts)
        counts = _counts(known.filter(pc.greater_equal(known["range"], 0)).sort_by("range")).astype(float)
        owner = np.repeat(np.arange(len(texts)), sizes)
        own, tokens, inside = [own_counts(owner, kind) for kind in at], sizes[owner], inside[owner]
        losses = (Model(counts[1::2], target, target, words).losses(at, [n * inside for n in own], tokens * inside),
                  Model(counts[0::2], background, target, words).losses(at, own, tokens))
        t, g = (np.bincount(owner, x, len(texts)) / np.maximum(sizes, 1) for x in losses)
        return pa.table({"doc_id": ids, "n_tokens": sizes, "target_loss": t, "background_loss": g, "score": t - g})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, target_loss double, background_loss double, score double"
    none = "cast(null as {}) {}".format
    known = totals(packs, chosen, bits).selectExpr("*", none("array<int>", "places"))
    known = known.unionByName(chosen.selectExpr("id", "-1L range", "0 n", none("binary", "counts"), "places"))
    return packs.select("id", "pack").groupBy("id").cogroup(known.groupBy("id")).applyInArrow(run, schema)
