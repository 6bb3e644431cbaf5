"""Token counts by a map-side two-tier lookup (operator 10).

No vocabulary piece of the tokenizer spans a boundary before a space run or
around a line feed, so a text's token count is the sum over its pre-tokens
(a run of spaces with the word behind it, a word, a line feed).  ``Pieces``
checks that property when it opens the vocabulary.

Tier 1: every task keeps the most frequent pre-tokens of its rows (a bounded
summary), the summaries are added up and the first ``TABLE`` of all rows are
encoded once and broadcast as a packed table (keys in one blob, offsets,
lengths).  Tier 2: a miss is encoded in the worker and kept in a bounded
cache.  Pre-tokens themselves are never shuffled; the table affects speed only.

Defined results: a null or empty text has 0 bytes and 0 tokens; ids may be
null or repeated (one result row per input row); texts of any length are
encoded whole; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices

MODEL, LIMIT = "piece_bpe_32k.model", 4096
#: Entries of the broadcast table, of a task's summary, of a worker's cache; pre-tokens longer than this are not kept.
TABLE, SUMMARY, CACHE, LONGEST = 65_536, 8_192, 200_000, 64
_PRE = re.compile(r" +[^ \n]*|[^ \n]+|\n")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a whole text, with the leading space that the tokenizer adds."""
    return _PRE.findall(" " + text.replace("▁", " ")) if text else []


class Pieces:
    """Lengths in tokens of single pre-tokens."""

    def __init__(self, model: str):
        import public_tokenizers
        import sentencepiece

        self._sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        names = (self._sp.id_to_piece(i) for i in range(self._sp.get_piece_size()))
        if any("▁" in p.lstrip("▁") or "\n" in p for p in names):
            raise ValueError("a piece spans a pre-token boundary")

    def length(self, pre: str) -> int:
        if pre == "\n":
            return 1
        # a leading space is what the library adds itself; else a line feed (2 tokens with its own space) keeps it off
        return len(self._sp.encode(pre[1:])) if pre[0] == " " and pre != " " else (
            1 if pre == " " else len(self._sp.encode("\n" + pre)) - 2)


class Lengths(dict):
    """Tier 1 as the dict itself, tier 2 behind ``__missing__``."""

    def __init__(self, packed: tuple[bytes, np.ndarray, np.ndarray], model: str):
        blob, ends, lengths = packed
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        super().__init__(
            (blob[a:b].decode(), int(n)) for a, b, n in zip(starts.tolist(), ends.tolist(), lengths, strict=True)
        )
        self._pieces, self._cache = Pieces(model), {}

    def __missing__(self, pre: str) -> int:
        n = self._cache.get(pre)
        if n is None:
            n = self._pieces.length(pre)
            if len(pre) <= LONGEST:
                if len(self._cache) >= CACHE:
                    self._cache.clear()
                self._cache[pre] = n
        return n


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for a, b in slices(texts):
            for text in texts[a:b]:
                seen.update(pre_tokens(text or ""))
            if len(seen) > 16 * SUMMARY:
                seen = Counter(dict(seen.most_common(4 * SUMMARY)))
    top = [(p, n) for p, n in seen.most_common(SUMMARY) if n > 1 and len(p) <= LONGEST]
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["pre", "n"]
    )


def frequent(docs: DataFrame, model: str = MODEL, entries: int = TABLE) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Packed table of the most frequent pre-tokens of all rows: at most ``entries`` of at most ``LONGEST`` characters."""
    top = (
        docs.select("text")
        .mapInArrow(_summaries, "pre string, n long")
        .groupBy("pre")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "pre")
        .limit(entries)
        .toArrow()
    )
    pieces, keys = Pieces(model), [k.encode() for k in top.column("pre").to_pylist()]
    ends = np.cumsum([len(k) for k in keys], dtype=np.int64) if keys else np.zeros(0, np.int64)
    return b"".join(keys), ends, np.array([pieces.length(k.decode()) for k in keys], np.int32)


_OPEN: dict = {}


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """documents -> doc_id, n_bytes, n_tokens, over_limit."""
    shared, name = docs.sparkSession.sparkContext.broadcast(frequent(docs, model)), uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _OPEN.get(name)
        if lengths is None:  # once per worker process
            _OPEN.clear()
            lengths = _OPEN[name] = Lengths(shared.value, model)
        of = lengths.__getitem__
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n_bytes = [len(t.encode()) if t else 0 for t in texts]
            n_tokens = [sum(map(of, pre_tokens(t))) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
