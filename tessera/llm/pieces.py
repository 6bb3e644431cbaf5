"""SentencePiece encoding and decoding by backtracking over Aho-Corasick matches (operator 13).

A merge-type vocabulary turns a run of characters into tokens by repeatedly
merging the adjacent pair whose joint piece scores highest (leftmost of equals).
The result is the one sequence in which every two neighbours are *compatible*:
merging their joint characters afresh ends in the same two tokens.  So a run is
encoded without merging it as a whole:

* an Aho-Corasick automaton over the pieces gives the longest piece at each
  position;
* from the left, the longest piece that is compatible with the token before it
  is taken, else the next shorter piece that starts there;
* when none fits, the position is marked in a bitfield as failed (the tokens up
  to a position are unique, so it can never be part of the result), the last
  token is taken back and its next shorter piece is tried.

Compatibility is decided by re-merging the two tokens' characters, and kept in a
bounded table.  A character that is no piece stands alone and becomes one byte
token per UTF-8 byte.  No piece of the vocabulary spans the start of a run of
spaces or a line feed (``Vocabulary`` checks that), so a text is encoded run by
run, and a worker keeps the ids of the runs that it has seen in a bounded cache;
the caches affect speed only.  Documents are never shuffled.

Defined results: a null or empty text has the end id only and decodes to an
empty text; ids may be null or repeated (one result row per input row); texts of
any length are encoded whole; an empty table gives an empty result; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices

MODEL = "piece_bpe_32k.model"
#: A worker's tables: runs with their ids, places (a power of 2) for pairs with their verdict; longer runs are encoded one by one and not kept.
RUNS, PAIR_BITS, LONGEST = 500_000, 20, 96
#: Fixed values of the format: the sign that stands for a space, what an unknown token decodes to.
SPACE, UNKNOWN = "▁", " ⁇ "
_RUN = re.compile(r" +[^ \n]*|[^ \n]+|\n")


def runs(text: str) -> list[str]:
    """Independent runs of a whole text, with the leading space that the vocabulary's normalizer adds."""
    return _RUN.findall(" " + text.replace(SPACE, " ")) if text else []


class Vocabulary:
    """Pieces of one merge-type model: encoding of runs, decoding of ids."""

    def __init__(self, model: str):
        import ahocorasick
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        names = [sp.id_to_piece(i) for i in range(size)]
        if any(sp.is_unused(i) for i in range(size)) or any(
            SPACE in p.lstrip(SPACE) or "\n" in p for p, s in zip(names, special, strict=True) if not s
        ):
            raise ValueError("the vocabulary has unused pieces or pieces that span two runs")
        self.size, self.end = size, sp.eos_id()
        self._text = [p.replace(SPACE, " ") for p in names]
        self._id = {p: i for i, (p, s) in enumerate(zip(self._text, special, strict=True)) if not s}
        self._score = {p: sp.get_score(i) for p, i in self._id.items()}
        self._byte = {int(names[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self._byte_of = {i: b for b, i in self._byte.items()}
        self._empty = {i for i in range(size) if sp.is_control(i)}
        shown = ["" if sp.is_control(i) else UNKNOWN if sp.is_unknown(i) else p for i, p in enumerate(self._text)]
        self._shown = np.array(shown, dtype=object)
        self._is_byte = np.array([sp.is_byte(i) for i in range(size)])
        self._plain = np.array([not x for x in special])
        self._automaton = ahocorasick.Automaton()
        for p, i in self._id.items():
            if len(p) > 1:  # single characters are looked up by their code
                self._automaton.add_word(p, i)
        single = sorted((ord(p), i) for p, i in self._id.items() if len(p) == 1)
        self._codes, self._code_ids = np.array(single, np.int64).reshape(-1, 2).T
        self._automaton.make_automaton()
        # one entry past the last id stands for lone characters: length 1, nothing shorter
        self._length, self._shorter = np.ones(size + 1, np.int64), np.full(size + 1, -1, np.int64)
        for p, i in self._id.items():
            self._length[i] = len(p)
            self._shorter[i] = next((self._id[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self._id), -1)
        self._pair_keys, self._pair_fits = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)

    # -- encoding -------------------------------------------------------------

    def _string(self, token: int) -> str:
        """Characters of a token; tokens from ``size`` on are single characters that are no piece."""
        return self._text[token] if token < self.size else chr(token - self.size)

    def remerge(self, text: str) -> list[str]:
        """The merges themselves, plainly: best joint piece first, the leftmost of equals."""
        parts, score = list(text), self._score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """True if merging the two tokens' characters afresh gives these two tokens (``left`` -1: ``right`` alone)."""
        b = self._string(right)
        a = self._string(left) if left >= 0 else ""
        return self.remerge(a + b) == ([a, b] if a else [b])

    def _verdicts(self, keys: np.ndarray) -> np.ndarray:
        """``compatible`` of packed pairs, through a table with one place per hash."""
        at = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        miss = np.flatnonzero(self._pair_keys[at] != keys)
        if len(miss):
            new, places, back = np.unique(keys[miss], return_index=True, return_inverse=True)
            known = np.array([self.compatible((k >> 21) - 1, k & 0x1FFFFF) for k in new.tolist()])
            fits = self._pair_fits[at]
            fits[miss] = known[back]
            self._pair_keys[at[miss][places]] = new
            self._pair_fits[at[miss][places]] = known
            return fits
        return self._pair_fits[at]

    def longest(self, text: str) -> np.ndarray:
        """The longest piece that starts at each position, by the automaton; the lone character where there is none."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        place = np.minimum(np.searchsorted(self._codes, codes), len(self._codes) - 1)
        found = np.where(self._codes[place] == codes, self._code_ids[place], codes + np.int64(self.size))
        hits = np.fromiter(chain.from_iterable(self._automaton.iter(text)), np.int64).reshape(-1, 2)
        # matches come by their ends, so the last one written at a start is its longest
        found[hits[:, 0] - self._length[hits[:, 1]] + 1] = hits[:, 1]
        return found

    def encode_long(self, text: str) -> np.ndarray:
        """Ids of one run, step by step."""
        longest, length, shorter, size = self.longest(text).tolist(), self._length, self._shorter, self.size
        failed, out, at, before, token, verdicts = bytearray(len(text) // 8 + 1), [], 0, -1, longest[0], {}
        while at < len(text):
            if token < 0:
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                at -= int(length[min(last, size)])
                before, token = out[-1] if out else -1, int(shorter[min(last, size)])
                continue
            stop = at + int(length[min(token, size)])
            fits = not failed[stop >> 3] >> (stop & 7) & 1
            if fits:
                fits = verdicts.get((before, token))
                if fits is None:
                    if len(verdicts) >= 1 << PAIR_BITS:
                        verdicts.clear()
                    fits = verdicts[before, token] = self.compatible(before, token)
            if fits:
                out.append(token)
                at, before = stop, token
                token = longest[at] if at < len(text) else -1
            else:
                token = int(shorter[min(token, size)])
        return np.array([y for t in out for y in ([t] if t < size else self._bytes(t))], np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of distinct, non-empty runs."""
        short = [t for t in texts if len(t) <= LONGEST]
        done = iter(self.encode_many(short))
        return [next(done) if len(t) <= LONGEST else self.encode_long(t) for t in texts]

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """``encode_long`` of many short runs: all runs of a batch take their next step at once.

        Per run: the place reached, the tokens so far, the candidate, and the bitfield of failed places
        (64 places to a word).
        """
        if not texts:
            return []
        size = self.size
        longest = self.longest("\n".join(texts) + "\n")  # no piece holds a line feed, so no match spans two runs
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.cumsum(lengths + 1) - lengths - 1
        words = lengths // 64 + 1  # bits 0..length
        first_word = np.cumsum(words) - words
        failed = np.zeros(int(words.sum()), np.uint64)
        taken = np.empty(len(longest), np.int32)  # the tokens of run r at starts[r], starts[r] + 1, ...
        count = np.zeros(len(texts), np.int64)
        at = np.zeros(len(texts), np.int64)
        before = np.full(len(texts), -1, np.int64)
        token = longest[starts].astype(np.int64)
        live = np.arange(len(texts))
        while len(live):
            t, p = token[live], at[live]
            none = t < 0
            if none.any():  # no piece fits here: mark the place, take the last token back, try its next shorter piece
                r = live[none]
                failed[first_word[r] + (p[none] >> 6)] |= np.uint64(1) << (p[none] & 63).astype(np.uint64)
                count[r] -= 1  # the empty prefix always has an encoding, so this never falls below 0
                last = taken[starts[r] + count[r]]
                at[r] -= self._length[np.minimum(last, size)]
                token[r] = self._shorter[np.minimum(last, size)]
                before[r] = np.where(count[r] > 0, taken[np.maximum(starts[r] + count[r] - 1, 0)], -1)
                live_now = live[~none]
                t, p = t[~none], p[~none]
            else:
                live_now = live
            stop = p + self._length[np.minimum(t, size)]
            bad = failed[first_word[live_now] + (stop >> 6)] >> (stop & 63).astype(np.uint64) & np.uint64(1)
            fits = (bad == 0) & self._verdicts(before[live_now] + 1 << 21 | t)
            r = live_now[~fits]
            token[r] = self._shorter[np.minimum(t[~fits], size)]
            r, t, stop = live_now[fits], t[fits], stop[fits]
            taken[starts[r] + count[r]] = t
            count[r] += 1
            at[r], before[r] = stop, t
            more = stop < lengths[r]
            token[r[more]] = longest[starts[r[more]] + stop[more]]
            if not more.all():
                live = live[at[live] < lengths[live]]
        out = [taken[a : a + n] for a, n in zip(starts.tolist(), count.tolist(), strict=True)]
        inside = np.arange(len(taken)) - np.repeat(starts, lengths + 1)
        lone = (taken >= size) & (inside < np.repeat(count, lengths + 1))
        for i in np.unique(np.searchsorted(starts, np.flatnonzero(lone), "right") - 1).tolist():
            out[i] = np.array([y for t in out[i].tolist() for y in ([t] if t < size else self._bytes(t))], np.int32)
        return out

    def _bytes(self, token: int) -> list[int]:
        return [self._byte[b] for b in self._string(token).encode()]

    # -- decoding -------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """Text of a sequence of ids: control ids vanish, byte runs become characters, the added space goes."""
        if not len(ids):
            return ""
        parts = self._shown[ids]
        is_byte = self._is_byte[ids]
        if is_byte.any():
            edges = np.flatnonzero(np.diff(np.concatenate(([0], is_byte.view(np.int8), [0]))))
            for a, b in edges.reshape(-1, 2).tolist():
                parts[a:b] = ""
                parts[a] = _characters(bytes(self._byte_of[i] for i in ids[a:b].tolist()))
        first = 0
        while first < len(ids) - 1 and int(ids[first]) in self._empty:
            first += 1
        if self._plain[ids[first]] and parts[first].startswith(" "):
            parts[first] = parts[first][1:]
        return "".join(parts.tolist())


def _characters(data: bytes) -> str:
    """Characters of a run of bytes; each byte that begins no whole character becomes U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(data):
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[i : i + n].decode())
                except UnicodeDecodeError:
                    continue
                i += n
                break
            else:
                out.append("�")
                i += 1
        return "".join(out)


class Runs(dict):
    """Ids of runs as packed 32-bit integers, encoded once while they stay in the bounded cache."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def learn(self, seen: Iterable[str]) -> dict[str, bytes]:
        """Encode the runs that are not known; returns those too long to be kept."""
        distinct = set(seen)
        new = [r for r in distinct if r not in self]
        if len(self) + len(new) > RUNS:
            self.clear()
            new = list(distinct)
        long: dict[str, bytes] = {}
        for run, ids in zip(new, self.vocabulary.encode(new), strict=True):
            (self if len(run) <= LONGEST else long)[run] = ids.tobytes()
        return long


_OPEN: dict[str, Runs] = {}


def opened(model: str) -> Runs:
    """The vocabulary and its cache, once per worker process."""
    if model not in _OPEN:
        _OPEN.clear()
        _OPEN[model] = Runs(Vocabulary(model))
    return _OPEN[model]


def ids_of(texts: Sequence[str | None], cache: Runs, end: bool = True) -> list[np.ndarray]:
    """Ids of whole texts."""
    last = np.array([cache.vocabulary.end] if end else [], np.int32).tobytes()
    cut = [runs(t or "") for t in texts]
    long = cache.learn(chain.from_iterable(cut))
    of = {**cache, **long}.__getitem__ if long else cache.__getitem__
    return [np.frombuffer(b"".join(map(of, c)) + last, np.int32) for c in cut]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(ids) if ids else np.zeros(0, np.int32))


def encode(docs: DataFrame, model: str = MODEL, end: bool = True, decoded: bool = False) -> DataFrame:
    """documents -> doc_id, ids array<int>; with ``decoded`` also the text that these ids decode to."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = opened(model)
        for batch in batches:
            texts = batch.column("text")
            sizes = [range(n or 0) for n in pc.binary_length(texts).to_pylist()]
            for a, b in slices(sizes):
                ids = ids_of(texts.slice(a, b - a).to_pylist(), cache, end)
                out = {"doc_id": batch.column("doc_id").slice(a, b - a), "ids": _lists(ids)}
                if decoded:
                    out["decoded"] = pa.array([cache.vocabulary.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def decode(coded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids -> doc_id, text: what the ids decode to (null ids: an empty text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = opened(model).vocabulary
        for batch in batches:
            texts = [vocabulary.decode(np.array(x or [], np.int32)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.select("doc_id", "ids").mapInArrow(work, f"doc_id {kind}, text string")


def digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """documents -> doc_id, n_tokens, ids_sha256, decoded_sha256, from the ids and the decoded texts."""
    return encode(docs, model, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
