"""Collocations, ranked search and sentence pieces against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import collocations, pieces, ranking
from tessera.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- collocations ---------------------------------------------------------------------------------------------------


def plain_collocations(rows, least=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, count in f.items():
        candidates = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in candidates.items():
            cuts = [(10**6 * a * a // (count[g[:k]] * count[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            longer = [b for h, b in candidates.items() if len(h) > len(g) and any(
                h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))] if len(g) < 3 else []
            if all(100 * b < 50 * a for b in longer):
                scored.append((-score, -a, " ".join(g).encode(), count[g[:k]], count[g[k:]]))
        for rank, (s, a, g, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_op11(spark, sf_small, documents):
    want = plain_collocations([(r.text, r.lang) for r in documents.collect()])
    assert rows_of(QUERIES["op11_collocations"](spark, sf_small)) == want and len(want) > 100


def test_collocations_of_few_words(spark, monkeypatch):
    """Many ties, overlaps, covered phrases, a hot pair, pieces of one word; small slices, so counts meet in buckets."""
    monkeypatch.setattr(collocations, "SLICE", 500)
    monkeypatch.setattr(collocations, "LEXICON", 3)
    rng = random.Random(3)
    words = ["a", "B", "b", "é", "É", "of", "the", "x.", "y,", "\n", "\t", "of the", "\x1c", "日本"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(0, 60))), rng.choice([None, "en", "und", "en de"])) for _ in range(300)]
    rows += [("of the of the of the", "en")] * 200 + [(None, "en"), ("", None)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    for least, top in ((10, 2000), (2, 7)):
        assert rows_of(collocations.mine(df, least=least, top=top)) == plain_collocations(rows, least, top)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_partitions_count_equal_rows(depth):
    rng = np.random.default_rng(depth)
    keys = rng.zipf(1.4, (20_000, depth)).clip(max=50).astype(np.int32)
    weights = rng.integers(1, 4, len(keys))
    want = Counter()
    for key, w in zip(map(tuple, keys.tolist()), weights.tolist(), strict=True):
        want[key] += w
    at, sizes = collocations.partitions(keys, weights, 10)
    got = dict(zip(map(tuple, keys[at].tolist()), sizes.tolist(), strict=True))
    assert got == {k: n for k, n in want.items() if n >= 10} and len(at) == len(got)
    assert len(collocations.partitions(keys[:0], weights[:0], 1)[0]) == 0


def test_add_up_repacks_wide_windows():
    rng = np.random.default_rng(1)
    ids = rng.integers(1, 1 << 20, (50, 4)).astype(np.int32)[rng.integers(0, 50, 3000)]
    first, counts = collocations.add_up(ids, 4)
    want = Counter(map(tuple, ids.tolist()))
    assert {tuple(ids[i].tolist()): int(n) for i, n in zip(first, counts, strict=True)} == dict(want)


# ---- ranked search --------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k=50):
    terms = {i: Counter(TERM.findall((t or "").translate(UPPER))) for i, t in docs}
    n_docs, n_terms = sum(1 for c in terms.values() if c), sum(sum(c.values()) for c in terms.values())
    df = Counter(t for c in terms.values() for t in c)
    out = []
    for item, text in items:
        asked, scored = set(TERM.findall((text or "").translate(UPPER))), []
        for i, c in terms.items():
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms if c else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in asked if c[t])
            if s > 0:
                scored.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def ranked_of(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_op12(spark, sf_small, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    want = plain_search(docs, items)
    assert ranked_of(QUERIES["op12_ranked_search"](spark, sf_small)) == want and len(want) > 500


def test_search_over_many_blocks(spark, monkeypatch):
    """Blocks of an index, thresholds carried between them, ties at the last rank, blocks of items."""
    monkeypatch.setattr(ranking, "INDEX_BYTES", 600)
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["É", "é", "A", "a", "a-b", "_", "ab12"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 5, 9, 40])))) for i in range(1500)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 12)))) for i in range(40)] + [(77, "nothing here"), (78, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    queries = spark.createDataFrame(items, "item_id long, text string")
    want = plain_search(docs, items, 7)
    assert ranked_of(ranking.search(df, queries, k=7)) == want
    assert ranked_of(ranking.search(df, queries, k=7, block_bytes=900)) == want


def test_pair_bounds_skip_more_and_lose_nothing():
    rng = np.random.default_rng(4)
    n_docs, n_terms = 4000, 12
    rows = [(t, d, int(rng.integers(1, 1000)) * (t + 1)) for t in range(n_terms)
            for d in rng.choice(n_docs, int(n_docs / (t + 2)), replace=False)]
    term, doc, impact = (np.array(c) for c in zip(*sorted(rows, key=lambda r: (r[1], r[0])), strict=True))
    alone = ranking.Index(doc, term, impact, n_docs, n_terms)
    paired = ranking.Index(doc, term, impact, n_docs, n_terms)
    walk = list(range(n_terms))
    for t, u in zip(walk, walk[1:]):
        paired.add_pair(t, u)
    assert all(p <= a for p, a in zip(paired.bounds(walk), alone.bounds(walk), strict=True))
    whole = np.zeros(n_docs, np.int64)
    np.add.at(whole, doc, impact)
    assert all(whole.max() <= b for b in (paired.bounds(walk)[-1], alone.bounds(walk)[-1]))
    threshold = int(np.sort(whole)[-20])
    want = {int(d): int(whole[d]) for d in np.flatnonzero(whole >= threshold)}
    reads = []
    for index in (alone, paired):
        read = []
        docs, scores = index.search(walk, threshold, read)
        assert dict(zip(docs.tolist(), scores.tolist(), strict=True)) == want
        reads.append(sum(read))
    assert reads[1] < reads[0] < len(rows)


# ---- sentence pieces ------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def test_op13(spark, sf_small, documents, library):
    import hashlib

    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in QUERIES["op13_sentence_pieces"](spark, sf_small).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_eos=True)
        assert got[r.doc_id] == (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)))


ALPHABET = [" ", "  ", "a", "b", "e", "t", "th", "in", "\t", "\n", "▁", "é", "ñ", "日", "本", "😀", "́", "x", "0", "1", "\x00",
            "\x7f", "\u3000", "<s>", "</s>", "<0x0A>", "ing", "\ufeff", "ᄀ", "aa", "AAAA", "=", "==", "====", "--", "\r"]


def test_encoding_and_decoding_equal_the_library(library):
    cache, rng = pieces.opened(pieces.MODEL), random.Random(1)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randrange(0, 25))) for _ in range(20_000)]
    texts += ["".join(rng.choices("abcdefgh -=", k=rng.randrange(80, 200))) for _ in range(300)]
    texts += [c * n for c in ("a", "=", " ", "日", "😀", "ab") for n in (95, 96, 97, 5000)]
    ids = pieces.ids_of(texts, cache)
    assert [x.tolist() for x in ids] == library.encode(texts, add_eos=True)
    assert [cache.vocabulary.decode(x) for x in ids] == [t.replace("▁", " ") for t in texts]


def test_decoding_any_ids_equals_the_library(library):
    vocabulary, rng = pieces.opened(pieces.MODEL).vocabulary, random.Random(2)
    for _ in range(20_000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3), rng.randrange(3, 259), rng.randrange(3, 259), 28705, 259])
               for _ in range(rng.randrange(12))]
        assert vocabulary.decode(np.array(ids, np.int32)) == library.decode(ids), ids


def test_both_ways_of_stepping_agree_and_backtrack():
    vocabulary, rng = pieces.opened(pieces.MODEL).vocabulary, random.Random(3)
    texts = list({" " + "".join(rng.choices("abeilnorst", k=rng.randrange(1, 40))) for _ in range(3000)})
    many = vocabulary.encode_many(texts)
    for text, ids in zip(texts, many, strict=True):
        parts = vocabulary.remerge(text)
        assert ids.tolist() == vocabulary.encode_long(text).tolist() == [vocabulary._id[p] for p in parts]


def test_bounded_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "RUNS", 5)
    monkeypatch.setattr(pieces, "PAIR_BITS", 3)
    cache = pieces.Runs(pieces.Vocabulary(pieces.MODEL))
    texts = ["some words come again and some words do not"] * 3 + ["other words altogether, in one more text"]
    for part in (texts[:2], texts[2:], texts):
        assert [x.tolist() for x in pieces.ids_of(part, cache)] == library.encode(part, add_eos=True)
    assert len(cache) <= 20
