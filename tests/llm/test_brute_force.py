"""Registered queries over whole tables against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tessera.llm import decontaminate, fmindex, html, mixing, pii, quality, sharding, simhash, substrings, tokens
from tessera.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(documents):
    return {r.doc_id: r for r in documents.collect()}


def run(spark, sf_small, name, key="doc_id"):
    return {r[key]: r for r in QUERIES[name](spark, sf_small).collect()}


def test_op1(spark, sf_small, docs):
    out = run(spark, sf_small, "op1_mix_sources")
    sizes, per = {i: len(WORD.findall(r.text or "")) for i, r in docs.items()}, Counter()
    for i, r in docs.items():
        per[r.source] += sizes[i]
    names = sorted(per)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, target, free = 1.5 * sum(per.values()), {}, set(names)
    while True:  # reshare until no target is above its stop
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 2 * per[s]}
        if not above:
            target |= {s: level * weight[s] for s in free}
            break
        for s in above:
            target[s] = 2.0 * per[s]
            left -= target[s]
        free -= above
    taken = Counter()
    for i, r in out.items():
        assert r.size == sizes[i] and r.source_size == per[docs[i].source] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(target[docs[i].source])
        taken[docs[i].source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    again = run(spark, sf_small, "op1_mix_sources")
    assert {i: r.taken for i, r in out.items()} == {i: r.taken for i, r in again.items()}


def test_schedule_follows_the_points(spark):
    """Slots against the golden-ratio points mapped one by one through the cumulative targets."""
    plan = spark.createDataFrame([(0, 700.0), (1, 0.0), (2, 200.0), (3, 100.0)], "ord int, target double")
    got = sorted((r.slot, r.ord, r["rank"]) for r in mixing.schedule(plan, 10).collect())
    edges, seen, want = [(0, 0.7), (2, 0.9), (3, 1.0)], Counter(), []
    for slot in range(100):
        point = (slot * mixing.STEP) % mixing.MODULUS
        source = next(o for o, hi in edges if point < int(hi * mixing.MODULUS + 1e-6))
        if seen[source] < {0: 70, 2: 20, 3: 10}[source]:
            want.append((slot, source, seen[source]))
        seen[source] += 1
    assert [g for g in got if g[0] < 100] == want
    assert Counter(o for _, o, _ in got) == {0: 70, 2: 20, 3: 10}


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_op2(spark, sf_small, docs):
    for i, r in run(spark, sf_small, "op2_personal_data").items():
        base = plain_spans(docs[i].text or "")
        joined = ",".join("%s:%d:%d" % s for s in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert not joined or set(joined.split(",")) <= set(r.spans.split(","))


def test_base_patterns_on_random_texts():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("a.@-+ 12( )9\t.5@b%") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_field_decodes_whole_texts_and_held_out_lines():
    field = pii.default_field()
    lines = pii.labelled_table(seed=99, rows=200)
    right = 0
    for line in lines:
        # the plain way: the whole line, plain words included, one position at a time
        scores = [pii.OUTSIDE, *(field.scores(pii.shape_features(t)) for t, _ in line), pii.OUTSIDE]
        best, back = scores[0], []
        for s in scores[1:]:
            through = best[:, None] + field.move
            back.append(through.argmax(0))
            best = through.max(0) + s
        path = [int(best.argmax())]
        for b in reversed(back):
            path.insert(0, int(b[path[0]]))
        text = " ".join(t for t, _ in line)
        runs = pii.sequences(text)
        got = field.viterbi([[pii.OUTSIDE, *(field.scores(pii.shape_features(text[a:b])) for a, b in run), pii.OUTSIDE]
                             for run in runs])
        spans = {run[k]: int(p[k + 1]) for run, p in zip(runs, got, strict=True) for k in range(len(run))}
        at, whole = 0, []
        for token, _ in line:
            whole.append(spans.get((at, at + len(token)), 0))
            at += len(token) + 1
        assert whole == path[1:-1]
        right += [pii.LABELS[p] for p in whole] == [label for _, label in line]
    assert right >= 180  # held-out lines


def test_op3_on_pages_and_held_out_layouts(spark, sf_small):
    import html as entities

    out = run(spark, sf_small, "op3_main_text", "page_id")
    for p in spark.read.parquet(f"{sf_small}/pages.parquet").collect():
        inside = p.html[p.html.index("<article>") : p.html.index("</article>")]
        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert out[p.page_id].text == "\n".join(b for b in parts if b) and out[p.page_id].n_chars == len(out[p.page_id].text)
    hits = [0, 0]
    for page, truth in html.labelled_pages(seed=77, pages=120):
        guess = html.default_tree().predict(html.features(html.blocks(page))).tolist()
        hits[0] += sum(a == b for a, b in zip(guess, truth, strict=True))
        hits[1] += len(truth)
    assert hits[0] >= 0.97 * hits[1]


@pytest.mark.parametrize("kind, value", [
    ("email", "jane.doe[at]example.com"), ("email", "jane.doe(at)example.com"), ("email", "jane.doe [at] example.com"),
    ("email", "jane (AT) example.org"), ("email", "jane7 [at] example.org"), ("phone", "555-123-4567"),
    ("phone", "(555)123-4567"), ("phone", "(555) 123-4567"),
])
@pytest.mark.parametrize("around", ["{}", "tel:{}", "({})", '"{}",', "<{}>."])
def test_added_spans_without_digits_and_in_marks(kind, value, around):
    if " " in value and around == "tel:{}":
        return
    text = "please write to " + around.format(value) + " any day"
    want = (kind, text.index(value), text.index(value) + len(value))
    assert pii.added_spans([text], pii.default_field()) == [[want]]


def test_plain_brackets_are_no_spans():
    text = "look (at) this. meet [at] noon, or <at> 12:30 {at}"
    assert pii.added_spans([text], pii.default_field()) == [[]]


@pytest.mark.parametrize("inside, want", [
    ('One <svg viewBox="0 0 1 1"/> two</p><p>three four', "One two\nthree four"),
    ("One <math/> two</p><p>three <svg><path/></svg> four", "One two\nthree four"),
    ("One</p><datalist><option>x<option>y</datalist><p>two</p><p>three", "One\ntwo\nthree"),
    ("One <button>two</p><p>three", "One two\nthree"),
    ("One <button>x</button> two</p><p>three <script>x", "One two\nthree"),
    ("One <iframe src='x'> two</p><p>three<!-- x", "One two\nthree"),
])
def test_raw_elements_end_where_they_end(inside, want):
    assert "\n".join(b[0] for b in html.blocks(f"<article><p>{inside}")) == want


def test_op4(spark, sf_small, docs):
    """The same score with plain dictionaries over the same bins."""
    from tessera.llm import scoring as s

    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    counts = {False: [Counter(), Counter(), Counter()], True: [Counter(), Counter(), Counter()]}
    own, total = {}, Counter()
    for i, r in docs.items():
        _, word, context, pair = s.bins([r.text.encode()])
        own[i] = [Counter(x.tolist()) for x in (word, context, pair)], list(zip(word.tolist(), context.tolist(), pair.tolist()))
        for target in (False, True):
            if not target or labels.get(i) == (1, 0):
                for c, o in zip(counts[target], own[i][0], strict=True):
                    c.update(o)
                total[target] += len(word)
    vocabulary = len(counts[False][0])
    out = run(spark, sf_small, "op4_cross_entropy_difference")
    for i in list(docs)[::10]:
        mine, tokens_ = own[i]
        loss = {}
        for target in (False, True):
            scale = total[True] / total[target]
            inside = not target or labels.get(i) == (1, 0)
            size = total[True] - scale * len(tokens_) * inside
            get = lambda k, b: max(scale * (counts[target][k][b] - inside * mine[k][b]), 0.0)  # noqa: B023, E731
            nll = 0.0
            for w, c, p in tokens_:
                unigram = (get(0, w) + s.PRIOR_WORD / vocabulary) / (size + s.PRIOR_WORD)
                nll -= np.log((min(get(2, p), get(1, c)) + s.PRIOR_PAIR * unigram) / (get(1, c) + s.PRIOR_PAIR))
            loss[target] = nll / max(len(tokens_), 1)
        assert out[i].target_loss == pytest.approx(loss[True], abs=1e-3)
        assert out[i].score == pytest.approx(loss[True] - loss[False], abs=2e-3)


def test_op4_counts_every_word_and_bigram_by_itself(spark):
    """More different words and bigrams than any fixed table: the plain score over the words themselves."""
    from tessera.llm import scoring as s

    rng = random.Random(6)
    rows = [(i, " ".join(["the", "same", *(f"w{rng.randrange(1 << 18)}" for _ in range(3000))])) for i in range(80)]
    rows += [(80 + i, "the same " * 50 + f"w{i}") for i in range(20)]
    good = {i for i in range(100) if i % 4 == 0}
    pairs = {i: list(zip([None, *t.split()], t.split(), strict=False)) for i, t in rows}
    count = {m: [Counter(), Counter(), Counter()] for m in (True, False)}
    three = lambda i: (Counter(w for _, w in pairs[i]), Counter(c for c, _ in pairs[i]), Counter(pairs[i]))
    for m in count:
        for i in good if m else pairs:
            for c, o in zip(count[m], three(i), strict=True):
                c.update(o)
    vocabulary = len(count[False][0])
    assert vocabulary > 2 << 16
    total = {m: sum(count[m][0].values()) for m in count}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i in good), 0) for i in range(100)], "doc_id long, quality int, toxic int")
    for r in s.score(docs, labels).collect():
        loss = {}
        for m in count:
            scale, mine, inside = total[True] / total[m], three(r.doc_id), not m or r.doc_id in good
            get = lambda k, x: max(scale * (count[m][k][x] - inside * mine[k][x]), 0.0)  # noqa: B023, E731
            size, nll = total[True] - scale * r.n_tokens * inside, 0.0
            for c, w in pairs[r.doc_id]:
                unigram = (get(0, w) + s.PRIOR_WORD / vocabulary) / (size + s.PRIOR_WORD)
                nll -= np.log((min(get(2, (c, w)), get(1, c)) + s.PRIOR_PAIR * unigram) / (get(1, c) + s.PRIOR_PAIR))
            loss[m] = nll / r.n_tokens
        assert r.n_tokens == len(pairs[r.doc_id])
        assert (r.target_loss, r.background_loss) == pytest.approx((loss[True], loss[False]), abs=1e-9)


def test_op5(spark, sf_small, docs):
    out = run(spark, sf_small, "op5_quality_rules")
    lines = {i: {h: (c, n) for h, c, n in quality.line_hashes(r.text or "")} for i, r in docs.items()}
    often, seen = Counter((docs[i].source, h) for i in docs for h in lines[i]), {}
    for i, r in docs.items():
        own = min(((often[r.source, h], -n, h, c) for h, (c, n) in lines[i].items()), default=None)
        for h in lines[i]:
            seen.setdefault((r.source, h), []).append(own[3])
    frequent = {k for k, v in seen.items() if len(set(v)) > quality.LINE_DOCS and len(set(v)) >= quality.DISTINCT * len(v)}
    for i, r in docs.items():
        text, words = r.text or "", WORD.findall(r.text or "")
        held = [x for x in text.split("\n") if WORD.search(x)]
        three, covered = Counter(zip(words, words[1:], words[2:])), set()
        for j in range(len(words) - 2):
            if three[tuple(words[j : j + 3])] > 1:
                covered |= {j, j + 1, j + 2}
        gone = sum(n for h, (_, n) in lines[i].items() if (r.source, h) in frequent)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert tuple(out[i])[1:] == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(held) - len(set(held)), len(covered),
            failed, not failed and len(words) - gone >= quality.LEFT * len(words), gone)


def test_frequent_lines_deplete_but_copies_do_not(spark):
    common = [" ".join(f"menu{k}w{j}" for j in range(20)) for k in range(5)]
    body = lambda i: " ".join(f"d{i}w{j}" for j in range(12))
    rng, rows = random.Random(1), []
    for i in range(60):  # mostly menus, half of them in another order each time
        rows.append((i, "\n".join([*(rng.sample(common, 5) if i % 2 else common), body(i)]), "s"))
    text = "\n".join(" ".join(f"copy{k}w{j}" for j in range(15)) for k in range(8))
    rows += [(100 + i, text.replace(f"copy{i % 8}w7", f"edit{i}"), "s") for i in range(60)]  # near copies
    out = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.kept for r in out if r.doc_id < 100} == {False} and {r.kept for r in out if r.doc_id >= 100} == {True}


def test_documents_of_shared_lines_only_are_depleted(spark):
    menu = [" ".join(f"menu{k}w{j}" for j in range(20)) for k in range(10)]
    rng = random.Random(2)
    rows = [(i, "\n".join(rng.sample(menu, 6)), "s") for i in range(400)]
    out = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {(r.kept, r.n_removed_words) for r in out} == {(False, 120)}


def test_copies_do_not_switch_a_removal_off(spark):
    footer = " ".join(f"foot{j}" for j in range(60))
    rows = [(i, footer + "\n" + " ".join(f"d{i}w{j}" for j in range(12)), "s") for i in range(200)]
    page = "\n".join([footer, *(" ".join(f"page{k}w{j}" for j in range(15)) for k in range(8))])
    rows += [(1000 + i, page, "s") for i in range(300)]
    out = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {(r.doc_id >= 1000, r.kept, r.n_removed_words) for r in out} == {(False, False, 60), (True, True, 60)}


def plain_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    ids, root = sorted(fps), {i: i for i in fps}
    for a in ids:
        for b in ids:
            if b < a and (fps[a] ^ fps[b]).bit_count() <= 2 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return root


def test_op6(spark, sf_small, docs):
    out = run(spark, sf_small, "op6_simhash_groups")
    fps = {i: plain_fingerprint(r.text) for i, r in docs.items()}
    assert {i: r.fingerprint for i, r in out.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in out.items()} == plain_components(fps)


def test_links_and_components_on_chains(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(240):  # chains of one and two bits
        fps.append(fps[rng.randrange(len(fps))] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = list(dict.fromkeys(f - (1 << 64) if f >> 63 else f for f in fps))
    classes = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(classes)).collect()}
    want = plain_components({f: f & ((1 << 64) - 1) for f in fps})
    assert {f: roots.get(f, f) for f in fps} == want


def test_op7(spark, sf_small, docs):
    size, n = 251, 7
    table = sharding.lookup_table([f"s{i}" for i in range(n)], size)
    assert max(Counter(table.tolist()).values()) - min(Counter(table.tolist()).values()) <= 1
    fewer = sharding.lookup_table([f"s{i}" for i in range(n - 1)], size)
    assert sum(a != b for a, b in zip(table, fewer, strict=True) if a != n - 1) < 0.35 * size
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 10)
    big = sharding.lookup_table([f"shard-{i:05d}" for i in range(sharding.SHARDS)])
    out = run(spark, sf_small, "op7_shards")
    assert set(out) == set(docs) and all(r.shard == big[r.slot] for r in out.values())
    for i, r in out.items():
        h = xxhash.xxh64_intdigest(int(i).to_bytes(8, "little"), 42)
        assert r.slot == (h - (1 << 64) if h >> 63 else h) % sharding.TABLE_SIZE


def test_op8(spark, sf_small, docs):
    """All windows of all items against all documents, by exact similarity only."""
    out = {(r.doc_id, r.item_id): r for r in QUERIES["op8_contaminated"](spark, sf_small).collect()}
    items = {r.item_id: decontaminate.plain_words(r.text.encode())
             for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()}
    counts = {i: Counter(decontaminate.shingles(w)) for i, w in items.items()}
    want = {}
    for d, r in docs.items():
        words = decontaminate.plain_words((r.text or "").encode())
        hashes = decontaminate.shingles(words)
        for i, item in items.items():
            if not counts[i].keys() & set(hashes):
                continue
            m = len(item) - 4
            best = max(decontaminate.similarity(Counter(hashes[p : p + m]), counts[i])
                       for p in range(max(1, len(hashes) - m + 1)))
            if best >= 0.8:
                want[d, i] = best
    assert want and {k: r.similarity for k, r in out.items()} == pytest.approx(want)


def test_edited_passages_are_found(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(rng.randint(25, 60)))) for i in range(40)]
    rows = []
    for i, text in items:
        words = text.split()
        words[0] = word()  # one edit at the edge: one shingle of either side is lost
        rows.append((i, " ".join([word() for _ in range(50)] + words + [word() for _ in range(50)])))
        rows.append((1000 + i, " ".join(word() for _ in range(150))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i, _ in items}


def plain_removal(texts):
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    seen = Counter(tuple(w[j : j + 35]) for w in words.values() for j in range(len(w) - 34))
    out = {}
    for i, w in words.items():
        covered = set()
        for j in range(len(w) - 34):
            if seen[tuple(w[j : j + 35])] > 1:
                covered |= set(range(j, j + 35))
        kept = " ".join(x for j, x in enumerate(w) if j not in covered)
        out[i] = (len(w), len(covered), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_op9(spark, sf_small, docs):
    out = run(spark, sf_small, "op9_repeated_substrings")
    assert {i: tuple(r)[1:] for i, r in out.items()} == plain_removal({i: r.text for i, r in docs.items()})


@pytest.mark.parametrize("most", [1, 3, 2000])
def test_passages_in_many_surroundings(spark, most):
    """Both ways of a minimiser, many segments and few, give the plain result."""
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefgh") + rng.choice("abcdefgh")
    passages = [[word() for _ in range(rng.randint(30, 120))] for _ in range(6)] + [["a"] * 90, ["a", "b"] * 40]
    texts = {}
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            cut = rng.randrange(10)
            parts += [word() for _ in range(rng.randint(0, 40))] + p[cut : len(p) - rng.randrange(10)]
        texts[i] = " ".join(parts)
    df = spark.createDataFrame(list(texts.items()), "row long, text string").selectExpr("row", "cast(text as binary) text")
    got = {i: set() for i in texts}
    for r in substrings.repeated_segments(df, most).collect():
        for k in range(r.windows):
            if r.mask >> k & 1:
                got[r.row] |= set(range(r.start + k, r.start + k + 35))
    assert {i: len(s) for i, s in got.items()} == {i: n for i, (_, n, _) in plain_removal(texts).items()}


def test_fm_index_counts():
    rng = random.Random(2)
    parts = [np.array([rng.randint(1, 4) for _ in range(rng.randint(1, 60))]) for _ in range(20)]
    index = fmindex.FMIndex(parts, 8)
    text = np.concatenate([x for p in parts for x in (p, np.zeros(1, int))])
    runs = Counter(tuple(p[i : i + n].tolist()) for p in parts for n in range(1, 9) for i in range(len(p) - n + 1))
    for end, got in enumerate(index.matching_statistics(text, np.arange(len(text)), 2).tolist()):
        want = 0
        while want < 8 and end - want >= 0 and runs[tuple(text[end - want : end + 1].tolist())] >= 2:
            want += 1
        assert got == want


def test_op10(spark, sf_small, docs):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(tokens.MODEL))
    for i, r in run(spark, sf_small, "op10_token_counts").items():
        n = len(sp.encode(docs[i].text or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((docs[i].text or "").encode()), n, n > 4096)


def test_pre_tokens_add_up():
    import public_tokenizers
    import sentencepiece

    sp, pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(tokens.MODEL)), tokens.Pieces(tokens.MODEL)
    rng = random.Random(8)
    for _ in range(2000):
        text = "".join(rng.choice(["a", "th", " ", "  ", "\n", "\t", "▁", "é", "日", "\r\n", "<s>", " ", ".", "5", "😀"])
                       for _ in range(rng.randint(0, 25)))
        assert sum(map(pieces.length, tokens.pre_tokens(text))) == len(sp.encode(text)), repr(text)


def test_pipeline(spark, sf_small, docs):
    """Kept, grouped and clean documents by the plain versions; then each source's words against its target."""
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, sf_small).collect()
    kept = {i for i, r in run(spark, sf_small, "op5_quality_rules").items() if r.kept}  # held to a plain version above
    roots = plain_components({i: plain_fingerprint(docs[i].text) for i in kept})
    first = {i for i in kept if roots[i] == i}
    leaks = {r.doc_id for r in QUERIES["op8_contaminated"](spark, sf_small).collect()}
    clean = first - leaks
    assert {r.doc_id for r in rows} <= clean
    sizes = {i: len(WORD.findall(docs[i].text)) for i in clean}
    whole = sum(sizes.values())
    words = sum(len(WORD.findall(r.text)) for r in rows)
    assert abs(words - 1.5 * whole) <= 20 or words <= 1.5 * whole
    for r in rows:
        assert docs[r.doc_id].text.startswith(r.text) and r.n_chars == len(r.text) and 0 <= r.shard < sharding.SHARDS
    assert max(Counter(r.doc_id for r in rows).values()) <= 2


def test_mix_follows_the_schedule(spark, documents):
    """The sources of the words read by slot keep near their shares from the start, which needs the schedule."""
    rows = [r for r in mixing.mix(documents).collect() if r.taken]
    share = {r.source: r.target for r in rows}
    whole = sum(share.values())
    rows.sort(key=lambda r: r.slot)
    so_far, seen = Counter(), 0
    for i, r in enumerate(rows):
        so_far[r.source] += r.taken
        seen += r.taken
        if i > len(rows) // 4:
            assert all(abs(so_far[s] / seen - t / whole) < 0.15 for s, t in share.items()), (i, so_far)
    mixed = mixing.mixed(documents).select("source").toPandas().source.tolist()  # the slots' order, partition by partition
    assert len(mixed) >= len(rows)


def test_long_tokens_are_shaped_whole():
    field = pii.default_field()
    for n in (90, 250, 5000):
        name = "a" * n
        for text in (f"to {name}[at]example.com now", f"to {name} [at] example.com now"):
            start, word = text.index(name), text[text.index(name) : text.index(" now")]
            assert pii.added_spans([text], field) == [[("email", start, start + len(word))]]


def test_decontamination_of_a_very_long_text_in_bounded_slices(spark, monkeypatch):
    import tracemalloc

    item = " ".join(f"q{i}" for i in range(30))
    words = [f"w{i % 5000}" for i in range(300_000)]
    text = " ".join(["x", item, *words, item, *words[:50], "q3 q4 q5 q6 q7", *words[:40]]).encode()
    index = decontaminate.Index([(7, item.encode())])
    assert [(i, s) for i, s, _ in index.matches(text, 0.8)] == [(7, 1.0)] and index.matches(text, 0.8)[0][2] == 1
    tracemalloc.start()
    index.matches(text, 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20
    want = index.matches(text, 0.8)
    monkeypatch.setattr(decontaminate, "WINDOWS", 3)
    monkeypatch.setattr(decontaminate, "SPAN", 40)
    assert index.matches(text, 0.8) == want


def test_equal_items_share_an_entry(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"a {item} b"), (2, "other words")], "doc_id long, text string")
    items = spark.createDataFrame([(i, item) for i in range(50)] + [(60, None)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()) == [(1, i) for i in range(50)]
    index = list(decontaminate.indexes(items, block_words=15))
    assert sum(len(x.ids) for x in index) == 1


def test_unigram_shares_of_the_vocabulary_sum_to_one():
    from tessera.llm import scoring as s

    counts = np.array([[5.0, 3.0, 2.0, 0.0, 0.0], [0.0, 0.0, 0.0, 0.0, 0.0]])  # four words and a context that was never seen
    for total, mass in ((10.0, 10.0), (10.0, 4.0)):
        model = s.Model(counts, total, mass, 4)
        at = np.array([[0, 1, 2, 3], [4] * 4, [4] * 4])
        none = np.zeros(4)
        assert np.exp(-model.losses(at, [none, none, none], none)).sum() == pytest.approx(1.0)
