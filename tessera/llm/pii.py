"""Personal data: fixed patterns plus a linear-chain conditional random field (operator 2).

``base_spans`` finds the four fixed kinds in one linear pass per kind, each
leftmost and non-overlapping.  The field adds spans the patterns cannot see
(numbers without a plus sign, spelled-out addresses, cards in dotted groups).
It is trained here on ``labelled_table()``, a small table of tagged lines, by
gradient ascent over forward-backward expectations, and decoded by Viterbi
over padded numpy batches.

A token without a digit or an at sign, plain or bracketed, is plain, and the field's constraint is
that plain tokens lie outside spans.  A text therefore falls apart exactly into
the runs of other tokens between them (the text's ends count as plain):
decoding the runs gives the best path of the whole text, and plain stretches
of any length cost nothing.  A tagged sequence becomes a span if an exact
check of its kind holds (digits, check sum, parts) and no base span is touched.
Marks and a label (``tel:``) around it are left off; a bracketed at sign that
stands by itself takes the words on either side.

Defined results: a null text counts as empty (zero counts, the digest of the
empty string, no spans); ids may be null or repeated (one result row per
input row); texts of any length are scanned whole; of two added spans that
overlap the first stays; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns, cut where a linear scan needs them cut.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"\[at\]|\(at\)|\{at\}|<at>", re.I)
_TRIGGER = re.compile(r"[0-9@]|" + _AT.pattern, re.I)
_LABEL, _OPEN, _CLOSE = re.compile(r"[A-Za-z]+[:=]"), "([{<\"'", ".,;:!?)]}>\"'"
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_WHITE, _WHITES = re.compile(r"[\x20\x09-\x0D]"), re.compile(r"[\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str) -> list[tuple[int, int]]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            found.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return found


def _ips(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = len(".".join(four))
            if all(map(_octet, four)):
                found.append((at, at + size))
            at += size + 1
    return found


def _numbers(text: str, pattern: re.Pattern, least: int, most: int, check) -> list[tuple[int, int]]:
    found = []
    for m in pattern.finditer(text):
        digits = "".join(_DIGIT.findall(m.group()))
        if least <= len(digits) <= most and check(digits):
            found.append(m.span())
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base spans, by kind as in ``KINDS``, then by start."""
    spans = [("email", a, b) for a, b in _emails(text)]
    spans += [("ip", a, b) for a, b in _ips(text)]
    spans += [("card", a, b) for a, b in _numbers(text, _CARD, 13, 19, luhn)]
    return spans + [("phone", a, b) for a, b in _numbers(text, _PHONE, 9, 15, lambda d: True)]


# ---- the field -------------------------------------------------------------------------------------------------

#: O, then begin and inside of each kind.
LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
PLAIN = ("plain",)
#: Tokens up to this length are kept in a task's table of scores; longer ones are scored each time, as whole as any.
KEPT = 200
OUTSIDE = np.array([0.0] + [-1e9] * (len(LABELS) - 1))


def shape_features(token: str) -> tuple[str, ...]:
    """Word-shape features; tokens without a trigger are all ``PLAIN``."""
    if not _TRIGGER.search(token):
        return PLAIN
    bracketed = _AT.search(token)
    core = _LABEL.sub("", _AT.sub("@@", token), count=1) if token[0].isalpha() else _AT.sub("@@", token)
    shape = re.sub(r"[A-Z]", "X", re.sub(r"[^\W\d_]", "x", core.lstrip(_OPEN).rstrip(_CLOSE)))
    runs = re.sub(r"x+", "x", re.sub(r"[0-9]+", lambda m: "d" * min(len(m.group()), 5), shape))
    digits = len(_DIGIT.findall(token))
    return (
        "s=" + runs,
        "n=" + str(min(digits, 20)),
        "paren=" + str("(" in token and ")" in token),
        "seps=" + str(min(sum(token.strip(".,;:!?").count(c) for c in ".-"), 4)),
        "at=" + ("bracketed" if bracketed else str("@" in token)),
    )


def labelled_table(seed: int = 7, rows: int = 400) -> list[list[tuple[str, str]]]:
    """The small labelled table: lines of (token, label), written from the formats people use."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeghilmnoprstuv") for _ in range(rng.randint(2, 9)))
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def tag(kind: str, text: str) -> list[tuple[str, str]]:
        return [(t, f"{'B' if i == 0 else 'I'}-{kind}") for i, t in enumerate(text.split(" "))]

    brackets = ("[at]", "(at)", "{at}", "<at>", "[AT]")
    private = [
        lambda: tag("phone", f"({num(3)}) {num(3)}-{num(4)}"),
        lambda: tag("phone", f"{num(3)}-{num(3)}-{num(4)}"),
        lambda: tag("phone", f"{num(3)}.{num(3)}.{num(4)}"),
        lambda: tag("phone", f"+{num(1)} ({num(3)}) {num(3)}-{num(4)}"),
        lambda: tag("card", f"{num(4)}.{num(4)}.{num(4)}.{num(4)}"),
        lambda: tag("card", f"{num(4)} {num(4)} {num(4)} {num(4)}"),
        lambda: tag("card", f"{num(4)}-{num(4)}-{num(4)}-{num(4)}"),
        lambda: tag("email", f"{word()}.{num(2)}@{word()}.com"),
        lambda: tag("email", f"{word()}@{word()}{num(1)}.org"),
        lambda: tag("email", f"{word()}{num(2)}[at]{word()}{num(1)}.com"),
        lambda: tag("email", f"{word()}.{word()}{rng.choice(brackets)}{word()}.com"),
        lambda: tag("email", f"{word()}{rng.choice(brackets)}{word()}.org"),
        lambda: [(f"{word()}.{word()}", "O"), (rng.choice(brackets), "B-email"), (f"{word()}.com", "O")],
        lambda: tag("phone", f"tel:{num(3)}-{num(3)}-{num(4)}"),
        lambda: tag("phone", f"({num(3)}-{num(3)}-{num(4)})"),
        lambda: tag("phone", f"({num(3)}){num(3)}-{num(4)}"),
        lambda: tag("ip", ".".join(str(rng.randint(1, 255)) for _ in range(4))),
    ]
    other = [
        lambda: [(num(rng.randint(1, 6)), "O")],
        lambda: [(num(16), "O")],
        lambda: [(num(rng.randint(7, 20)), "O")],
        lambda: [(f"{num(4)}-{num(2)}-{num(2)}", "O")],
        lambda: [(f"{num(2)}:{num(2)}", "O")],
        lambda: [(f"{num(1)}.{num(2)}", "O")],
        lambda: [(f"v{num(1)}.{num(1)}.{num(1)}", "O")],
        lambda: [(f"{word()}{num(1)}", "O")],
        lambda: [(f"{num(4)}-{num(4)}", "O")],
        lambda: [("@" + word(), "O")],
        lambda: [(f"({num(4)})", "O")],
    ]
    table = []
    for i in range(rows):
        line = [(word(), "O") for _ in range(rng.randint(2, 5))]
        kinds = private if i % 2 else other
        line += kinds[(i // 2) % len(kinds)]()
        table.append(line + [(word() + rng.choice(["", ".", ","]), "O") for _ in range(rng.randint(2, 4))])
    return table


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Field:
    """Weights of a trained linear-chain conditional random field."""

    def __init__(self, emit: dict[str, np.ndarray], move: np.ndarray):
        self.emit, self.move = emit, move

    def scores(self, features: tuple[str, ...]) -> np.ndarray:
        """Score of each label for one token; a plain token can only be O."""
        if features == PLAIN:
            return OUTSIDE
        return sum((self.emit[f] for f in features if f in self.emit), np.zeros(len(LABELS)))

    def viterbi(self, sequences: list[list[np.ndarray]]) -> list[np.ndarray]:
        """Best labels of each sequence of token scores, all sequences at once."""
        if not sequences:
            return []
        n, longest, k = len(sequences), max(map(len, sequences)), len(LABELS)
        scores, sizes = np.zeros((n, longest, k)), np.array([len(s) for s in sequences])
        for i, s in enumerate(sequences):
            scores[i, : len(s)] = s
        best, back = scores[:, 0], np.zeros((n, longest, k), np.int8)
        for t in range(1, longest):
            through = best[:, :, None] + self.move
            back[:, t] = through.argmax(1)
            best = np.where((t < sizes)[:, None], through.max(1) + scores[:, t], best)
        label = best.argmax(1)
        paths = np.zeros((n, longest), np.int8)
        for t in range(longest - 1, -1, -1):
            paths[:, t] = label
            label = np.where(t < sizes, back[np.arange(n), t, label], label)
        return [paths[i, :m] for i, m in enumerate(sizes)]


def train(table: list[list[tuple[str, str]]], steps: int = 150, rate: float = 0.15, ridge: float = 2e-3) -> Field:
    """Maximum conditional likelihood by Adam; lines are padded to one numpy batch."""
    names = sorted({f for line in table for token, _ in line for f in shape_features(token)})
    index, k, n, longest = {f: i for i, f in enumerate(names)}, len(LABELS), len(table), max(map(len, table))
    active, gold = np.zeros((n, longest, len(names))), np.zeros((n, longest), int)
    mask, fixed = np.zeros((n, longest)), np.zeros((n, longest, k))
    for i, line in enumerate(table):
        for t, (token, label) in enumerate(line):
            active[i, t, [index[f] for f in shape_features(token)]] = 1
            fixed[i, t] = OUTSIDE if shape_features(token) == PLAIN else 0
            gold[i, t], mask[i, t] = LABELS.index(label), 1
    emit, move = np.zeros((len(names), k)), np.zeros((k, k))
    moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(move), np.zeros_like(move)]
    truth = np.eye(k)[gold] * mask[:, :, None]
    pairs = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
    for step in range(1, steps + 1):
        scores = active @ emit + fixed
        alpha, beta = [scores[:, 0]], [np.zeros((n, k))]
        for t in range(1, longest):
            new = _logsum(alpha[-1][:, :, None] + move, 1) + scores[:, t]
            alpha.append(np.where(mask[:, t, None] > 0, new, alpha[-1]))
        for t in range(longest - 1, 0, -1):
            new = _logsum(move + (scores[:, t] + beta[0])[:, None, :], 2)
            beta.insert(0, np.where(mask[:, t, None] > 0, new, beta[0]))
        z = _logsum(alpha[-1], 1)
        belief = np.stack([np.exp(a + b - z[:, None]) for a, b in zip(alpha, beta, strict=True)], 1) * mask[:, :, None]
        expected = np.zeros((k, k))
        for t in range(1, longest):
            both = alpha[t - 1][:, :, None] + move + (scores[:, t] + beta[t])[:, None, :] - z[:, None, None]
            expected += (np.exp(both) * mask[:, t, None, None]).sum(0)
        grads = (np.einsum("ntf,ntk->fk", active, truth - belief) / n - ridge * emit,
                 (pairs - expected) / n - ridge * move)
        for weights, grad, m, v in ((emit, grads[0], *moments[:2]), (move, grads[1], *moments[2:])):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            weights += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field({f: emit[i] for f, i in index.items()}, move)


@lru_cache(1)
def default_field() -> Field:
    """The field of this module's labelled table (trained once per driver process)."""
    return train(labelled_table())


def _added(kind: str, text: str) -> bool:
    """Exact check of a tagged span."""
    digits = "".join(_DIGIT.findall(text))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9 .-]+", text) is not None
    if kind == "phone":
        return re.fullmatch(r"(?:\([0-9]{3}\)[ .-]?|[0-9]{3}\)?[ .-])[0-9]{3}[ .-][0-9]{4}", text) is not None
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isdigit() and _octet(p) for p in parts)
    return re.fullmatch(rf"[A-Za-z0-9._%+-]+\s?(?:{_AT.pattern})\s?[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text, re.I) is not None


def _checked(kind: str, text: str, a: int, b: int) -> tuple[int, int] | None:
    """The tagged span less marks and a label around it, if the exact check of its kind holds."""
    if kind == "email" and _AT.match(text, a):  # the local part stands before
        a -= a > 1 and _WHITE.match(text, a - 1) is not None
        while a and text[a - 1] in _LOCAL:
            a -= 1
    if kind == "email" and _AT.fullmatch(text, max(b - 4, a), b) and (m := _TOKEN.match(text, b + 1)):
        b = m.end()
    label = _LABEL.match(text, a, b)
    i, j = label.end() if label else a, b
    while i < j and text[i] in _OPEN:
        i += 1
    while j > i and text[j - 1] in _CLOSE:
        j -= 1
    # one bracket on either side may belong to it
    for start in dict.fromkeys((a, max(i - 1, a), i)):
        for end in dict.fromkeys((b, min(j + 1, b), j)):
            if start < end and _added(kind, text[start:end]):
                return start, end
    return None


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring tokens that hold a trigger, as (start, end) of each token."""
    runs: list[list[tuple[int, int]]] = []
    done = 0
    for m in _TRIGGER.finditer(text):
        if m.start() < done:
            continue
        start = m.start()
        while start > done and not _WHITE.match(text, start - 1):
            start -= 1
        end = _TOKEN.match(text, m.start()).end()
        if runs and _WHITES.fullmatch(text, runs[-1][-1][1], start):
            runs[-1].append((start, end))
        else:
            runs.append([(start, end)])
        done = end
    return runs


def added_spans(texts: list[str], field: Field) -> list[list[tuple[str, int, int]]]:
    """Spans the field adds to each text."""
    scored = lambda token: field.scores(shape_features(token))
    kept = lru_cache(100_000)(scored)
    cached = lambda token: (kept if len(token) <= KEPT else scored)(token)
    owner, tokens, scores = [], [], []
    for i, text in enumerate(texts):
        for seq in sequences(text):
            owner.append(i)
            tokens.append(seq)
            # a plain token on either side carries the moves from and to the text around
            scores.append([OUTSIDE, *(cached(text[a:b]) for a, b in seq), OUTSIDE])
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for i, seq, path in zip(owner, tokens, field.viterbi(scores), strict=True):
        kind, start, end = "", 0, 0
        for token, label in [*zip(seq, path[1:-1].tolist(), strict=True), (None, 0)]:
            name = LABELS[label]
            if name[0] == "I" and name[2:] == kind:
                end = token[1]
                continue
            if kind:
                if span := _checked(kind, texts[i], start, end):
                    out[i].append((kind, *span))
            kind = ""
            if name[0] != "O":
                kind, (start, end) = name[2:], token
    return out


def _join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """documents -> doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans (base and added)."""
    field = field or default_field()  # a few kilobytes, sent with the tasks

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t and _TRIGGER.search(t) else "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) if t else [] for t in texts]
            more = added_spans(texts, field)
            every = []
            for old, new in zip(base, more, strict=True):
                spans = list(old)
                for s in new:
                    if all(s[2] <= a or b <= s[1] for _, a, b in spans):
                        spans.append(s)
                every.append(sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *counts,
                    pa.array([hashlib.sha256(_join(b).encode()).hexdigest() for b in base], pa.string()),
                    pa.array([_join(s) for s in every], pa.string()),
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(scan, schema)
