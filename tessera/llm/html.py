"""Main text of web pages: flat text blocks and a decision tree (operator 3).

A page is cut into flat text blocks at block-level tags.  Each block has its
word count, its link density and those of the blocks before and after it,
and the section it stands in: boilerplate by element or by a purpose named in
class, id or role, or part of an article.  Names of layout (header, sidebar)
around an article, or around most of a page without one, decide nothing.  An
end tag that may be left out is implied by the next tag of its kind.  A decision tree, trained here on
``labelled_pages()`` (a small table of built pages whose blocks are known),
keeps or drops each block.

Defined results: a null or empty page has empty text and 0 characters; markup
cut off at the end of a page is dropped; unclosed and stray tags do not
matter (an unclosed script, style, textarea, title or comment reaches to the end); every input row gives one row, so repeated ids stay; a page of any
length is read whole; an empty table gives an empty result; columns other than
page_id, url and html are not looked at.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: HTML element names by role.
_RAW = frozenset("script style noscript template svg math iframe object textarea title select option button".split())
_TO_END = frozenset("script style textarea title".split())  # without an end tag: all the rest of the page
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
_BOILER = frozenset("nav header footer aside form menu dialog".split())
_MAIN = frozenset(("article", "main"))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSED_BY = {  # elements whose end tag may be left out, and the start tags that end them
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
                   " header hgroup hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
    "tr": frozenset("tr tbody tfoot".split()), "td": frozenset("td th tr tbody tfoot".split()),
    "th": frozenset("td th tr tbody tfoot".split()),
}
#: Words in class, id and role that name a section's purpose, those of the page's layout, and words that
#: say that a section holds others.
_PURPOSE = frozenset(
    "ad ads banner sponsor cookie cookies consent notice newsletter subscribe signup login popup modal comment comments"
    " replies reply disqus related share social widget contentinfo complementary".split()
)
_LAYOUT = frozenset("side sidebar nav menu breadcrumb breadcrumbs header footer foot navigation search".split())
_PREFIXES = ("advert", "promo", "sponsor", "nav")
_HOLDER = frozenset("wrapper wrap container content main article post entry body page layout inner outer results root".split())
#: A layout section that holds more than this share of a page's plain words is the page (pages without an article).
WHOLE = 0.6
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9-]*)"
    # white space, slashes and attributes one by one; a value without quotes ends at white space or the tag's end
    r"(?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)?+)*+)(?:>|\Z)"
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)",
    re.I | re.S,
)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW}
_ENDS["option"] = re.compile(r"</option\s*>|(?=</?(?:option|optgroup|select|datalist)\b)", re.I)
_ATTR = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "boiler", "main", "any_main")


def marks(page: str) -> Iterator[tuple[re.Match, int, str]]:
    """Tags and comments in page order: match, where the text goes on, name; raw elements whole and without a name."""
    at, unclosed = 0, set()
    while m := _TAG.search(page, at):
        at, name = m.end(), (m["name"] or "").lower()
        if name in _RAW and not m["end"]:
            empty = name in ("svg", "math") and m["attrs"].endswith("/")
            if not empty and name not in unclosed:
                closed = _ENDS[name].search(page, at)
                if closed:
                    at = closed.end()
                elif name in _TO_END:
                    at = len(page)
                else:
                    unclosed.add(name)  # only the tag goes
            name = ""
        yield m, at, name


@lru_cache(4096)
def hint_of(attrs: str) -> int:
    """What class, id and role say: 2 a purpose that is no article text, 1 a part of the layout, 0 neither."""
    hint = 0
    for value in _ATTR.findall(attrs):
        for name in (value[0] or value[1] or value[2]).lower().split():
            parts = [x for x in re.split(r"[\s_-]+", name) if x]
            if any(x in _PURPOSE or x.startswith(_PREFIXES[:3]) for x in parts):
                hint = 2
            elif any(x in _LAYOUT or x.startswith(_PREFIXES[3]) for x in parts) and not any(x in _HOLDER for x in parts):
                hint = max(hint, 1)
    return hint


def blocks(page: str) -> list[tuple[str, int, int, int, int]]:
    """Flat blocks in page order: (text, words, words in links, boilerplate depth, article depth).

    Elements and hints of class, id and role give the boilerplate depth.  A hint of layout alone does not decide: it
    is void for an article inside its section, and where a page has no article, for a section that holds most of the
    page's plain words.
    """
    found: list[tuple[str, int, int, int, int]] = []
    inside: list[tuple[int, ...]] = []  # per block, its open layout sections
    stack: list[tuple[str, int, int, int]] = []  # open sections: name, boiler, main, layout section
    text: list[str] = []
    linked = boiler = main = 0
    layout: tuple[int, ...] = ()
    numbered = 0
    in_link = False

    def close() -> None:
        nonlocal linked
        whole = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
        if whole:
            words = whole.count(" ") + 1
            found.append((whole, words, min(linked, words), boiler, main))
            inside.append(layout)
        text.clear()
        linked = 0

    def pop(i: int) -> None:
        nonlocal boiler, main, layout
        boiler -= sum(s[1] for s in stack[i:])
        main -= sum(s[2] for s in stack[i:])
        gone = {s[3] for s in stack[i:] if s[3]}
        if gone:
            layout = tuple(x for x in layout if x not in gone)
        del stack[i:]

    def piece(raw: str) -> None:
        nonlocal linked
        if raw:
            text.append(raw)
            if in_link:
                linked += len(raw.split())

    at = 0
    for m, after, name in marks(page):
        piece(page[at : m.start()])
        at = after
        if not name:
            continue
        if name == "a":
            in_link = not m["end"]
            continue
        if name in _INLINE:
            if name == "br":
                text.append(" ")
            continue
        close()
        if not m["end"]:
            while stack and name in _CLOSED_BY.get(stack[-1][0], ()):
                pop(len(stack) - 1)
        if name in _VOID:
            continue
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop(i)
                    in_link = False
                    break
            continue
        here = int(name in _MAIN)
        hint = 2 if name in _BOILER else 0
        if not hint and m["attrs"] and name not in ("html", "body"):
            hint = hint_of(m["attrs"])
        deeper, own = int(hint > 0), 0
        if hint == 1:
            numbered += 1
            own = numbered
            layout += (own,)
        if here:  # layout around an article says nothing about the article
            deeper -= sum(1 for x in layout if x != own)
        if hint or here or name in ("div", "section", "ul", "ol", "table"):
            stack.append((name, deeper, here, own))
            boiler += deeper
            main += here
    piece(page[at:])
    close()
    if numbered and not any(b[4] for b in found):
        plain = sum(b[1] - b[2] for b in found)
        held = [0] * (numbered + 1)
        for b, sections in zip(found, inside, strict=True):
            for x in sections:
                held[x] += b[1] - b[2]
        void = {x for x in range(1, numbered + 1) if held[x] > WHOLE * plain}
        found = [(*b[:3], b[3] - sum(1 for x in sections if x in void), b[4])
                 for b, sections in zip(found, inside, strict=True)]
    return found


def features(found: list[tuple[str, int, int, int, int]]) -> np.ndarray:
    """One row per block, columns as in ``FEATURES``."""
    if not found:
        return np.zeros((0, len(FEATURES)))
    words, links, boiler, main = np.array([b[1:] for b in found], float).T
    density = links / words
    pad = lambda x: (np.concatenate(([0.0], x[:-1])), np.concatenate((x[1:], [0.0])))
    (w0, w1), (d0, d1) = pad(words), pad(density)
    anywhere = np.full(len(found), float((main > 0).any()))
    return np.stack([words, density, w0, d0, w1, d1, np.minimum(boiler, 1), np.minimum(main, 1), anywhere], 1)


class Tree:
    """A binary decision tree as flat arrays."""

    def __init__(self) -> None:
        self.column: list[int] = []
        self.cut: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.keep: list[bool] = []

    def grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        me = len(self.column)
        for part, value in ((self.column, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1),
                            (self.keep, bool(y.mean() >= 0.5))):
            part.append(value)
        if depth == 0 or len(y) < 2 * least or y.min() == y.max():
            return me
        best = (1e-9, -1, 0.0)
        whole = y.mean() * (1 - y.mean())
        for c in range(x.shape[1]):
            order = np.argsort(x[:, c], kind="stable")
            values, hits = x[order, c], np.cumsum(y[order])
            n = np.arange(1, len(y))
            p, q = hits[:-1] / n, (hits[-1] - hits[:-1]) / (len(y) - n)
            gain = whole - (n * p * (1 - p) + (len(y) - n) * q * (1 - q)) / len(y)
            gain[(values[1:] <= values[:-1]) | (n < least) | (len(y) - n < least)] = 0
            i = int(gain.argmax())
            if gain[i] > best[0] + 1e-12:
                best = (gain[i], c, (values[i] + values[i + 1]) / 2)
        if best[1] < 0:
            return me
        below = x[:, best[1]] <= best[2]
        self.column[me], self.cut[me] = best[1], best[2]
        self.left[me] = self.grow(x[below], y[below], depth - 1, least)
        self.right[me] = self.grow(x[~below], y[~below], depth - 1, least)
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        column, cut = np.array(self.column), np.array(self.cut)
        left, right, node = np.array(self.left), np.array(self.right), np.zeros(len(x), int)
        while len(x) and (inner := column[node] >= 0).any():
            low = x[np.arange(len(x)), np.maximum(column[node], 0)] <= cut[node]
            node = np.where(inner, np.where(low, left[node], right[node]), node)
        return np.array(self.keep)[node] if len(x) else np.zeros(0, bool)


def labelled_pages(seed: int = 11, pages: int = 240) -> list[tuple[str, list[bool]]]:
    """The small labelled table: pages built from common layouts, and which of their blocks are main text."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeghilmnoprstuv") for _ in range(rng.randint(1, 9)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    links = lambda n: "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(n))
    table = []
    for i in range(pages):
        parts: list[str] = []
        truth: list[bool] = []

        def put(markup: str, *keep: bool, parts=parts, truth=truth) -> None:
            parts.append(markup)
            truth.extend(keep)

        def aside(put=put) -> None:
            kind = rng.randint(0, 7)
            if kind == 0:
                put(f'<div class="ad">{words(3, 30)}</div>', False)
            elif kind == 1:
                put(f'<aside id="sidebar"><p>{words(2, 40)}</p></aside>', False)
            elif kind == 2:
                put(f'<div class="cookie-notice"><p>{words(4, 20)}</p></div>', False)
            elif kind == 3:
                put(f'<form action="/s"><label>{words(1, 3)}</label><input name="q"></form>', False)
            elif kind == 4:
                put(f'<section class="comments"><div class="comment"><p>{words(3, 50)}</p></div></section>', False)
            elif kind == 5:
                n = rng.randint(2, 6)
                put(f'<div class="related"><ul>{links(n)}</ul></div>', *[False] * n)
            elif kind == 6:
                n = rng.randint(2, 7)
                put(f"<ul>{links(n)}</ul>" if i % 3 else f"<nav><ul>{links(n)}</ul></nav>", *[False] * n)

        n = rng.randint(3, 8)
        put(f"<body><nav><ul>{links(n)}</ul></nav>", *[False] * n)
        if rng.random() < 0.5:
            put(f"<header><h1>{words(1, 6)}</h1></header>", False)
        aside()
        opened, closed = (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"))[i % 3]
        parts.append(opened)
        if i % 3 < 2:
            put(f"<h1>{words(1, 12)}</h1>", True)
        for _ in range(rng.randint(1, 9)):
            put(f"<p>{words(1, 90) if i % 3 < 2 else words(12, 90)}</p>", True)
            if rng.random() < 0.15:
                aside()
        if i % 3 < 2 and rng.random() < 0.3:
            put(f"<blockquote>{words(1, 20)}</blockquote><ul><li>{words(1, 9)}</li></ul>", True, True)
        if i % 3 < 2 and rng.random() < 0.3:
            put(f'<p><a href="/{word()}">{words(1, 12)}</a></p>', True)
        parts.append(closed)
        aside()
        put(f"<footer>&copy; {words(1, 12)}</footer></body>", False)
        table.append(("".join(parts), truth))
    return table


@lru_cache(1)
def default_tree() -> Tree:
    """The tree of this module's labelled pages (grown once per driver process)."""
    x, y = [], []
    for page, truth in labelled_pages():
        x.append(features(blocks(page)))
        y.append(np.array(truth, float))
        if len(x[-1]) != len(y[-1]):
            raise ValueError("a labelled page has other blocks than labels")
    tree = Tree()
    tree.grow(np.concatenate(x), np.concatenate(y), depth=6, least=4)
    return tree


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page) if page else []
    return "\n".join(b[0] for b, keep in zip(found, tree.predict(features(found)).tolist(), strict=True) if keep)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """pages -> page_id, url, text, n_chars."""
    tree = tree or default_tree()  # a few dozen nodes, sent with the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, tree) for p in batch.column("html").to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
