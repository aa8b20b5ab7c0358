"""Main text of web pages by a graphical model over the DOM tree.

A page becomes a tree of block elements with runs of text as leaves. Every node
is content or not. Features of a node (its tag, words of its class and id, the
length, links and punctuation of its text) give its own potential, and every
parent and child share a potential, so evidence travels: upward messages gather
what the descendants say, downward messages what the rest of the page says, and
both together are the exact marginals of a tree. Leaves above one half are the text.

Weights are trained by gradient ascent on the likelihood of labelled pages: pages
that mark their article themselves. In every second one the marks are hidden from
the features, so that text and structure have to explain the labels as well. A
Gaussian prior around plain expectations (menus are no content, long sentences
are) holds where labels say nothing; without labelled pages it is the model.

Defined cases: a null or empty html has no text; html without elements is one run
of text, judged like any other; broken and unclosed markup is closed where HTML
closes it; svg, select, template and noscript are left out up to their own end tag,
and where that is missing only the tag is; repeated rows give equal rows; a null id or url is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.words import bytewise

TRAIN_PAGES, TRAIN_CHARS = 400, 50_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]{0,4096}\"|'[^']{0,4096}')*)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HINT = re.compile(r"[A-Za-z][a-z]+|[A-Z]+")
# Fixed values of HTML: elements without an end tag, without text of the page, inside lines,
# and those that a start tag of the same group closes.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea iframe".split())
HIDDEN = frozenset("svg select template noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q ruby s samp small span strike strong sub "
    "sup time tt u var".split()
)
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
CLOSES = {tag: frozenset(closed.split()) for tag, closed in CLOSES.items()}
SCOPES = frozenset("ul ol dl table tbody thead tfoot".split())
# Start tags that end an open svg, and elements of svg that hold HTML.
BREAKS = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
FOREIGN_HTML = frozenset("foreignobject desc title".split())
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_UNQUOTED_END = re.compile(r"=\s*[^\s\"']\S*\Z")

# What a page calls its parts.
GOOD_TAGS = ("article", "main")
BAD_TAGS = ("nav", "footer", "aside", "form", "button", "menu", "dialog", "head")
GOOD_HINTS = ("article", "content", "main", "post", "entry", "story", "body")
BAD_HINTS = (
    "nav", "navbar", "navigation", "menu", "footer", "sidebar", "aside", "comment", "comments", "reply", "replies",
    "respond", "disqus", "ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner", "cookie",
    "cookies", "consent", "notice", "alert", "popup", "modal", "share", "sharing", "social", "related", "recommended",
    "login", "subscribe", "newsletter", "signup", "breadcrumb", "breadcrumbs", "pagination", "pager",
    "widget", "toolbar", "masthead", "copyright", "legal", "skip",
)
# These name a part of the page only where nothing says that it is a part of the article.
OUTER_HINTS = ("header", "form", "search", "tags")
# A name with one of these tells what a container has beside its content.
LAYOUT_HINTS = ("with", "has", "without", "no", "layout")
TAGS = ("header", "section", "div", "p", "li", "ul", "table", "td", "h", "pre", "blockquote", "figure", "body", "html", "other")

# Features and where the prior puts their weights: positive for content.
PRIOR = {
    "bias:element": -0.2, "bias:text": 0.0,
    **{f"tag:{t}": 3.0 for t in GOOD_TAGS}, **{f"tag:{t}": -4.0 for t in BAD_TAGS}, **{f"tag:{t}": 0.0 for t in TAGS},
    "tag:header": -1.5, "tag:p": 0.8, "tag:body": -0.5, "tag:html": -0.5, "tag:pre": 0.5, "tag:blockquote": 0.5,
    "hint:good": 1.5, "part:other": -6.0,
    "text:short": -0.3, "text:line": 0.2, "text:long": 1.0, "text:page": 1.5,
    "links:none": 0.3, "links:some": -0.5, "links:most": -2.5,
    "ends:sentence": 0.5, "ends:other": -0.2, "in:p": 0.7, "in:h": 0.3, "in:li": -0.3, "in:other": -0.2,
}
FEATURES = {name: k for k, name in enumerate(PRIOR)}
# Log potentials by kind of child (element, text), state of the parent, state of the child.
PAIR_PRIOR = np.array([[[1.0, -1.0], [-1.5, 1.5]], [[1.2, -1.2], [-1.5, 1.5]]])


@dataclass
class Page:
    """Nodes in page order: parents come before children. ``texts[i]`` is set for leaves."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    hints: list[str] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, hints: str = "", text: str | None = None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.hints.append(hints)
        self.texts.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


def _hints(attributes: str) -> str:
    """"good", "bad", both or neither, by the words of class, id and role."""
    if "=" not in attributes:
        return ""
    found = set()
    for name in " ".join(_ATTRIBUTE.findall(attributes)).replace('"', " ").replace("'", " ").split():
        words = {w.lower() for w in _HINT.findall(name)}
        good = not words.isdisjoint(GOOD_HINTS)
        outer = not good and not words.isdisjoint(OUTER_HINTS)
        if words.isdisjoint(LAYOUT_HINTS) and (outer or not words.isdisjoint(BAD_HINTS)):
            found.add("bad")
        elif good:
            found.add("good")
    return " ".join(sorted(found))


def other_parts(page: Page) -> list[bool]:
    """Nodes in a part of the page that is named as something else than its article."""
    bad, good = [], []
    for i, p in enumerate(page.parent):
        above_bad, above_good = (bad[p], good[p]) if p >= 0 else (False, False)
        if page.texts[i] is None:
            tag, named = page.tag[i], "bad" in page.hints[i] and page.tag[i] not in ("html", "body")
            above_bad = above_bad or named or tag in BAD_TAGS or (tag == "header" and not above_good)
            above_good = above_good or tag in GOOD_TAGS
        bad.append(above_bad)
        good.append(above_good)
    return bad


def _self_closed(attributes: str) -> bool:
    """Whether a tag ends with a slash that is not the end of an unquoted value."""
    return attributes.endswith("/") and not _UNQUOTED_END.search(_QUOTED.sub('""', attributes))


def _skips(html: str) -> dict[int, int]:
    """Where to go on behind start tags whose elements are left out, by the ends of these tags.

    Elements of RAW run to their end tag or to the end of the page, but within svg they are like
    any other. Those of HIDDEN are left out if their own end tag comes before that of an element
    around them and before a tag that breaks out of svg. Self-closed elements are empty in svg.
    """
    skips: dict[int, int] = {}
    opened: list[tuple[str, int, bool]] = []  # tag, end of its start tag, whether it holds svg
    count: dict[str, int] = {}
    at = 0

    def pop() -> tuple[str, int, bool]:
        last = opened.pop()
        count[last[0]] -= 1
        return last

    while token := _TOKEN.search(html, at):
        at = token.end()
        tag = (token.group(2) or token.group(5) or "").lower()
        ending = token.group(1) or token.group(4)
        svg = bool(opened) and opened[-1][2]
        if svg and not ending and tag in BREAKS:
            while opened and opened[-1][2]:
                pop()
            svg = False
        if not tag or (ending and not count.get(tag)):
            continue
        if ending:
            while (last := pop())[0] != tag:
                pass
            if tag in HIDDEN or (tag in RAW and opened and opened[-1][2]):
                skips[last[1]] = at
        elif (svg or tag == "svg") and _self_closed(token.group(3) or token.group(6) or ""):
            skips[at] = at
        elif tag in INLINE or tag in VOID:
            continue
        elif tag in RAW and not svg:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            start, at = at, end.end() if end else len(html)
            skips[start] = at
        else:
            opened.append((tag, at, tag == "svg" or (svg and tag not in FOREIGN_HTML)))
            count[tag] = count.get(tag, 0) + 1
    return skips


def parse(html: str) -> Page:
    """The block tree of a page. Text in inline elements belongs to the block around them."""
    page = Page()
    stack = [page.add(-1, "html")]
    run: list[str] = []
    linked, links, at = 0, 0, 0
    skips = _skips(html)

    def put(text: str) -> None:
        nonlocal linked
        run.append(text)
        if links:
            linked += len(text)

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(run)).split()) if run else ""
        if text:
            page.add(stack[-1], page.tag[stack[-1]], "", text, linked)
        run.clear()
        linked = 0

    def close(wanted: frozenset[str], until: frozenset[str] = frozenset()) -> None:
        """End the innermost open element of ``wanted``, if nothing of ``until`` is in between."""
        for k in range(len(stack) - 1, 0, -1):
            tag = page.tag[stack[k]]
            if tag in wanted:
                flush()
                del stack[k:]
                return
            if tag in until:
                return

    while True:
        token = _TOKEN.search(html, at)
        if token is None:
            put(html[at:])
            break
        if token.start() > at:
            put(html[at : token.start()])
        at = token.end()
        tag = (token.group(2) or token.group(5) or "").lower()
        if not tag:
            continue
        ending = token.group(1) or token.group(4)
        if not ending and (at in skips or tag in RAW or tag in HIDDEN):
            at = skips.get(at, at)
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if ending else 1
            continue
        if tag == "br":
            put(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if ending:
            close(frozenset((tag,)))
            links = 0
            continue
        close(frozenset(("p",)), SCOPES | {"td", "th", "li", "div"})
        if tag in CLOSES:
            close(CLOSES[tag], SCOPES - {"tbody", "thead", "tfoot"} if tag == "tr" else SCOPES)
        flush()
        links = 0
        if tag == "html":
            continue
        stack.append(page.add(stack[-1], tag, _hints(token.group(3) or token.group(6) or "")))
    flush()
    return page


def _kind(tag: str) -> str:
    if tag in GOOD_TAGS or tag in BAD_TAGS or tag in TAGS:
        return tag
    if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
        return "h"
    return {"ol": "ul", "th": "td", "dd": "li", "dt": "li", "dl": "ul"}.get(tag, "other")


def _features(page: Page, hide: bool = False) -> Iterator[tuple[int, str]]:
    """(node, feature). ``hide`` leaves out what a page says about its own parts."""
    if not hide:
        yield from ((i, "part:other") for i, other in enumerate(other_parts(page)) if other)
    for i, text in enumerate(page.texts):
        if text is None:
            yield i, "bias:element"
            kind = _kind(page.tag[i])
            if hide:
                kind = "div" if kind in GOOD_TAGS or kind in BAD_TAGS or kind == "header" else kind
            elif "good" in page.hints[i]:
                yield i, "hint:good"
            yield i, f"tag:{kind}"
            continue
        yield i, "bias:text"
        n = len(text)
        yield i, "text:short" if n < 25 else "text:line" if n < 80 else "text:long" if n < 400 else "text:page"
        share = page.linked[i] / n
        yield i, "links:none" if share < 0.05 else "links:some" if share < 0.5 else "links:most"
        yield i, "ends:sentence" if text[-1] in ".!?…:\"'”»)" else "ends:other"
        kind = _kind(page.tag[i])
        yield i, f"in:{kind}" if kind in ("p", "h", "li") else "in:other"


@dataclass
class Forest:
    """Many pages as one set of arrays, by depth, so that messages pass in whole levels."""

    parent: np.ndarray
    child_kind: np.ndarray
    levels: list[np.ndarray]
    rows: np.ndarray
    columns: np.ndarray

    @classmethod
    def of(cls, pages: Sequence[Page], hidden: Sequence[bool] | None = None) -> Forest:
        parent, depth, kind, rows, columns = [], [], [], [], []
        for k, page in enumerate(pages):
            base = len(parent)
            parent += [p + base if p >= 0 else -1 for p in page.parent]
            depth += page.depth
            kind += [0 if t is None else 1 for t in page.texts]
            for i, name in _features(page, bool(hidden and hidden[k])):
                rows.append(base + i)
                columns.append(FEATURES[name])
        at = np.array(depth, np.int64)
        order = np.argsort(at, kind="stable")
        edges = np.searchsorted(at[order], np.arange(1, at.max(initial=0) + 1))
        levels = np.split(order, edges)
        return cls(np.array(parent, np.int64), np.array(kind, np.int64), levels, np.array(rows, np.int64), np.array(columns, np.int64))

    def marginals(self, weights: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum-product: P(node is content), and per node the table P(parent's state, its state)."""
        n = len(self.parent)
        own = np.zeros((n, 2))
        own[:, 1] = np.bincount(self.rows, weights[self.columns], n)
        up = np.zeros((n, 2))
        for level in reversed(self.levels[1:]):
            up[level] = np.logaddexp.reduce(own[level][:, None, :] + pairs[self.child_kind[level]], axis=2)
            np.add.at(own, self.parent[level], up[level])
        joint = np.zeros((n, 2, 2))
        full = own.copy()
        for level in self.levels[1:]:
            rest = full[self.parent[level]] - up[level]
            table = rest[:, :, None] + pairs[self.child_kind[level]]
            full[level] = own[level] + np.logaddexp.reduce(table, axis=1)
            table = table + own[level][:, None, :]
            table -= np.logaddexp.reduce(table.reshape(len(level), 4), axis=1)[:, None, None]
            joint[level] = np.exp(table)
        return 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -500, 500))), joint


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    pairs: np.ndarray


def prior_model() -> Model:
    return Model(np.array(list(PRIOR.values())), PAIR_PRIOR.copy())


def labels(page: Page) -> np.ndarray | None:
    """Content is what lies in the page's own article or main element, but in none of its other
    parts; a page without one is not labelled."""
    marks = [i for i, t in enumerate(page.tag) if page.texts[i] is None and t in GOOD_TAGS]
    if not marks:
        return None
    inside = np.zeros(len(page.parent), bool)
    for i, p in enumerate(page.parent):
        inside[i] = (p >= 0 and inside[p]) or (page.texts[i] is None and page.tag[i] in GOOD_TAGS)
    return inside & ~np.array(other_parts(page))


def fit(htmls: Sequence[str], rounds: int = 60, rate: float = 0.3, belief: float = 0.02) -> Model:
    """Train on the pages that label themselves."""
    model = prior_model()
    labelled = [(page, y) for page in map(parse, htmls) if (y := labels(page)) is not None]
    if not labelled:
        return model
    forest = Forest.of([p for p, _ in labelled], [k % 2 == 1 for k in range(len(labelled))])
    y = np.concatenate([y for _, y in labelled]).astype(int)
    child = np.concatenate([level for level in forest.levels[1:]] or [np.zeros(0, int)])
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (forest.child_kind[child], y[forest.parent[child]], y[child]), 1)
    weights, pairs = model.weights.copy(), model.pairs.copy()
    speed_w, speed_p = np.full(len(weights), 1e-6), np.full(pairs.shape, 1e-6)
    size = len(labelled)
    for _ in range(rounds):
        p, joint = forest.marginals(weights, pairs)
        gap = np.bincount(forest.columns, (y - p)[forest.rows], len(weights)) / size - belief * (weights - model.weights)
        expected = np.stack([joint[child][forest.child_kind[child] == k].sum(0) for k in (0, 1)])
        pair_gap = (seen - expected) / size - belief * (pairs - model.pairs)
        speed_w += gap**2
        speed_p += pair_gap**2
        weights += rate * gap / np.sqrt(speed_w)
        pairs += rate * pair_gap / np.sqrt(speed_p)
    return Model(weights, pairs)


def main_texts(htmls: Sequence[str], model: Model) -> list[str]:
    """The content blocks of each page, one per line."""
    pages = [parse(x) for x in htmls]
    p, _ = Forest.of(pages).marginals(model.weights, model.pairs)
    out, base = [], 0
    for page in pages:
        out.append("\n".join(t for i, t in enumerate(page.texts) if t is not None and p[base + i] > 0.5))
        base += len(page.parent)
    return out


def training_pages(pages: DataFrame, most: int = TRAIN_PAGES, chars: int = TRAIN_CHARS) -> list[str]:
    """At most ``most`` pages of at most ``chars`` characters that mark their article, by a hash of id and html.

    The smallest hashes are found first, so tasks hand the driver numbers, and then only the chosen pages.
    """
    html = F.col("html").cast("string")
    place = F.xxhash64(F.col("page_id").cast("string"), html)
    marked = pages.where(html.rlike("(?i)<(?:article|main)[ >]") & (F.length(html) <= chars))
    marked = marked.select(place.alias("place"), html.alias("html"))
    last = marked.select("place").orderBy("place").limit(most).agg(F.max("place")).first()[0]
    if last is None:
        return []
    chosen = marked.where(F.col("place") <= last).limit(most).collect()
    return [row.html for row in sorted(chosen)]


def _extracting(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in bytewise(batches, "_html", 2 << 20):
            texts = main_texts([x or "" for x in batch.column("_html").to_pylist()], model)
            names = [n for n in batch.schema.names if n != "_html"]
            arrays = [*(batch.column(n) for n in names), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "text", "n_chars"])

    return run


def extract(pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), model: Model | None = None) -> DataFrame:
    """``keep``, the main ``text`` and its ``n_chars`` of every row of ``pages`` (column ``html``)."""
    model = model or fit(training_pages(pages))
    taken = pages.select(*keep, F.col("html").cast("string").alias("_html"))
    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.select(*keep).schema)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    return taken.mapInArrow(_extracting(shared), own + "text string, n_chars bigint")
