"""Main text of web pages by a tree-structured graphical model.

The elements of a page that make blocks are the nodes of a tree; each is main
content or not.  A node has a potential of its features (tag, words of its
class, id and role, share of linked text, length of its text), and every
parent and child share a potential.  Sum-product messages go up from the leaves
and down from the root once, which is exact on a tree, and give the marginal
of every node; a block of text stays when the marginal of its element is 1/2
or more.

Training takes at most MAX_PAGES pages, the first by a hash of their id, that
label themselves: exactly one ``article`` or ``main`` element.  What is inside
it is content, save for parts that are marked as something else (EXCLUDED tags
or BOILERPLATE words).  Node weights are fitted by logistic regression around
prior weights that speak for tags and words a sample may lack, edge potentials
by counting.

Scale: parsing, inference and the result are one pass without a shuffle; all
trees of an Arrow batch are worked together, level by level.

Cases: a null or empty page, or one without content, has an empty text and 0
characters; open tags, stray ends and cut pages are read as browsers read
them; without labelled pages the prior weights decide; an empty table gives an
empty result; repeated rows get equal results; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, table

MAX_PAGES = 2_000

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea title noembed noframes svg annotation annotation-xml canvas audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr "
                   # text of formulas, and text for readers without scripts or plug-ins
                   "math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mtable mtr mtd mstyle "
                   "mspace mpadded mphantom menclose merror semantics noscript object".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = frozenset("ul ol dl table td th select article section div main body html".split())
# What is not main text, by tag and by words of class, id and role.
EXCLUDED = frozenset("nav aside header footer form button select dialog menu".split())
BOILERPLATE = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent "
                        "contentinfo cookie cookies copyright discussion disqus feedback footer form gdpr header hidden login masthead "
                        "menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup "
                        "promo promoted promotion rail recommended related replies reply respond search share sharing sidebar signup "
                        "skip social sponsor sponsored subscribe subscription tags teaser toolbar topbar widget widgets".split())
CONTENT = frozenset("article body content entry main post story text".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)""", re.S)
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?false)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

# Fixed features and their prior weights.
TAGS = ("html", "body", "div", "section", "article", "main", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd",
        "table", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "nav", "aside", "header", "footer", "form", "button",
        "select", "dialog", "menu", "label", "fieldset", "other")
MARKS = ("boilerplate_word", "content_word", "hidden", "linked_none", "linked_some", "linked_most", "text_none", "text_short", "text_long",
         "inside_excluded", "inside_content")
FEATURES = {n: i for i, n in enumerate(("bias", *(f"<{t}>" for t in TAGS), *MARKS))}
PRIOR = {"bias": -0.5, "<article>": 3.0, "<main>": 3.0, "<p>": 0.5, "<h1>": 0.5, "<h2>": 0.3, "<blockquote>": 0.5, "<pre>": 0.5,
         "boilerplate_word": -9.0, "content_word": 2.0, "hidden": -9.0, "inside_excluded": -9.0, "inside_content": 1.0, "linked_most": -2.0, "linked_none": 0.3, "text_long": 1.0,
         "<body>": -0.5, "<html>": -0.5} | {f"<{t}>": -9.0 for t in EXCLUDED}
EDGE_PRIOR = np.array([[12.0, 3.0], [1.0, 12.0]])  # counts of (parent, child) states before any page is seen
EDGE_CLIP = 2.5


class Page:
    """Nodes (block elements) and text blocks of one page, in page order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.marks, self.hidden = [-1], ["html"], [frozenset()], [False]
        self.blocks: list[tuple[int, list[str]]] = []   # owner and its pieces of text
        self.linked: list[int] = []                     # characters inside links, by block
        stack: list[tuple[str, int]] = [("html", 0)]    # open elements and the node each belongs to
        links, fresh, skip_to = 0, True, 0
        place = 0

        def text(piece: str) -> None:
            nonlocal fresh
            if not piece:
                return
            if fresh:
                if piece.isspace():
                    return
                self.blocks.append((stack[-1][1], []))
                self.linked.append(0)
                fresh = False
            decoded = html.unescape(piece) if "&" in piece else piece
            self.blocks[-1][1].append(decoded)
            if links:
                self.linked[-1] += len(decoded)

        def pop(count: int) -> None:
            nonlocal links, fresh
            for _ in range(count):
                name, node = stack.pop()
                if name == "a":
                    links -= 1
                if node != stack[-1][1]:
                    fresh = True

        for m in _TOKEN.finditer(source):
            if m.start() < skip_to:
                continue
            text(source[place:m.start()])
            place = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue  # comment, declaration or processing instruction
            if m[1] or m[4]:
                self._end(name, stack, pop)
                if name not in INLINE:
                    fresh = True
                continue
            attributes = m[3] or m[6] or ""
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, m.end())
                if not attributes.rstrip().endswith("/") or name not in ("svg", "math"):
                    place = skip_to = end.end() if end else len(source)
                continue
            if name in VOID:
                if name in INLINE:
                    text(" ")
                else:
                    fresh = True
                continue
            if name in ("html", "body", "head"):
                if name == "body":
                    self.marks[0] |= self._words(attributes)
                fresh = True
                continue
            self._imply_ends(name, stack, pop)
            words = self._words(attributes)
            hidden = bool(_HIDDEN.search(attributes))
            if name in INLINE and not hidden and not words & BOILERPLATE:
                stack.append((name, stack[-1][1]))
                links += name == "a"
                continue
            self.parent.append(stack[-1][1])
            self.tag.append(name)
            self.marks.append(words)
            self.hidden.append(hidden)
            stack.append((name, len(self.tag) - 1))
            links += name == "a"
            fresh = True
        text(source[place:] if place >= skip_to else "")
        self.texts = [" ".join("".join(pieces).split()) for _, pieces in self.blocks]

    @staticmethod
    def _words(attributes: str) -> frozenset:
        found: set[str] = set()
        for m in _MARKS.finditer(attributes):
            found.update(w.lower() for w in _PARTS.findall(m[1] or m[2] or m[3] or ""))
        return frozenset(found)

    @staticmethod
    def _end(name: str, stack: list, pop) -> None:
        """Close the nearest open ``name``; an inline end does not close blocks."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] == name:
                pop(len(stack) - depth)
                return
            if name in INLINE and stack[depth][0] not in INLINE:
                return

    @staticmethod
    def _imply_ends(name: str, stack: list, pop) -> None:
        """A new block ends an open paragraph, an item ends the one before."""
        ends = SAME_ENDS.get(name)
        if name in ENDS_P or ends:
            for depth in range(len(stack) - 1, 0, -1):
                open_name = stack[depth][0]
                if open_name == "p" and name in ENDS_P or ends and open_name in ends or \
                        open_name in ("h1", "h2", "h3", "h4", "h5", "h6") and name in ("h1", "h2", "h3", "h4", "h5", "h6"):
                    pop(len(stack) - depth)
                    return
                if open_name in SCOPE:
                    return


class Forest:
    """The nodes of many pages, with their features and levels."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.tag) for p in pages]
        self.first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        n = int(self.first[-1])
        self.parent = np.full(n, -1, np.int64)
        self.level = np.zeros(n, np.int64)
        rows, columns = [], []
        for page, lo in zip(pages, self.first.tolist()):
            own, linked = [0] * len(page.tag), [0] * len(page.tag)
            for (node, _), text, link in zip(page.blocks, page.texts, page.linked):
                own[node] += len(text)
                linked[node] += link
            whole, whole_linked = own[:], linked[:]
            for k in range(len(page.tag) - 1, 0, -1):
                whole[page.parent[k]] += whole[k]
                whole_linked[page.parent[k]] += whole_linked[k]
            above: list[tuple[bool, bool]] = []  # is, or is inside, an excluded part; content
            for k, tag in enumerate(page.tag):
                excluded, content = above[page.parent[k]] if k else (False, False)
                above.append((excluded or tag in EXCLUDED or bool(page.marks[k] & BOILERPLATE) or page.hidden[k],
                              content or tag in ("article", "main") or bool(k and page.marks[k] & CONTENT)))
                if k:
                    self.parent[lo + k] = lo + page.parent[k]
                    self.level[lo + k] = self.level[lo + page.parent[k]] + 1
                share = whole_linked[k] / whole[k] if whole[k] else 0.0
                names = ["bias", f"<{tag}>" if f"<{tag}>" in FEATURES else "<other>",
                         "linked_none" if share < 0.1 else "linked_some" if share < 0.5 else "linked_most",
                         "text_none" if not own[k] else "text_short" if own[k] < 80 else "text_long"]
                if page.marks[k] & BOILERPLATE:
                    names.append("boilerplate_word")
                elif page.marks[k] & CONTENT:
                    names.append("content_word")
                if page.hidden[k]:
                    names.append("hidden")
                if excluded:
                    names.append("inside_excluded")
                elif content:
                    names.append("inside_content")
                rows += [lo + k] * len(names)
                columns += [FEATURES[x] for x in names]
        self.rows, self.columns = np.array(rows, np.int64), np.array(columns, np.int64)
        order = np.argsort(self.level, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(self.level))[:-1]) if n else []

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.columns], len(self.parent))


class Model:
    def __init__(self) -> None:
        self.w = np.zeros(len(FEATURES))
        for name, x in PRIOR.items():
            self.w[FEATURES[name]] = x
        self.edge = _edge_potential(np.zeros((2, 2)))

    def fit(self, forest: Forest, y: np.ndarray, rounds: int = 300, rate: float = 0.3, ridge: float = 0.002) -> None:
        """``y``: 1 content, 0 not, -1 unknown, of every node."""
        known = y >= 0
        if not known.any():
            return
        prior, scale = self.w.copy(), np.full_like(self.w, 1e-8)
        count = known.sum()
        for _ in range(rounds):
            off = np.where(known, 1 / (1 + np.exp(-np.clip(forest.scores(self.w), -50, 50))) - y, 0.0) / count
            grad = np.bincount(forest.columns, off[forest.rows], len(self.w)) + ridge * (self.w - prior)
            scale += grad * grad
            self.w -= rate * grad / np.sqrt(scale)
        child = np.flatnonzero((forest.parent >= 0) & known & (y[forest.parent] >= 0))
        counts = np.zeros((2, 2))
        np.add.at(counts, (y[forest.parent[child]], y[child]), 1.0)
        self.edge = _edge_potential(counts)

    def marginals(self, forest: Forest) -> np.ndarray:
        """Probability of content of every node, by one sweep up and one down."""
        n = len(forest.parent)
        own = np.stack([np.zeros(n), forest.scores(self.w)], axis=1)
        up = np.zeros((n, 2))       # message of a node to its parent
        belief = own.copy()         # own potential and the messages of the children
        for nodes in forest.levels[:0:-1]:
            m = _log_sum(belief[nodes][:, None, :] + self.edge[None])  # over the child's state
            up[nodes] = m
            np.add.at(belief, forest.parent[nodes], m)
        for nodes in forest.levels[1:]:
            parent = forest.parent[nodes]
            m = _log_sum((belief[parent] - up[nodes])[:, None, :] + self.edge.T[None])  # over the parent's state
            belief[nodes] += m
        return 1 / (1 + np.exp(-np.clip(belief[:, 1] - belief[:, 0], -500, 500)))


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=2)
    out = top + np.log(np.exp(x - top[:, :, None]).sum(axis=2))
    return out - out.max(axis=1, keepdims=True)


def _edge_potential(counts: np.ndarray) -> np.ndarray:
    """log P(child | parent) - log P(child), rows by the parent's state, clipped."""
    share = EDGE_PRIOR + counts * (EDGE_PRIOR.sum() * 4 / max(counts.sum(), 1.0))
    given = share / share.sum(axis=1, keepdims=True)
    return np.clip(np.log(given / (share.sum(axis=0) / share.sum())), -EDGE_CLIP, EDGE_CLIP)


def self_labels(page: Page) -> list[int] | None:
    """Labels of the nodes of a page with exactly one ``article`` or ``main``; None for other pages."""
    roots = [k for k, t in enumerate(page.tag) if t in ("article", "main")]
    if len(roots) == 2 and page.tag[roots[0]] == "main" and page.parent[roots[1]] == roots[0]:
        roots = roots[1:]
    if len(roots) != 1:
        return None
    out = [0] * len(page.tag)
    for k in range(1, len(page.tag)):
        inside = k == roots[0] or out[page.parent[k]] == 1
        out[k] = int(inside and page.tag[k] not in EXCLUDED and not page.marks[k] & BOILERPLATE and not page.hidden[k])
    return out


def train(pages: DataFrame) -> Model:
    ids = (pages.filter("page_id is not null and html is not null").select(F.col("page_id").alias("id")).distinct()
           .orderBy(F.xxhash64("id"), "id").limit(MAX_PAGES))
    rows = pages.join(F.broadcast(ids), F.col("page_id") == F.col("id")).select("page_id", "html")
    model = Model()
    parts = map_arrow(rows, _sample, "page_id long, parent array<int>, level array<int>, size int, features array<int>, at array<int>, y array<int>",
                      text="html").toArrow().sort_by([("page_id", "ascending")]).to_pylist()
    if parts:
        model.fit(*_joined(parts))
    return model


def _sample(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Features and labels of the pages that label themselves."""
    out: list[dict] = []
    for page_id, source in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist()):
        page = Page(source or "")
        y = self_labels(page)
        if y is not None:
            f = Forest([page])
            out.append({"page_id": page_id, "parent": f.parent.tolist(), "level": f.level.tolist(), "size": len(f.parent),
                        "features": f.columns.tolist(), "at": f.rows.tolist(), "y": y})
    kinds = pa.schema([("page_id", pa.int64()), ("parent", pa.list_(pa.int32())), ("level", pa.list_(pa.int32())), ("size", pa.int32()),
                       ("features", pa.list_(pa.int32())), ("at", pa.list_(pa.int32())), ("y", pa.list_(pa.int32()))])
    return pa.RecordBatch.from_pylist(out, schema=kinds)


def _joined(parts: list[dict]) -> tuple[Forest, np.ndarray]:
    forest = Forest([])
    first = np.concatenate(([0], np.cumsum([p["size"] for p in parts]))).astype(np.int64)
    join = lambda key, shift: np.concatenate([np.array(p[key], np.int64) + (lo if shift else 0) for p, lo in zip(parts, first)])
    parent = [np.where(np.array(p["parent"]) < 0, -1, np.array(p["parent"]) + lo) for p, lo in zip(parts, first)]
    forest.parent, forest.rows, forest.columns = np.concatenate(parent), join("at", True), join("features", False)
    return forest, join("y", False)


def main_texts(sources: list[str | None], model: Model) -> Iterator[str]:
    pages = [Page(s or "") for s in sources]
    forest = Forest(pages)
    content = model.marginals(forest) >= 0.5
    for page, lo in zip(pages, forest.first.tolist()):
        yield "\n".join(t for (node, _), t in zip(page.blocks, page.texts) if t and content[lo + node])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row of ``pages``."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    model = train(rows)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = list(main_texts(batch.column("html").to_pylist(), model))
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])

    return map_arrow(rows, step, f"page_id long, url {pages.schema['url'].dataType.simpleString()}, text string, n_chars long", text="html")


def op5_main_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
