"""Main text of web pages by a tree-structured graphical model.

A page becomes the tree of its block elements, with the runs of text between them as leaves. Every node is content or not.
The model multiplies one potential for every parent and child, by the kinds of both and what the child's class and id say, and two
for every run of text: how much of it is in links, and how long it is. All are estimated by counting on labelled pages. A pair of
kinds that was never or seldom counted weighs as a general rule says: what stands below a node has its label; only an article, or
what calls itself one, begins content below a node that is not; furniture ends it, and below furniture nothing begins. So a paragraph is content because of where it
stands, not because paragraphs usually are; where no element marks the article, several long texts side by side can outweigh the
rule. Messages pass once from the leaves to the root and once back, which gives the exact marginal of every node; the text runs
above one half are the main text.

Labelled pages are those that mark their article with an ``article`` or ``main`` element: nodes inside it are content, but
for what stands in an element or class of a fixed list of page furniture; all else is not.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import pick, pieces

#: Labelled pages that the potentials are counted on, chosen by hash of their id.
SAMPLE = 3000
#: Pseudo-count of the general rules, and of each value of a text's features.
BELIEF, PRIOR = 20.0, 0.5
#: The rules: how likely content begins below a node that is not content: at an article, at what calls itself one, at anything else, and
#: at furniture; and how likely it goes on below content, at anything but furniture. Below furniture, it begins at an article as elsewhere at anything else.
MAIN_BEGINS, BEGINS, STARTS, NEVER, GOES_ON = 1 - 1e-15, 0.5, 0.002, 1e-250, 1 - 1e-6
#: Share of a text's features that is chance, and as how many texts those side by side in one element weigh at most: they are much
#: alike, and together they must not overrule an article or furniture.
CHANCE, TOGETHER = 0.3, 4

# Elements of HTML and words that sites use in class and id attributes.
RAW = {"script", "style", "textarea", "title", "template", "iframe", "svg", "select"}
#: Elements with text of their own that stand inside paragraphs as well.
INNER = {"noscript", "object"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "head", *RAW}
MAIN = {"article", "main"}
BLOCKS = {"html", "body", "div", "section", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead",
          "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure", "figcaption", "address", "fieldset", "details",
          "summary", "hr", "center", *INNER, *FURNITURE, *MAIN}
VOID = {"hr", "br", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
SAYS_FURNITURE = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "cookie", "cookies", "consent", "notice",
                  "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "aside", "widget",
                  "related", "recommended", "share", "social", "comment", "comments", "reply", "replies", "respond", "disqus", "newsletter",
                  "subscribe", "signup", "login", "search", "popup", "modal", "legal", "copyright", "pagination", "pager", "toolbar"}
SAYS_CONTENT = {"article", "content", "post", "entry", "story", "main", "body", "text"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")
TEXT = "#text"
KINDS = [TEXT, *sorted(BLOCKS)]
KIND_AT = {k: i for i, k in enumerate(KINDS)}
SAYS = ("nothing", "furniture", "content")
LINKED, LENGTHS = 4, 8


def _says(attributes: str) -> int:
    parts = {p for found in _NAMED.findall(attributes) for p in _PART.findall("".join(found).lower())}
    return 1 if parts & SAYS_FURNITURE else 2 if parts & SAYS_CONTENT else 0


class Page:
    """Tree of one page. Node 0 is the page itself."""

    def __init__(self, source: str):
        self.kind, self.parent, self.says, self.length, self.linked, self.text = [KIND_AT["html"]], [-1], [0], [0], [0], [""]
        stack, links, run, at = [("html", 0)], 0, [], 0

        def flush():
            whole = " ".join(entities.unescape("".join(t for t, _ in run)).split())
            if whole:
                self._add(KIND_AT[TEXT], stack[-1][1], 0, whole, sum(len(t) for t, link in run if link) / sum(len(t) for t, _ in run))
            run.clear()

        find = _TAG.search
        while True:
            m = find(source, at)
            if m is None:
                run.append((source[at:], links > 0))
                break
            if m.start() > at:
                run.append((source[at:m.start()], links > 0))
            at = m.end()
            if not m[2]:
                continue
            name, closing = m[2].lower(), m[1] == "/"
            if name == "a":
                links = max(0, links + (-1 if closing else 1))
            elif name == "br":
                run.append((" ", False))
            elif name in BLOCKS:
                flush()
                links = 0
                if closing:
                    self._close(stack, name)
                    continue
                if name not in INNER:
                    self._implied(stack, name)
                node = self._add(KIND_AT[name], stack[-1][1], _says(m[3]) if m[3] else 0, "", 0)
                if name == "svg" and m[3].endswith("/"):
                    continue
                if name in RAW:
                    end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = end.end() if end else len(source)
                elif name not in VOID:
                    stack.append((name, node))
            elif name in RAW or name in VOID or closing:
                continue
        flush()

    def _add(self, kind: int, parent: int, says: int, text: str, linked: float) -> int:
        for column, value in ((self.kind, kind), (self.parent, parent), (self.says, says), (self.length, len(text)), (self.linked, linked),
                              (self.text, text)):
            column.append(value)
        return len(self.kind) - 1

    @staticmethod
    def _close(stack: list, name: str) -> None:
        """Ends the innermost open element of this name; an end tag without one is ignored."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == name:
                del stack[k:]
                return

    @staticmethod
    def _implied(stack: list, name: str) -> None:
        """Ends what the start of this element ends: an open paragraph, list item, cell or row."""
        if stack[-1][0] == "p":
            stack.pop()
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in SCOPES.get(name, ()) or name not in CLOSES:
                return
            if stack[k][0] in CLOSES[name]:
                del stack[k:]
                return


class Forest:
    """The trees of several pages as arrays, parents before children."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.kind) for p in pages])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int)
        join = lambda name: np.array([x for p in pages for x in getattr(p, name)])
        self.kind, self.says, own = join("kind"), join("says"), join("length").astype(float)
        self.page = np.repeat(np.arange(len(pages)), sizes)
        self.parent = join("parent")
        inner = self.parent >= 0
        self.parent[inner] += np.repeat(starts, sizes)[inner]
        depth = np.zeros(len(self.parent), int)
        for p, s in zip(pages, starts):
            d = [0] * len(p.kind)
            for k in range(1, len(d)):
                d[k] = d[p.parent[k]] + 1
            depth[s:s + len(d)] = d
        self.levels = [np.nonzero(depth == k)[0] for k in range(depth.max() + 1)] if len(depth) else []
        #: Nodes below a piece of furniture, whatever they are themselves. What a whole page calls itself does not count.
        out = (np.isin(self.kind, [KIND_AT[k] for k in FURNITURE]) | (self.says == 1)) & ~np.isin(self.kind, [KIND_AT["html"], KIND_AT["body"]])
        self.under = np.zeros(len(out), bool)
        for level in self.levels[1:]:
            self.under[level] = (self.under | out)[self.parent[level]]
        linked = join("linked") * own
        for level in self.levels[:0:-1]:
            np.add.at(own, self.parent[level], own[level])
            np.add.at(linked, self.parent[level], linked[level])
        self.link = np.minimum((linked / np.maximum(own, 1)) * LINKED, LINKED - 1).astype(int)
        self.size = np.minimum(np.log2(own + 1) / 2, LENGTHS - 1).astype(int)

    def labels(self, pages: list[Page]) -> np.ndarray:
        """1 for content, 0 for not, -1 for pages that do not mark their article."""
        main = np.isin(self.kind, [KIND_AT[k] for k in MAIN])
        furniture = np.isin(self.kind, [KIND_AT[k] for k in FURNITURE]) | (self.says == 1)
        inside = main.copy()
        marked = np.zeros(len(pages), bool)
        marked[self.page[main]] = True
        for level in self.levels[1:]:
            inside[level] |= inside[self.parent[level]]
            inside[level] &= ~furniture[level]
            furniture[level] |= furniture[self.parent[level]]
        return np.where(marked[self.page], inside & ~furniture, -1).astype(int)


def _rules() -> np.ndarray:
    """What is known of the child's label by the parent's label, the child's kind and what its class and id say."""
    furniture, main = (np.isin(np.arange(len(KINDS)), [KIND_AT[k] for k in kinds]) for kinds in (FURNITURE, MAIN))
    content = np.empty((2, len(KINDS), len(SAYS)))
    for says in range(len(SAYS)):
        out = furniture | (says == 1)
        content[0, :, says] = np.where(out, NEVER, np.where(main, MAIN_BEGINS, BEGINS if says == 2 else STARTS))
        content[1, :, says] = np.where(out, NEVER, GOES_ON)
    return np.stack([1 - content, content], axis=3)


class Potentials:
    """Potentials from counts: ``edge`` by parent's label and kind, child's kind, what it says, and label; ``link`` and ``size`` by label."""

    def __init__(self):
        self.edge = np.zeros((2, len(KINDS), len(KINDS), len(SAYS), 2))
        self.link = np.full((2, LINKED), PRIOR)
        self.size = np.full((2, LENGTHS), PRIOR)
        self.root = np.array([1 - STARTS, STARTS])

    def count(self, forest: Forest, label: np.ndarray) -> None:
        known = np.nonzero((label >= 0) & (forest.parent >= 0))[0]
        above = forest.parent[known]
        np.add.at(self.edge, (label[above], forest.kind[above], forest.kind[known], forest.says[known], label[known]), 1)
        texts = known[forest.kind[known] == KIND_AT[TEXT]]
        for table, value in ((self.link, forest.link), (self.size, forest.size)):
            np.add.at(table, (label[texts], value[texts]), 1)

    def steps(self, forest: Forest) -> np.ndarray:
        """For every node but the roots the potential of (parent's label, own label)."""
        above = forest.parent
        counted = self.edge[:, forest.kind[above], forest.kind, forest.says].transpose(1, 0, 2)
        rule = _rules()[:, forest.kind, forest.says].transpose(1, 0, 2)
        begins = np.where(np.isin(forest.kind, [KIND_AT[k] for k in MAIN]), STARTS, NEVER)[forest.under]
        rule[forest.under, 0] = np.stack([1 - begins, begins], axis=1)
        return (counted + BELIEF * rule) / (counted.sum(2, keepdims=True) + BELIEF)

    def alone(self, forest: Forest) -> np.ndarray:
        """For every node the potential of its own label: of texts by their features, of elements none."""
        out = np.ones((len(forest.kind), 2))
        texts = np.nonzero(forest.kind == KIND_AT[TEXT])[0]
        around = forest.parent[np.maximum(forest.parent[texts], 0)]
        weight = np.minimum(1, TOGETHER / np.bincount(np.where(around < 0, len(out), around), minlength=len(out) + 1)[np.where(around < 0, len(out), around)])
        for table, value in ((self.link, forest.link), (self.size, forest.size)):
            share = (1 - CHANCE) * table / table.sum(1, keepdims=True) + CHANCE / table.shape[1]
            out[texts] *= share[:, value[texts]].T ** weight[:, None]
        return out

    def marginals(self, forest: Forest) -> np.ndarray:
        """Probability that each node is content, by messages up and down the trees."""
        step, alone = np.log(self.steps(forest)), np.log(self.alone(forest))
        below, up = alone.copy(), np.zeros_like(alone)
        for level in forest.levels[:0:-1]:
            for above in (0, 1):
                both = step[level, above] + below[level]
                up[level, above] = np.logaddexp(both[:, 0], both[:, 1])
            np.add.at(below, forest.parent[level], up[level])
        whole = np.zeros_like(alone)
        if forest.levels:
            roots = forest.levels[0]
            whole[roots] = below[roots] + np.log(self.root)
        for level in forest.levels[1:]:
            rest = whole[forest.parent[level]] - up[level]
            for own in (0, 1):
                from_above = rest + step[level, :, own]
                whole[level, own] = np.logaddexp(from_above[:, 0], from_above[:, 1]) + below[level, own]
        return 1 / (1 + np.exp(np.clip(whole[:, 0] - whole[:, 1], -700, 700)))


TABLES = ("edge", "link", "size")


def _count(batches):
    total = Potentials()
    fresh = Potentials()
    for batch in pieces(batches, 200):
        pages = [Page(x or "") for x in batch.column("html").to_pylist()]
        forest = Forest(pages)
        total.count(forest, forest.labels(pages))
    for name in TABLES:
        n = (getattr(total, name) - getattr(fresh, name)).ravel()
        at = np.nonzero(n > 0.5)[0]
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at])], names=["potential", "at", "n"])


def train(pages: DataFrame) -> Potentials:
    """Potentials counted on at most SAMPLE pages that mark their article (columns page_id and html; a null id is told by the html)."""
    seen = F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script|<style\b.*?</style", "")
    mark = F.when(F.col("page_id").isNull(), F.xxhash64("html")).otherwise(F.xxhash64("page_id"))
    labelled = pages.where(seen.rlike(r"(?i)<(article|main)([\s/>]|$)")).select(mark.alias("mark"), "html")
    chosen = labelled.select("mark").distinct().orderBy("mark").limit(SAMPLE)
    counts = (labelled.join(chosen, "mark", "left_semi").dropDuplicates(["mark", "html"]).select("html").mapInArrow(_count, "potential string, at long, n double")
              .groupBy("potential", "at").agg(F.sum("n").alias("n")).collect())
    model = Potentials()
    for r in counts:
        getattr(model, r["potential"]).ravel()[r["at"]] += r["n"]
    return model


def _extract(model: Potentials):
    def run(batches):
        for batch in pieces(batches, 200):
            pages = [Page(x or "") for x in batch.column("html").to_pylist()]
            texts = []
            if pages:
                forest = Forest(pages)
                good = (model.marginals(forest) > 0.5) & (forest.kind == KIND_AT[TEXT])
                start = 0
                for page in pages:
                    size = len(page.kind)
                    texts.append("\n".join(page.text[k] for k in np.nonzero(good[start:start + size])[0]))
                    start += size
            yield batch.drop_columns(["html"]).append_column("text", pa.array(texts, pa.string()))
    return run


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of all pages: the text of the blocks whose marginal is above one half, in page order.

    A null page is an empty one; a page without content gives an empty text. Unclosed and misnested elements, open comments and
    raw elements without an end are read as far as they go. Repeated rows give equal rows; null ids and urls stay null; extra
    columns do not matter; an empty table gives an empty result.
    """
    pages = pick(pages, "page_id", "url", "html")
    model = train(pages)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return (pages.mapInArrow(_extract(model), f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
