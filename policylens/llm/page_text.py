"""Main text of web pages: a tree-structured graphical model over DOM nodes, read by sum-product messages.

Each node of a page is content or not. Its own evidence (element, words of its
attributes, length, links, punctuation) gives a potential, each edge from
parent to child another. One pass of messages up the tree and one down give
exact marginals; text blocks whose marginal reaches a half are the main text.
All weights are fitted by maximum likelihood on labelled pages; the gradient is
what the labels hold less what the marginals expect.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policylens.llm.page_dom import HINT, TAG, TAGS, Tree, parse
from policylens.llm.page_samples import PAGES

LENGTHS, SHARES, LINKS, ENDINGS = (15, 40, 100, 250), (0.02, 0.1, 0.3, 0.6, 0.9), (0.01, 0.3, 0.7), ".!?…:;。"
WIDTH = len(TAGS) + len(HINT) + 2 * (len(LENGTHS) + 1) + 2 * (len(SHARES) + 1) + 2 * (len(LINKS) + 1) + 4
#: Kinds of edges by the child: a text block, a paragraph-like element, another element.
FLOW = np.isin(np.arange(len(TAGS)), [TAG[t] for t in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "tbody", "tr", "td", "th", "blockquote", "pre",
                                                       "figure", "figcaption", "table")])
#: Elements whose names speak of content or of its surroundings; in half of the training pages they are plain ``div``.
SPEAKING = np.isin(np.arange(len(TAGS)), [TAG[t] for t in ("article", "main", "nav", "header", "footer", "aside", "form", "section", "address")])


@dataclass(frozen=True)
class Training:
    """pages: labelled pages taken from the table at most. longest: characters of such a page at most. steps, rate, decay: of the ascent."""

    pages: int = 128
    longest: int = 50_000
    steps: int = 150
    rate: float = 0.1
    decay: float = 1e-3


@dataclass
class Forest:
    """The trees of several pages in one array a column; nodes of one depth are computed together."""

    parent: np.ndarray
    tag: np.ndarray
    hint: np.ndarray
    depth: np.ndarray
    label: np.ndarray
    features: np.ndarray

    def levels(self) -> list[np.ndarray]:
        """Nodes of each depth from the root's children on."""
        order = np.argsort(self.depth, kind="stable")
        return np.split(order, np.searchsorted(self.depth[order], np.arange(1, int(self.depth.max(initial=0)) + 1)))[1:]

    def kinds(self) -> np.ndarray:
        return np.where(self.tag == TAG["#text"], 0, np.where(FLOW[self.tag], 1, 2))


def forest(trees: list[Tree]) -> Forest:
    start = np.cumsum([0] + [len(t.parent) for t in trees])
    page = np.repeat(np.arange(len(trees)), np.diff(start))
    col = lambda name: np.array([x for t in trees for x in getattr(t, name)], np.int64)
    parent, tag, hint, depth, label = (col(c) for c in ("parent", "tag", "hint", "depth", "label"))
    parent = np.where(parent < 0, -1, parent + start[page])
    own = np.array([len(x) for t in trees for x in t.text], np.float64)
    ends = np.array([x[-1:] in ENDINGS and x != "" for t in trees for x in t.text])
    marks = np.array([x.count(",") + x.count(".") for t in trees for x in t.text], np.float64)
    rights = np.array(["©" in x or "(c)" in x for t in trees for x in t.text])
    f = Forest(parent, tag, hint, depth, label, np.zeros((len(parent), WIDTH), np.float32))
    size, linked, blocks = own.copy(), col("linked").astype(np.float64), (own > 0).astype(np.float64)
    for nodes in reversed(f.levels()):
        for total in (size, linked, blocks):
            np.add.at(total, parent[nodes], total[nodes])
    x, rows, leaf = f.features, np.arange(len(parent)), tag == TAG["#text"]
    at = len(TAGS)
    x[rows, tag] = 1
    x[:, at:at + len(HINT)] = hint[:, None] >> np.arange(len(HINT)) & 1
    at += len(HINT)
    links = np.digitize(linked / np.maximum(size, 1), LINKS)
    mean = np.digitize(size / np.maximum(blocks, 1), LENGTHS)
    share = np.digitize(size / np.maximum(size[start[:-1]], 1)[page], SHARES)
    for value, width, of in ((mean, len(LENGTHS) + 1, leaf), (mean, len(LENGTHS) + 1, ~leaf),
                             (links, len(LINKS) + 1, leaf), (links, len(LINKS) + 1, ~leaf), (share, len(SHARES) + 1, leaf), (share, len(SHARES) + 1, ~leaf)):
        x[rows[of], at + value[of]] = 1
        at += width
    x[:, at], x[:, at + 1], x[:, at + 2], x[:, at + 3] = 1, leaf & ends, leaf & (marks >= 2), leaf & rights
    return f


def marginals(f: Forest, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(content) of every node, P(parent, child) of every edge (rows of roots are zero), and log Z summed over the pages.

    ``unary`` is the log-odds of content a node, ``pair`` a table of (kind, parent's state, child's state) log-potentials.
    """
    n, kind = len(unary), f.kinds()
    below = np.stack([np.zeros(n), unary], 1)  # own potential and messages from children
    up = np.zeros((n, 2))
    levels = f.levels()
    for nodes in reversed(levels):
        up[nodes] = np.logaddexp.reduce(below[nodes][:, None, :] + pair[kind[nodes]], axis=2)
        np.add.at(below, f.parent[nodes], up[nodes])
    belief, roots = below.copy(), f.parent < 0
    both = np.zeros((n, 2, 2))
    for nodes in levels:
        rest = belief[f.parent[nodes]] - up[nodes]  # the parent without this child's message
        joint = rest[:, :, None] + pair[kind[nodes]] + below[nodes][:, None, :]
        both[nodes] = np.exp(joint - np.logaddexp.reduce(joint.reshape(len(nodes), 4), axis=1)[:, None, None])
        belief[nodes] = below[nodes] + np.logaddexp.reduce(rest[:, :, None] + pair[kind[nodes]], axis=1)
    p = np.exp(belief[:, 1] - np.logaddexp(belief[:, 0], belief[:, 1]))
    return p, both, np.logaddexp(below[roots, 0], below[roots, 1]).sum()


@dataclass(frozen=True)
class Extractor:
    """Fitted weights: of the features, and of the edges by kind, parent's and child's state."""

    weights: np.ndarray
    pair: np.ndarray

    def texts(self, pages: list[str]) -> list[str]:
        trees = [parse(p) for p in pages]
        f = forest(trees)
        p, _, _ = marginals(f, f.features @ self.weights, self.pair)
        out, at = [], 0
        for t in trees:
            out.append("\n".join(x for x, q in zip(t.text, p[at:at + len(t.text)], strict=True) if x and q >= 0.5))
            at += len(t.text)
        return out


def self_labelled(page: str) -> Tree | None:
    """A page that names its content itself, by one ``article`` or else one ``main``; None for any other page."""
    low = page.lower()
    for name in ("article", "main"):
        n = low.count(f"<{name}>") + low.count(f"<{name} ")
        if n == 1:
            return parse(page, {name: 1, "nav": 0, "aside": 0, "footer": 0, "form": 0})
        if n:
            return None
    return None


def plain(f: Forest) -> Forest:
    """The same pages with speaking element names replaced by ``div`` and without hints."""
    x, spoke = f.features.copy(), SPEAKING[f.tag]
    x[spoke, f.tag[spoke]] = 0
    x[spoke, TAG["div"]] = 1
    x[:, len(TAGS):len(TAGS) + len(HINT)] = 0
    return Forest(f.parent, np.where(spoke, TAG["div"], f.tag), f.hint * 0, f.depth, f.label, x)


def train(pages: list[str], t: Training = Training()) -> Extractor:
    """Maximum likelihood on the library's labelled pages and on those of ``pages`` that name their content; order does not matter but for rounding."""
    own = [parse(p) for p in PAGES]
    found = [x for x in map(self_labelled, pages) if x is not None]
    sets = [(forest(own), 1.0), (plain(forest(own)), 0.3)]
    if found:
        weight = len(own) / len(found)
        sets += [(forest(found), weight), (plain(forest(found)), 0.1 * weight)]
    w, pair = np.zeros(WIDTH), np.zeros((3, 2, 2))
    pair[:, [0, 1], [0, 1]] = 1.0
    first, second = np.zeros(WIDTH + 12), np.zeros(WIDTH + 12)
    for step in range(1, t.steps + 1):
        grad = -t.decay * len(own) * np.concatenate([w, pair.ravel()])
        for f, weight in sets:
            p, both, _ = marginals(f, f.features @ w, pair)
            edges, kind = np.flatnonzero(f.parent >= 0), f.kinds()
            seen = np.zeros((3, 2, 2))
            np.add.at(seen, (kind[edges], f.label[f.parent[edges]], f.label[edges]), 1)
            np.subtract.at(seen, kind[edges], both[edges])
            grad += weight * np.concatenate([f.features.T @ (f.label - p), seen.ravel()])
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad ** 2
        move = t.rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        w, pair = w + move[:WIDTH], pair + move[WIDTH:].reshape(3, 2, 2)
    return Extractor(w, pair)


def fit(pages: DataFrame, page_id: Column, html: Column, t: Training = Training()) -> Extractor:
    """An extractor fitted in one task on the library's labelled pages and on at most ``t.pages`` pages of the table, the first by a hash of the
    id among those that name their content and have at most ``t.longest`` characters. Only the weights reach the driver."""
    rows = pages.select(page_id.cast("string").alias("page_id"), html.cast("string").alias("html"))
    rows = rows.where((F.length("html") <= t.longest) & F.col("html").rlike("(?i)<(article|main)[ >]"))
    picked = rows.select("page_id", "html", F.xxhash64("page_id", "html").alias("h")).orderBy("h").limit(t.pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = train(sorted(x for b in batches for x in b.column("html").to_pylist()), t)
        yield from pa.table({"w": pa.array([got.weights], pa.list_(pa.float64())), "pair": pa.array([got.pair.ravel()], pa.list_(pa.float64()))}).to_batches()

    row = picked.select("html").coalesce(1).mapInArrow(run, "w array<double>, pair array<double>").first()
    return Extractor(np.array(row["w"]), np.array(row["pair"]).reshape(3, 2, 2)) if row else train([], t)  # no partition: no page


def extracted(pages: DataFrame, page_id: Column, url: Column, html: Column, model: Extractor, batch: int = 64) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row: its text blocks judged content, in page order, one a line.

    A null or empty page, and one without text, gives the empty text; null and
    repeated ids and urls are kept as they are, every row has its own result. Pages
    are read whole; elements nested deeper than 256 count as their ancestor of that
    depth. A marginal of exactly a half is content. Plain text without markup is one
    block. Other columns are not read. An empty table gives no rows.
    """
    rows = pages.select(page_id.cast("long").alias("page_id"), url.cast("string").alias("url"), F.coalesce(html.cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), batch):
                b = whole.slice(at, batch)
                texts = model.texts(b.column("html").to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
