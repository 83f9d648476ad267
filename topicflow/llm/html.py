"""Main text of web pages by boosted trees over DOM nodes and a decoding that respects the tree.

Block elements and the text blocks inside them are nodes. Each has features of its own (tag, attribute
tokens, depth), of its subtree (text density, link share), of its siblings, and of its ancestors. Gradient-boosted
trees give each node the probability that it holds main text. Decoding picks the most probable labelling
in which no node below a rejected one is kept: best(v kept) = log p + sum of the children's best,
best(v rejected) = sum of log(1 - p) over its subtree.

The trees are fitted on a bounded sample of pages (``SAMPLE_PAGES``, ``SAMPLE_CHARS``; the first in the order
of a hash of page_id) that mark their article. Labels come from that mark-up. Each sampled page is also used with its
mark-up renamed and with menus, notices, comments and the like, made of its own words, put in, so
that pages of other habits are learnt as well. Main text is put in likewise: lists, quotes, tables, ``div`` paragraphs, boxes whose
tokens say both that they hold main text and that they do not, and pages inside one form. Pages longer than
``LONGEST`` are not learnt from. Every page is extracted.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filled, per_batch, prepare

SAMPLE_PAGES = 150
SAMPLE_CHARS = 4_000_000
LONGEST = SAMPLE_CHARS // 20  # so that a long page cannot use up the sample
TREES, DEPTH, RATE, BINS, LEAST_WEIGHT, SHRINK = 40, 4, 0.3, 16, 2.0, 1.0

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
RAW = frozenset("script style textarea iframe title".split())  # no mark-up is read up to their end
MATH = frozenset("math semantics mrow mi mn mo ms mtext mfrac msqrt mroot msub msup msubsup mover munder munderover mstyle mspace mpadded mtable mtr mtd".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()) | MATH
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
KINDS = ("nav", "header", "footer", "aside", "form", "article", "main", "p", "li", "ul", "ol", "div", "section", "table", "td", "blockquote", "figure", "h1", "h2", "h3", "body", "#text")
#: Groups of attribute tokens; all but the last say that a node is no main text.
TOKENS = (
    ("ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner"),
    ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "toc", "pagination"),
    ("header", "masthead", "topbar", "footer", "bottom", "copyright", "legal"),
    ("sidebar", "side", "aside", "widget", "related", "recommended", "trending", "popular"),
    ("comment", "comments", "reply", "replies", "disqus", "discussion", "respond"),
    ("cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "gdpr"),
    ("share", "social", "follow", "form", "search", "login", "signup"),
    ("content", "article", "post", "entry", "story", "main", "articlebody", "text", "body"),
)
GROUP = {token: k for k, group in enumerate(TOKENS) for token in group}
GOOD = len(TOKENS) - 1
NOT_MAIN = frozenset("nav header footer aside form".split())
PLANTED = "\ue000"  # stands before main text that a variant puts in


@dataclass
class Node:
    """A block element, or a text block (tag ``#text``)."""

    tag: str
    parent: int
    depth: int
    groups: frozenset = frozenset()
    text: list = field(default_factory=list)
    linked: int = 0  # characters inside links
    tags: int = 0  # inline tags


def parse(page: str) -> list[Node]:
    """Nodes in page order, each after its parent; the first is the page itself."""
    nodes = [Node("#page", -1, 0)]
    open_: list[tuple[str, int]] = [("#page", 0)]  # tag, its block node
    text_node, links, at = -1, 0, 0

    def add(piece: str) -> None:
        nonlocal text_node
        if text_node < 0:
            if not piece or piece.isspace():
                return
            text_node = len(nodes)
            nodes.append(Node("#text", open_[-1][1], nodes[open_[-1][1]].depth + 1))
        nodes[text_node].text.append(piece)
        if links:
            nodes[text_node].linked += len(piece)

    def close(k: int) -> None:
        nonlocal text_node, links
        if any(tag not in INLINE for tag, _ in open_[k:]):
            text_node = -1
        links -= sum(tag == "a" for tag, _ in open_[k:])
        del open_[k:]

    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        if start > at:
            add(page[at:start])
        found = TAG.match(page, start)
        if not found:
            add("<")
            at = start + 1
            continue
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            k = len(open_) - 1
            while k > 0 and open_[k][0] != tag:
                k -= 1
            if k > 0:
                close(k)
            elif tag not in INLINE:
                text_node = -1
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                add(" ")
                text_node = -1 if tag == "hr" else text_node
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if (tag == "svg" or tag in MATH) and found[3].endswith("/"):
            continue
        if tag in ENDS_P or tag in CLOSES:
            enders = CLOSES.get(tag, ("p",))
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] in enders:
                    close(k)
                    break
                if open_[k][0] not in INLINE and open_[k][0] != "p":
                    break
        if tag in INLINE:
            links += tag == "a"
            nodes[open_[-1][1]].tags += 1
            open_.append((tag, open_[-1][1]))
            continue
        text_node = -1
        words = " ".join(a[2] or a[3] or a[4] or "" for a in ATTRIBUTE.finditer(found[3])) if "=" in found[3] else ""
        groups = frozenset(GROUP[w] for w in re.findall("[a-z]+", words.lower()) if w in GROUP) if words else frozenset()
        parent = open_[-1][1]
        nodes.append(Node(tag, parent, nodes[parent].depth + 1, groups))
        if not found[3].endswith("/"):
            open_.append((tag, len(nodes) - 1))
    return nodes


def weak_labels(nodes: list[Node]) -> list[bool] | None:
    """Whether each node holds main text by the page's own mark-up; None where nothing is marked as such."""
    inside, barred = [False] * len(nodes), [False] * len(nodes)
    for k, node in enumerate(nodes[1:], 1):
        inside[k] = inside[node.parent] or node.tag in ("article", "main") or GOOD in node.groups
        barred[k] = barred[node.parent] or node.tag in NOT_MAIN or any(g != GOOD for g in node.groups)
    if not any(inside):
        return None
    good = [n.tag == "#text" and i and not b for n, i, b in zip(nodes, inside, barred)]
    for k in range(len(nodes) - 1, 0, -1):
        good[nodes[k].parent] = good[nodes[k].parent] or good[k]
    return good


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node."""
    n = len(nodes)
    parent = np.array([max(x.parent, 0) for x in nodes])
    own = np.array([sum(map(len, x.text)) for x in nodes], float)
    linked, tags = np.array([x.linked for x in nodes], float), np.array([x.tags + 1 for x in nodes], float)
    leaves = (own > 0).astype(float)
    begins = np.cumsum(own) - own
    children, order = np.zeros(n), np.zeros(n)
    for k in range(1, n):
        order[k] = children[parent[k]]
        children[parent[k]] += 1
    total, total_linked, total_tags, total_leaves = own.copy(), linked.copy(), tags.copy(), leaves.copy()
    for k in range(n - 1, 0, -1):
        p = parent[k]
        total[p] += total[k]
        total_linked[p] += total_linked[k]
        total_tags[p] += total_tags[k]
        total_leaves[p] += total_leaves[k]
    flags, above = np.zeros((n, len(KINDS) + len(TOKENS)), bool), np.zeros((n, len(KINDS) + len(TOKENS)), bool)
    for k, node in enumerate(nodes):
        if node.tag in KINDS:
            flags[k, KINDS.index(node.tag)] = True
        for g in node.groups:
            flags[k, len(KINDS) + g] = True
        if k:
            above[k] = above[parent[k]] | flags[parent[k]]
    page = max(total[0], 1.0)
    barred = np.ones(n)  # the smallest share of the page, up from here, of a node that its tag or tokens call no main text
    for k, node in enumerate(nodes):
        own_share = total[k] / page if node.tag in NOT_MAIN or (node.groups and GOOD not in node.groups) else 1.0
        barred[k] = min(own_share, barred[parent[k]]) if k else own_share
    siblings = children[parent]
    around = total[parent] / np.maximum(siblings, 1)
    numbers = np.stack([
        [x.depth for x in nodes], np.log1p(total), total_linked / np.maximum(total, 1), total / total_tags, total / np.maximum(total_leaves, 1),
        children, siblings, order / np.maximum(siblings, 1), np.log1p(around), total / np.maximum(total[parent], 1), total / page, begins / page, 1 - (begins + total) / page, barred,
    ], axis=1)
    return np.concatenate([numbers, flags, above], axis=1)


@dataclass
class Trees:
    """Boosted trees of one depth: per tree and inner node a feature and a bound, per leaf a value."""

    edges: list  # bin bounds of each feature
    feature: np.ndarray
    bound: np.ndarray
    value: np.ndarray
    start: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def odds(self, x: np.ndarray) -> np.ndarray:
        b, out, rows = self.binned(x), np.full(len(x), self.start), np.arange(len(x))
        for feature, bound, value in zip(self.feature, self.bound, self.value):
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (b[rows, feature[at]] > bound[at])
            out += value[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order boosting of the logistic loss over binned features."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    edges = [np.unique(np.append(e, 0.5)) if set(np.unique(x[:, j])) <= {0.0, 1.0} else e for j, e in enumerate(edges)]
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.5
    model = Trees(edges, np.zeros((TREES, 2**DEPTH - 1), int), np.zeros((TREES, 2**DEPTH - 1), int), np.zeros((TREES, 2**DEPTH)), float(np.log(rate / (1 - rate))))
    b, odds, rows = model.binned(x), np.full(len(x), model.start), np.arange(len(x))
    width = BINS + 1
    for t in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(x), int)
        for level in range(DEPTH):
            first, nodes = 2**level - 1, 2**level
            best = np.full(nodes, 1e-6)
            total_g, total_h = np.bincount(at - first, g, nodes), np.bincount(at - first, h, nodes)
            for j in range(x.shape[1]):
                cell = (at - first) * width + b[:, j]
                left_g = np.bincount(cell, g, nodes * width).reshape(nodes, width).cumsum(axis=1)[:, :-1]
                left_h = np.bincount(cell, h, nodes * width).reshape(nodes, width).cumsum(axis=1)[:, :-1]
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = left_g**2 / (left_h + SHRINK) + right_g**2 / (right_h + SHRINK) - (total_g**2 / (total_h + SHRINK))[:, None]
                gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
                top = gain.argmax(axis=1)
                better = gain[np.arange(nodes), top] > best
                best[better] = gain[np.arange(nodes), top][better]
                model.feature[t, first : first + nodes][better] = j
                model.bound[t, first : first + nodes][better] = top[better]
            model.bound[t, first : first + nodes][best <= 1e-6] = width  # all rows go left
            at = 2 * at + 1 + (b[rows, model.feature[t][at]] > model.bound[t][at])
        leaf = at - (2**DEPTH - 1)
        model.value[t] = RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + SHRINK)
        odds += model.value[t][leaf]
    return model


def variants(page: str, seed: int) -> list[str]:
    """The page; with its mark-up renamed; and with boilerplate of its own words put in, inside the article and around it."""
    draw = random.Random(seed)
    words = re.sub(r"<[^>]*>", " ", page[:20_000]).split()[:400] or ["text"]
    some = lambda n: " ".join(draw.choice(words) for _ in range(n))
    menu = "".join(f'<li><a href="#">{some(2)}</a></li>' for _ in range(draw.randint(3, 9)))
    bad = [group for group in TOKENS[:-1] for _ in range(1)]
    blocks = [f'<div class="{draw.choice(g)}"><p>{some(draw.randint(5, 60))}</p></div>' for g in bad]
    blocks += [f"<{tag}><p>{some(draw.randint(5, 50))}</p></{tag}>" for tag in ("aside", "header", "footer")]
    blocks += [f"<form><label>{some(3)}</label><input><p>{some(4)}</p></form>", f"<nav><ul>{menu}</ul></nav>"]
    blocks += [f'<div class="comments"><ul>{"".join(f"<li><p>{some(20)}</p></li>" for _ in range(4))}</ul></div>']
    draw.shuffle(blocks)
    half = len(blocks) // 2
    ends = [m.end() for m in re.finditer(r"</p>(?!\s*</form>)", page)]
    spot = draw.choice(ends) if ends else len(page)
    inside = page[:spot] + "".join(blocks[:2]) + page[spot:]
    open_body = inside.find("<body>") + 6 if "<body>" in inside else 0
    planted = inside[:open_body] + "".join(blocks[2:half]) + inside[open_body:]
    close = planted.rfind("</article>")
    planted = planted[: close + 10] + "".join(blocks[half:]) + planted[close + 10 :] if close >= 0 else planted
    return [page, planted]


def with_main(page: str, seed: int) -> str | None:
    """The page with main text of many forms put into its article, each piece behind ``PLANTED``; None without an article."""
    draw = random.Random(seed)
    start, end = page.find("<article>"), page.rfind("</article>")
    ends = [m.end() for m in re.finditer("</p>", page[:end]) if m.end() > start]
    if min(start, end) < 0 or not ends:
        return None
    words = re.sub(r"<[^>]*>", " ", page[start : min(end, start + 20_000)]).split()[:400] or ["text"]
    some = lambda low, high: PLANTED + " ".join(draw.choice(words) for _ in range(draw.randint(low, high)))
    many = lambda tag, low, high: "".join(f"<{tag}>{some(low, high)}</{tag}>" for _ in range(draw.randint(2, 6)))
    both = lambda: f"{draw.choice(TOKENS[GOOD])} {draw.choice(draw.choice(TOKENS[:GOOD]))}"
    blocks = [
        f"<ul>{many('li', 2, 20)}</ul>", f"<ol>{many('li', 2, 20)}</ol>", f"<blockquote><p>{some(5, 40)}</p></blockquote>",
        f"<table>{''.join(f'<tr>{many("td", 1, 6)}</tr>' for _ in range(3))}</table>", many("div", 5, 60), f"<section>{many('p', 5, 60)}</section>",
        f'<div class="{both()}">{many("p", 5, 60)}</div>', f'<div class="{both()}">{some(5, 60)}</div>', f"<h2>{some(2, 8)}</h2>", f"<figure><p>{some(3, 20)}</p></figure>",
    ]
    for spot, block in sorted(zip([draw.choice(ends) for _ in blocks], blocks), reverse=True):
        page = page[:spot] + block + page[spot:]
    return page


def renamed(nodes: list[Node], good: list[bool], seed: int) -> list[Node]:
    """The same tree with some other mark-up around the article, in some draws with ``div`` paragraphs or misleading tokens."""
    draw = random.Random(seed)
    tag, groups = draw.choice([("div", frozenset()), ("div", frozenset({GOOD})), ("section", frozenset()), ("main", frozenset()), ("div", frozenset({GOOD, draw.randrange(GOOD)}))])
    plain = draw.random() < 0.4

    def form(n: Node, main: bool) -> Node:
        if n.tag in ("article", "main"):
            return Node(tag, n.parent, n.depth, groups, n.text, n.linked, n.tags)
        return Node("div", n.parent, n.depth, n.groups, n.text, n.linked, n.tags) if plain and main and n.tag == "p" else n

    return [form(n, g) for n, g in zip(nodes, good)]


def in_form(page: str, good: list[bool]) -> tuple[list[Node], list[bool]] | None:
    """The page inside one form, and its labels from those without it; None where the page has no body of its own."""
    body = page.find("<body>") + 6
    if body < 6:
        return None
    nodes = parse(f"{page[:body]}<form>{page[body:]}")
    at = next(k for k, n in enumerate(nodes) if n.tag == "form")
    return (nodes, good[:at] + [True] + good[at:]) if len(nodes) == len(good) + 1 else None


def taught(page: str, seed: int) -> Iterator[tuple[list[Node], list[bool]]]:
    """What is learnt from one page: trees of nodes and their labels."""
    for v, variant in enumerate([*variants(page, seed), with_main(page, seed)]):
        nodes = parse(variant) if variant else []
        good = weak_labels(nodes) if nodes else None
        if good is None:
            continue
        for k, node in enumerate(nodes):
            if any(PLANTED in piece for piece in node.text):
                node.text[:] = [piece.replace(PLANTED, "") for piece in node.text]
                up = k
                while up >= 0:
                    good[up], up = True, nodes[up].parent
        yield nodes, good
        yield renamed(nodes, good, 3 * seed + v), good
        if v == 1 and (inside := in_form(variant, good)):
            yield inside


def fit(pages: list[str]) -> Trees | None:
    """Trees from pages that mark their article; None if no page does."""
    made = [(features(nodes), np.array(good, float)) for k, page in enumerate(pages) for nodes, good in taught(page, k)]
    return boost(np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])) if made else None


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The most probable labelling in which whatever is below a rejected node is rejected."""
    odds = np.clip(odds, -30, 30)
    keep, reject = (-np.logaddexp(0, -odds)).tolist(), (-np.logaddexp(0, odds)).tolist()
    for k in range(len(nodes) - 1, 0, -1):
        up = nodes[k].parent
        keep[up] += max(keep[k], reject[k])
        reject[up] += reject[k]
    kept = [keep[0] > reject[0]]
    for k in range(1, len(nodes)):
        kept.append(kept[nodes[k].parent] and keep[k] > reject[k])
    return kept


def written(nodes: list[Node], kept: list[bool]) -> str:
    blocks = (" ".join(entities.unescape("".join(n.text)).split()) for n, k in zip(nodes, kept) if k and n.text)
    return "\n\n".join(b for b in blocks if b)


def train(pages: DataFrame) -> Trees | None:
    """Trees from the bounded sample of ``pages`` (page_id, html)."""
    drawn = prepare(pages).select(F.xxhash64("page_id", F.lit(5)).alias("at"), "page_id", F.coalesce("html", F.lit("")).alias("html"))
    drawn = drawn.where(F.length("html") <= LONGEST).orderBy("at", "page_id", F.xxhash64("html")).limit(SAMPLE_PAGES)
    so_far = F.sum(F.length("html")).over(Window.orderBy("at", "page_id").rowsBetween(Window.unboundedPreceding, 0))
    return fit(drawn.withColumn("so_far", so_far).where(F.col("so_far") <= SAMPLE_CHARS).select("html").toArrow().column(0).to_pylist())


def extract(pages: DataFrame, model: Trees | None = None) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``.

    A null or empty html has the empty text. Without any page to learn from, the mark-up itself decides, and a page
    without it is kept whole. Repeated rows give repeated results; an empty table gives none.
    """
    model = model or train(pages)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        trees = [parse(page) for page in filled(batch, "html").to_pylist()]
        if model:
            rows = model.odds(np.concatenate([features(t) for t in trees]))
            ends = np.cumsum([0] + [len(t) for t in trees])
            kept = [decode(t, rows[a:b]) for t, a, b in zip(trees, ends[:-1], ends[1:])]
        else:
            kept = [weak_labels(t) or [True] * len(t) for t in trees]
        texts = [written(t, k) for t, k in zip(trees, kept)]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return per_batch(pages.select("page_id", "url", "html"), work, "page_id long, url string, text string, n_chars long")
