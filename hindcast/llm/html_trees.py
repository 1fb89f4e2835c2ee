"""HTML extraction: gradient-boosted trees over DOM-node features, decoded from the root down.

Every element of a page's body that forms a block gets features of its subtree's density, of its attribute tokens, of
its depth and of its siblings. The trees are fitted on nodes whose parent holds main text and give the odds that a node then
holds some as well. Decoding goes from the root down along these conditional odds: below a dropped node nothing is kept,
and text is kept only if every node above it is, so choices on one path never contradict each other.

The trees are fitted on the driver, on pages composed from the words of at most ``SAMPLE`` pages of the input: articles
between menus, headers, sidebars, notices, adverts, forms, related links, footers and reader comments, in many layouts
and under many names, of which the composer knows what is main text. Every page is read whole.

Blocks are runs of text between block elements; character references are decoded, white space is turned into one
blank, empty blocks go, and blocks are joined in page order by an empty line. Scripts, styles and other invisible
elements never count as text.

Defined results: null html counts as empty and gives an empty text; a page without any kept block gives an empty text;
markup that is never closed ends with its parent; repeated rows are extracted each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import share_of, small_batches

SAMPLE = 200  # pages whose words dress the training pages
TRAINING = 400  # composed pages
TREES, DEPTH, RATE, LEAF, BINS = 30, 4, 0.3, 20, 32
CHUNK_CHARS = 4_000_000
LAYOUT = "page_id long, url string, text string, n_chars long"

# Element names of HTML.
UNSEEN = frozenset("script style noscript template head title svg math iframe object canvas select option datalist audio video map".split())
HEAD_PARTS = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var button".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table body html div section article aside main".split())

TAGS = ("article main", "nav menu", "header", "footer", "aside", "form fieldset", "section", "div center", "p blockquote pre",
        "h1 h2 h3 h4 h5 h6", "ul ol dl", "li dt dd", "table tbody tr td th", "#text")
TAG_OF = {name: i for i, names in enumerate(TAGS) for name in names.split()}
TOKENS = {
    "main": "article content post entry main body story text page primary",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs tabs toolbar pagination pager skip",
    "head": "header masthead banner topbar logo top hero",
    "foot": "footer foot bottom copyright legal colophon",
    "side": "sidebar side aside rail widget secondary tags",
    "advert": "ad ads advert advertisement promo sponsored sponsor banner dfp adsense",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay paywall message warning",
    "talk": "comment comments reply replies respond discussion disqus feedback",
    "share": "share social follow related recommended more popular trending links",
    "form": "form login search newsletter subscribe signup register input",
}
GROUPS = {w: [g for g, words in enumerate(TOKENS.values()) if w in words.split()] for ws in TOKENS.values() for w in ws.split()}
SPLIT = re.compile(r"[a-z]+")
FEATURES = len(TAGS) + len(TOKENS) + 16


@dataclass(slots=True)
class Node:
    tag: str
    attributes: str
    parent: int
    depth: int
    children: list[int] = field(default_factory=list)
    text: str | None = None
    words: int = 0
    chars: int = 0
    linked: int = 0
    elements: int = 0
    blocks: int = 0
    marks: int = 0
    truth: bool | None = None


class Tree(HTMLParser):
    """The block elements of a page in page order; each run of text is a node ``#text`` below its block."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("body", "", -1, 0)]
        self.open = [("body", 0)]
        self.run: list[str] = []
        self.unseen: list[str] = []  # an open invisible element and what is open inside it
        self.inline: list[tuple[str, int]] = []  # open inline elements, with the number of open blocks around them
        self.links = 0
        self.run_linked = self.run_elements = 0
        self.feed(html)
        self.close()
        self.flush()
        self.sum_up()

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            at = self.open[-1][1]
            node = Node("#text", "", at, self.nodes[at].depth + 1, text=text)
            node.chars, node.words, node.blocks = len(text), text.count(" ") + 1, 1
            node.linked, node.elements = min(self.run_linked, len(text)), self.run_elements
            node.marks = sum(map(text.count, ".,;:!?"))
            self.nodes[at].children.append(len(self.nodes))
            self.nodes.append(node)
        self.run.clear()
        self.run_linked = self.run_elements = 0

    def handle_starttag(self, tag, attrs) -> None:
        if self.unseen and self.shown_by(tag):
            return
        if tag in UNSEEN or self.unseen:
            if tag not in VOID:
                self.unseen.append(tag)
            return
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.run.append("\n")
        elif tag in INLINE:
            self.run_elements += 1
            self.inline.append((tag, len(self.open)))
            self.links += tag == "a"
        elif tag == "hr":
            self.flush()
        elif tag not in VOID:
            self.flush()
            if tag in CLOSES_P:
                self.end("p", SCOPES - {"div"})
            for same in SAME_ENDS.get(tag, ()):
                self.end(same, SCOPES)
            at = self.open[-1][1]
            told = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "itemprop", "aria-label"))
            if any(k == "hidden" for k, _ in attrs):
                told += " popup"
            self.nodes[at].children.append(len(self.nodes))
            self.open.append((tag, len(self.nodes)))
            self.nodes.append(Node(tag, told.lower(), at, self.nodes[at].depth + 1, elements=1))
            self.links = 0

    def shown_by(self, tag: str) -> bool:
        """Close the invisible elements that end where ``tag`` starts; True if the tag does nothing else."""
        if tag == "body" or (tag not in HEAD_PARTS and self.unseen[0] == "head" and {"head", "noscript"}.issuperset(self.unseen)):
            self.unseen.clear()
        elif tag in ("option", "optgroup") and "option" in self.unseen:
            del self.unseen[self.unseen.index("option"):]
        elif tag in ("input", "textarea", "select") and "select" in self.unseen:
            del self.unseen[self.unseen.index("select"):]
            return tag == "select"
        return False

    def end(self, tag: str, until: frozenset = frozenset()) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.flush()
                del self.open[i:]
                self.inline = [x for x in self.inline if x[1] <= i]
                self.links = 0
                return
            if self.open[i][0] in until:
                return

    def handle_startendtag(self, tag, attrs) -> None:
        if tag in VOID or tag not in UNSEEN and not {"svg", "math"}.intersection(self.unseen):
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag) -> None:
        if tag in self.unseen:
            del self.unseen[len(self.unseen) - 1 - self.unseen[::-1].index(tag):]
            return
        # The end of a parent ends what is open inside it.
        if tag in ("html", "body") or (tag, len(self.open)) in self.inline or any(tag == x for x, _ in self.open[1:]):
            self.unseen.clear()
        if self.unseen or tag in UNSEEN or tag in ("html", "body"):
            pass
        elif tag in INLINE:
            if (tag, len(self.open)) in self.inline:
                self.inline.remove((tag, len(self.open)))
            if tag == "a":
                self.links = max(0, self.links - 1)
        else:
            self.end(tag)

    def handle_data(self, data) -> None:
        if self.unseen == ["head"] and data.strip():
            self.unseen.clear()
        if not self.unseen:
            self.run.append(data)
            if self.links:
                self.run_linked += len(data)

    def sum_up(self) -> None:
        for node in reversed(self.nodes[1:]):
            up = self.nodes[node.parent]
            up.words += node.words
            up.chars += node.chars
            up.linked += node.linked
            up.elements += node.elements
            up.blocks += node.blocks
            up.marks += node.marks

    def features(self) -> np.ndarray:
        out = np.zeros((len(self.nodes), FEATURES))
        whole = max(self.nodes[0].chars, 1)
        base = len(TAGS) + len(TOKENS)
        log = math.log1p
        before = 0
        place = [0] * len(self.nodes)
        alike = [1.0] * len(self.nodes)
        for n in self.nodes:
            tags: dict[str, int] = {}
            for c in n.children:
                tags[self.nodes[c].tag] = tags.get(self.nodes[c].tag, 0) + 1
            for k, c in enumerate(n.children):
                place[c], alike[c] = k, tags[self.nodes[c].tag] / len(n.children)
        for i, n in enumerate(self.nodes):
            row = out[i]
            kind = TAG_OF.get(n.tag)
            if kind is not None:
                row[kind] = 1
            for token in SPLIT.findall(n.attributes):
                for g in GROUPS.get(token, ()):
                    row[len(TAGS) + g] += 1
            up = self.nodes[n.parent] if n.parent >= 0 else n
            near = up.children if n.parent >= 0 else [0]
            at = place[i]
            last = self.nodes[near[at - 1]] if n.parent >= 0 and at else None
            following = self.nodes[near[at + 1]] if n.parent >= 0 and at + 1 < len(near) else None
            row[base:] = (
                log(n.words), log(n.chars), n.linked / max(n.chars, 1), n.chars / max(n.elements, 1), n.words / max(n.blocks, 1),
                n.marks / max(n.words, 1), log(n.blocks), n.depth, len(near), at / max(len(near) - 1, 1),
                alike[i], log(last.words) if last else -1,
                log(following.words) if following else -1, n.chars / whole, before / whole, n.chars / max(up.chars, 1),
            )
            if n.tag == "#text":
                before += n.chars
        return out

    def decoded(self, odds: np.ndarray) -> list[str]:
        """The text blocks whose every ancestor is kept; ``odds`` are log odds given a kept parent."""
        kept = [True] * len(self.nodes)
        out = []
        for i in range(1, len(self.nodes)):
            node = self.nodes[i]
            kept[i] = kept[node.parent] and odds[i] > 0
            if kept[i] and node.text is not None:
                out.append(node.text)
        return out


@dataclass(frozen=True)
class Trees:
    """Boosted trees of one shape: per level a feature and a cut for every node, then the leaves."""

    prior: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def boosted(x: np.ndarray, y: np.ndarray) -> Trees:
    """Logistic boosting on binned features, each split by second-order gain."""
    width = x.shape[1]
    edges = np.full((width, BINS), np.inf)
    for j in range(width):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))
        edges[j, :len(cuts)] = cuts
    cells = np.stack([np.searchsorted(edges[j], x[:, j]) for j in range(width)], 1) + np.arange(width) * BINS
    prior = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score = np.full(len(y), prior)
    features, cuts, leaves = [], [], []
    inner = 2**DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            right = np.zeros(len(rows), bool)
            if len(rows) >= 2 * LEAF:
                flat = cells[rows].ravel()
                left_g, left_h, left_n = (
                    np.bincount(flat, np.repeat(w, width), width * BINS).reshape(width, BINS).cumsum(1)
                    for w in (g[rows], h[rows], np.ones(len(rows))))
                all_g, all_h = g[rows].sum(), h[rows].sum()
                gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
                gain[(left_n < LEAF) | (len(rows) - left_n < LEAF)] = -1
                j, k = divmod(int(gain.argmax()), BINS)
                if gain[j, k] > 1e-6:
                    feature[node], cut[node] = j, edges[j, k]
                    right = x[rows, j] > edges[j, k]
            at[rows] = 2 * node + 1 + right
        leaf = at - inner
        value = RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
        score += value[leaf]
        features.append(feature)
        cuts.append(cut)
        leaves.append(value)
    return Trees(prior, np.array(features), np.array(cuts), np.array(leaves))


MARK = "\x02"  # opens every run of main text in a composed page


class Composer:
    """Pages with known main text, in the words of real pages."""

    def __init__(self, words: list[str], seed: int):
        self.words, self.rng = words or ["word"], random.Random(seed)

    def some(self, low: int, high: int) -> str:
        n = self.rng.randint(low, high)
        start = self.rng.randrange(len(self.words))
        return escape(" ".join(self.words[(start + i) % len(self.words)] for i in range(n)))

    def named(self, *groups: str) -> str:
        """Attributes with tokens of some groups, or none at all, or ones that say nothing."""
        if self.rng.random() < 0.15:
            return self.rng.choice(["", f' class="{self.rng.choice("abcxyz")}{self.rng.randint(1, 99)}"'])
        words = TOKENS[self.rng.choice(groups)].split()
        name = self.rng.choice(words)
        name += self.rng.choice(["", "", "-box", "-wrap", f"-{self.rng.randint(1, 20)}", "_inner", " clearfix"])
        return f' {self.rng.choice(["class", "class", "id"])}="{name}"'

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/x">{self.some(1, 4)}</a></li>' for _ in range(self.rng.randint(low, high)))

    def block(self, tag: str, names: str, inner: str) -> str:
        return f"<{tag}{names}>{inner}</{tag}>"

    def paragraph(self, main: bool) -> str:
        rng = self.rng
        mark = MARK if main else ""
        kind = rng.random()
        if kind < 0.08:
            level = rng.randint(2, 4)
            return f"<h{level}>{mark}{self.some(1, 9)}</h{level}>"
        if kind < 0.14:
            items = "".join(f"<li>{mark}{self.some(2, 20)}</li>" for _ in range(rng.randint(2, 6)))
            return f"<ul>{items}</ul>"
        if kind < 0.2:
            return f"<blockquote><p>{mark}{self.some(5, 40)}</p></blockquote>"
        if kind < 0.24:
            rows = "".join(f"<tr><td>{mark}{self.some(1, 6)}</td><td>{mark}{self.some(1, 6)}</td></tr>" for _ in range(3))
            return f"<table>{rows}</table>"
        text = self.some(*rng.choice([(1, 6), (8, 60), (40, 150)]))
        if rng.random() < 0.2:
            text = f"<b>{text}</b>" if rng.random() < 0.5 else f'{text} <a href="/y">{self.some(1, 4)}</a> {self.some(1, 9)}'
        return f"<p>{mark}{text}" + ("</p>" if rng.random() < 0.9 else "")

    def junk(self) -> str:
        """One block that is not main text."""
        rng = self.rng
        kind = rng.choice(["menu", "advert", "notice", "side", "share", "form", "talk", "advert", "notice", "talk"])
        box = rng.choice(["div", "div", "section", "aside"])
        if kind == "menu":
            return self.block(rng.choice(["nav", "nav", "div", "ul"]), self.named("menu"), f"<ul>{self.links(2, 12)}</ul>")
        if kind == "advert":
            return self.block(box, self.named("advert"), rng.choice([self.some(3, 30), f"<p>{self.some(3, 40)}</p>"]))
        if kind == "notice":
            return self.block(box, self.named("notice"), f"<p>{self.some(5, 60)}</p><button>{self.some(1, 2)}</button>")
        if kind == "side":
            return self.block(rng.choice(["aside", "aside", "div"]), self.named("side", "share"),
                              f"<h3>{self.some(1, 4)}</h3><p>{self.some(3, 40)}</p><ul>{self.links(1, 8)}</ul>")
        if kind == "share":
            return self.block(box, self.named("share"), f"<h4>{self.some(1, 4)}</h4><ul>{self.links(2, 8)}</ul>")
        if kind == "form":
            return self.block("form", self.named("form"), f"<label>{self.some(1, 3)}</label><input><p>{self.some(2, 15)}</p>")
        said = "".join(
            self.block(rng.choice(["div", "li", "article", "section"]), self.named("talk"),
                       f"<h5>{self.some(1, 3)}</h5>" * (rng.random() < 0.5) + f"<p>{self.some(3, 80)}</p>")
            for _ in range(rng.randint(1, 6)))
        return self.block(rng.choice(["section", "div", "ol", "aside"]), self.named("talk"), f"<h3>{self.some(1, 3)}</h3>{said}")

    def page(self) -> str:
        rng = self.rng
        body = [f"<h1>{MARK}{self.some(1, 12)}</h1>"] if rng.random() < 0.8 else []
        body += [self.paragraph(True) for _ in range(rng.choice([1, 2, 4, 8, 15]))]
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            body.insert(rng.randint(0, len(body)), self.junk())
        text = "".join(body)
        article = rng.choice([
            lambda: self.block("article", rng.choice(["", self.named("main")]), text),
            lambda: self.block("article", "", text),
            lambda: self.block("main", self.named("main"), text),
            lambda: self.block("div", self.named("main"), text),
            lambda: self.block("section", self.named("main"), self.block("div", self.named("main"), text)),
            lambda: self.block("main", "", self.block("article", "", text)),
        ])()
        around = [self.junk() for _ in range(rng.randint(0, 3))] + [article] + [self.junk() for _ in range(rng.randint(0, 3))]
        middle = "".join(around)
        if rng.random() < 0.4:
            middle = self.block("div", self.named("main") if rng.random() < 0.5 else ' id="wrap"', middle)
        head = self.block(rng.choice(["header", "div"]), self.named("head"), f"<p>{self.some(1, 12)}</p>") if rng.random() < 0.6 else ""
        nav = self.block(rng.choice(["nav", "nav", "div"]), self.named("menu"), f"<ul>{self.links(2, 10)}</ul>") if rng.random() < 0.8 else ""
        foot = self.block(rng.choice(["footer", "footer", "div"]), self.named("foot") if rng.random() < 0.6 else "",
                          f"&copy; {self.some(3, 40)}") if rng.random() < 0.85 else ""
        return f"<html><head><title>{self.some(1, 9)}</title></head><body>{head}{nav}{middle}{foot}</body></html>"


def trained(htmls: list[str]) -> Trees:
    """Trees fitted on composed pages in the words of these."""
    words = [w for h in htmls for n in Tree(h).nodes if n.text for w in n.text.split() if w != MARK]
    composer = Composer(words, 11)
    xs, ys = [], []
    for _ in range(TRAINING):
        tree = Tree(composer.page())
        for node in tree.nodes:
            if node.text is not None:
                node.truth = MARK in node.text
        for node in reversed(tree.nodes[1:]):
            if node.truth:
                tree.nodes[node.parent].truth = True
        told = [i for i, n in enumerate(tree.nodes) if i and tree.nodes[n.parent].truth]
        xs.append(tree.features()[told])
        ys += [bool(tree.nodes[i].truth) for i in told]
    return boosted(np.concatenate(xs), np.array(ys, float))


def texts_of(htmls: list[str], trees: Trees) -> list[str]:
    parsed = [Tree(h) for h in htmls]
    sizes = np.cumsum([len(t.nodes) for t in parsed])
    if not len(sizes):
        return []
    odds = np.split(trees.odds(np.concatenate([t.features() for t in parsed])), sizes[:-1])
    return ["\n\n".join(t.decoded(o)) for t, o in zip(parsed, odds)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``."""
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    # Twice the sample in expectation goes on to the exact limit, whatever the number of pages.
    some = rows.where(share_of(F.struct("page_id", "url"), min(1.0, 2 * SAMPLE / max(rows.count(), 1))))
    sample = some.orderBy(F.xxhash64("page_id", "url"), "html").limit(SAMPLE).select(F.substring("html", 1, 100_000).alias("html"))
    shared = spark.sparkContext.broadcast(trained(sorted(r["html"] for r in sample.collect())))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            piece = (batch["html"].str.len().cumsum() // CHUNK_CHARS).to_numpy()
            for _, part in batch.groupby(piece, sort=False):
                texts = texts_of(part["html"].tolist(), shared.value)
                yield pd.DataFrame({
                    "page_id": part["page_id"].array, "url": part["url"].array, "text": texts, "n_chars": [len(t) for t in texts]})

    return rows.mapInPandas(read, LAYOUT)
