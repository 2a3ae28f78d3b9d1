"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled_pages import labelled_pages

# Element classes of the HTML standard; fixed values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = set("head script style noscript template title svg math iframe object select option textarea".split())
#: A start tag of the key ends an open element of its values.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "body": {"head"}}
SCOPES = set("ul ol dl table article section main aside nav header footer div form body html td th blockquote figure".split())
TELLING = set("cookie cookies subscribe newsletter share reply replies comments comment responses copyright login log sign menu advertisement sponsored privacy terms rights reserved related follow search skip".split())
DIM = 1 << 13


class Node:
    """An open element. Blocks share the chains of those above them, so a page of any depth is as large as its tags."""

    __slots__ = ("above", "own", "features", "score")

    def __init__(self, above: Node | None, own: str, features: list[str]):
        self.above, self.own, self.features, self.score = above, own, features, None

    def all_features(self) -> list[str]:
        """Those of all open elements, each once, the outermost first."""
        chain, at = [], self
        while at is not None:
            chain.append(at.features)
            at = at.above
        return [f for features in reversed(chain) for f in features]

    def summed(self, emission: np.ndarray) -> np.ndarray:
        """The weights of all features; found once for each element."""
        chain, at = [], self
        while at is not None and at.score is None:
            chain.append(at)
            at = at.above
        for node in reversed(chain):
            node.score = (node.above.score if node.above is not None else np.zeros(2)) + emission[[slot(f) for f in node.features]].sum(axis=0)
        return self.score


@dataclass
class Block:
    text: str
    node: Node | None
    linked: int


class Leaves(HTMLParser):
    """Collects runs of text between block boundaries, with their ancestors.

    Where each tag stands in the stack of open elements is kept, so that no tag has
    to search it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, list[str], Node]] = []
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.open: dict[str, int] = {}
        self.blocks: list[Block] = []
        self.run: list[str] = []
        self.linked, self.at, self.inked, self.unseen = 0, None, False, 0

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            self.blocks.append(Block(text, self.at, self.linked))
        self.run, self.linked, self.inked = [], 0, False

    def push(self, tag: str, names: list[str]) -> None:
        told = ([] if tag in INLINE else [f"tag {tag}"]) + [f"name {n}" for n in names]
        new = []
        for f in told:
            self.open[f] = self.open.get(f, 0) + 1
            if self.open[f] == 1:
                new.append(f)
        above = self.stack[-1][2] if self.stack else None
        own = tag if tag not in INLINE else above.own if above else "none"
        if tag in SCOPES:
            self.scopes.append(len(self.stack))
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, told, Node(above, own, new)))
        self.unseen += tag in UNSEEN

    def drop(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag, told, _ = self.stack.pop()
            self.places[tag].pop()
            if tag in SCOPES:
                self.scopes.pop()
            for f in told:
                self.open[f] -= 1
            self.unseen -= tag in UNSEEN

    def last(self, tag: str) -> int:
        return self.places[tag][-1] if self.places.get(tag) else -1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.run.append(" ")
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag not in INLINE:
            self.flush()
            ended = max(self.last(t) for t in ("p", *CLOSES.get(tag, ())))
            if ended >= 0 and ended >= (self.scopes[-1] if self.scopes else -1):
                self.drop(ended)
        self.push(tag, [n for k, v in attrs if k in ("class", "id", "role") and v for n in re.split(r"[^a-z]+", v.lower()) if n])

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        place = self.last(tag)
        if place >= 0 and (tag not in INLINE or place > (self.scopes[-1] if self.scopes else -1)):
            self.drop(place)

    def handle_data(self, data: str) -> None:
        if not self.unseen:
            if not self.inked:
                self.at, self.inked = (self.stack[-1][2] if self.stack else None), bool(data.strip())
            self.run.append(data)
            if self.last("a") >= 0:
                self.linked += len(data)


def leaf_blocks(html: str | None) -> list[Block]:
    """What can't be markup, for want of an end anywhere on the page, is text at once: the parser would look for the end anew at each beginning."""
    html = html or ""
    cut = html.rfind(">") + 1
    head, tail = html[:cut], html[cut:]
    closed = head.rfind("-->") + 3 if "-->" in head else 0
    parser = Leaves()
    parser.feed(head[:closed] + head[closed:].replace("<!--", "&lt;!--"))
    parser.close()
    if tail:
        parser.handle_data(unescape(tail))
    parser.flush()
    return parser.blocks


@lru_cache(1 << 16)
def slot(name: str) -> int:
    return crc32(name.encode()) % DIM


def bucket(n: float, *bounds: float) -> int:
    return sum(n >= b for b in bounds)


def local_features(blocks: list[Block]) -> list[list[str]]:
    """Features of each block's text and neighbours."""
    sizes = [bucket(b.text.count(" ") + 1, 2, 4, 9, 21, 51) for b in blocks]
    out = []
    for i, b in enumerate(blocks):
        own = b.node.own if b.node else "none"
        density = bucket(b.linked / max(1, len(b.text)), 0.01, 0.3, 0.7)
        words = {w for w in re.split(r"[^a-z]+", b.text[:400].lower()) if w in TELLING} if len(b.text) < 400 else set()
        names = [f"word {w}" for w in words]
        names += [f"own {own}", f"own {own} size {sizes[i]}", f"size {sizes[i]}", f"links {density}", f"stop {b.text[-1] in '.!?,;:'}", f"own {own} links {density}"]
        names += [f"copy {'©' in b.text or '(c)' in b.text.lower()}", f"place {bucket(i / len(blocks), 0.1, 0.5, 0.9)}", f"prev {sizes[i - 1] if i else 'none'}", f"next {sizes[i + 1] if i + 1 < len(blocks) else 'none'}", "bias"]
        out.append(names)
    return out


def described(blocks: list[Block]) -> list[list[int]]:
    """Feature slots of each block: ancestors and their names, and what the text is like."""
    return [[slot(n) for n in [*(b.node.all_features() if b.node else ()), *names]] for b, names in zip(blocks, local_features(blocks), strict=True)]


@dataclass
class Field:
    """Weights of a two-label chain: emission[slot, label] and transition[from, to]."""

    emission: np.ndarray
    transition: np.ndarray

    def scores(self, slots: list[list[int]]) -> np.ndarray:
        return np.array([self.emission[s].sum(axis=0) for s in slots])

    def block_scores(self, blocks: list[Block]) -> np.ndarray:
        """As ``scores`` of ``described``, what open elements add being found once for each of them."""
        own = [self.emission[[slot(n) for n in names]].sum(axis=0) for names in local_features(blocks)]
        return np.array([x + (b.node.summed(self.emission) if b.node else 0.0) for b, x in zip(blocks, own, strict=True)])

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(e)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[0] = e[0]
        for i in range(1, n):
            forward[i] = e[i] + np.logaddexp(forward[i - 1][0] + self.transition[0], forward[i - 1][1] + self.transition[1])
        for i in range(n - 2, -1, -1):
            x = e[i + 1] + backward[i + 1]
            backward[i] = np.logaddexp(self.transition[:, 0] + x[0], self.transition[:, 1] + x[1])
        z = np.logaddexp(*forward[-1])
        pairs = np.zeros((2, 2))
        for i in range(1, n):
            pairs += np.exp(forward[i - 1][:, None] + self.transition + (e[i] + backward[i])[None, :] - z)
        return np.exp(forward + backward - z), pairs

    def viterbi(self, e: np.ndarray) -> list[int]:
        best, back = e[0].tolist(), []
        t = self.transition.tolist()
        for x in e[1:].tolist():
            came = [0 if best[0] + t[0][y] >= best[1] + t[1][y] else 1 for y in (0, 1)]
            best = [best[came[y]] + t[came[y]][y] + x[y] for y in (0, 1)]
            back.append(came)
        path = [int(best[1] > best[0])]
        for came in reversed(back):
            path.append(came[path[-1]])
        return path[::-1]


def train(pages: list[tuple[str, list[tuple[str, bool]]]], epochs: int = 5, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Maximum conditional likelihood by AdaGrad, one page a step."""
    field = Field(np.zeros((DIM, 2)), np.zeros((2, 2)))
    seen, seen_t = np.full((DIM, 2), 1e-2), np.full((2, 2), 1e-2)
    data = []
    for html, labels in pages:
        blocks = leaf_blocks(html)
        if blocks and len(blocks) == len(labels):
            data.append((described(blocks), np.array([int(y) for _, y in labels])))
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for k in order.permutation(len(data)):
            slots, gold = data[k]
            unary, pairs = field.marginals(field.scores(slots))
            wrong = np.eye(2)[gold] - unary
            at = np.concatenate([np.array(s) for s in slots])
            g = np.zeros((DIM, 2))
            np.add.at(g, at, np.repeat(wrong, [len(s) for s in slots], axis=0))
            used = np.unique(at)
            g = g[used] - decay * field.emission[used]
            seen[used] += g * g
            field.emission[used] += rate * g / np.sqrt(seen[used])
            gt = -pairs
            np.add.at(gt, (gold[:-1], gold[1:]), 1.0)
            seen_t += gt * gt
            field.transition += rate * gt / np.sqrt(seen_t)
    return field


def main_text(field: Field, html: str | None) -> str:
    blocks = leaf_blocks(html)
    if not blocks:
        return ""
    path = field.viterbi(field.block_scores(blocks))
    return " ".join(b.text for b, y in zip(blocks, path, strict=True) if y)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", training: list | None = None) -> DataFrame:
    """All columns of ``pages`` but the html, with ``text`` and ``n_chars``, its code points.

    Each whole page is parsed into leaf blocks (runs of text between block-level
    boundaries, character references decoded, white space made one space); a chain
    field over features of ancestors and text, trained on labelled pages, labels
    them by its best path, and the content blocks are joined by one space.

    Null or empty html gives an empty text, as does a page without content. Pages
    count by themselves, so a null id or url stays and rows that repeat each other give
    equal rows. Time and memory go with a page's length, however deep or broken it is:
    what never closes is text from there on, and nothing of it is lost.
    Scripts, styles, comments and markup never enter. Rows stay where they are read;
    the weights (of fixed size) are broadcast. A column named like those added is
    replaced.
    """
    field = pages.sparkSession.sparkContext.broadcast(train(training or labelled_pages()))

    @F.pandas_udf("string")
    def text_of(html: pd.Series) -> pd.Series:
        return html.map(lambda x: main_text(field.value, x))

    kept = [F.col(f"`{c}`") for c in pages.columns if c not in (html_col, text_col, "n_chars")]
    out = pages.select(*kept, text_of(F.col(f"`{html_col}`")).alias(text_col))
    return out.withColumn("n_chars", F.char_length(text_col).cast("long"))
