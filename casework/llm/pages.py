"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of elements. Every element gets features of itself (tag, words of its
class and id), of its subtree (text, links, density, punctuation), of its place (depth, position,
siblings) and of the elements above it. Boosted trees give the odds that an element holds main
text; the tree is then decoded as a whole: an element can be kept only if its parent is, and the
choice with the largest total log-likelihood under that rule is found bottom-up, so an ancestor
and a descendant never contradict each other.

The trees are trained here on ``TRAIN_PAGES`` generated pages of many layouts, whose parts are
known; the number is the documented bound of the fit. The rows of the table are only scored.

Defined results: null, empty and unparsable pages give an empty text; a page cut off anywhere is
read as far as it goes; repeated rows each get their row; an empty table gives an empty result;
extra columns are not read. Reading takes time in proportion to the page, however deep or badly
closed it is.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm.common import slices

TRAIN_PAGES = 800
TREES, DEPTH, RATE, BINS = 60, 4, 0.3, 16

#: Elements without text of their own to show, or without an end. Fixed values of the HTML standard.
RAW = frozenset("script style textarea title noscript iframe template svg select option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr object canvas audio video math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover semantics annotation".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LISTS = ("ul", "ol", "dl", "table")

TAGS = "html body main article section div nav header footer aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure figcaption address button fieldset dialog details".split()
ABOVE = "main article nav header footer aside form li table dialog".split()
#: Groups of class, id and role words.
GROUPS = {
    "main": "article content main post entry story text body page document read prose column",
    "nav": "nav navigation menu navbar breadcrumb breadcrumbs pagination pager toc tabs topbar",
    "head": "header masthead head branding logo banner top site",
    "foot": "footer foot copyright legal bottom colophon",
    "side": "sidebar side aside widget related recommended trending popular more rail",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay privacy",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner2 adsense adslot",
    "comment": "comment comments reply replies discussion respond disqus reader feedback",
    "form": "form newsletter subscribe signup login search input contact",
    "share": "share social sharing follow buttons",
}
_GROUP_OF: dict[str, list[int]] = {}
for _i, _words in enumerate(GROUPS.values()):
    for _w in _words.split():
        _GROUP_OF.setdefault(_w, []).append(_i)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|[^<]+|<", re.S)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|\Z)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*|[0-9]+")
_MARKS = re.compile(r"[.,;:!?…。、]")


class Page:
    """Elements in page order (``tag, parent, names, hidden``) and text blocks (``owner, text``)."""

    def __init__(self, html: str):
        self.tag, self.parent, self.names, self.hidden = ["html"], [-1], [()], [False]
        self.block_owner: list[int] = []
        self.block_text: list[str] = []
        self.block_link: list[int] = []
        self.block_words: list[int] = []
        self._read(html)

    def _read(self, html: str) -> None:
        stack = [0]  # block elements only; inline elements are part of their block
        places: dict[str, list[int]] = {}  # open elements of each tag, by their place in the stack
        buffer: list[str] = []
        linked, in_link = 0, 0
        at, end = 0, len(html)
        match = _TOKEN.match

        def last(tags: Iterable[str]) -> int:
            return max((places[t][-1] for t in tags if places.get(t)), default=0)

        def close(place: int) -> None:
            while len(stack) > place:
                places[self.tag[stack.pop()]].pop()

        def flush() -> None:
            nonlocal linked
            if buffer:
                words = "".join(buffer).split()
                if words:
                    text = " ".join(words)
                    self.block_owner.append(stack[-1])
                    self.block_text.append(text)
                    self.block_link.append(min(linked, len(text)))
                    self.block_words.append(len(words))
                buffer.clear()
            linked = 0

        while at < end:
            m = match(html, at)
            at = m.end()
            name = m[2]
            if name is None:
                piece = m[0]
                if piece[0] == "<" and len(piece) > 1:
                    continue
                piece = entities.unescape(piece)
                buffer.append(piece)
                if in_link:
                    linked += len(piece.strip())
                continue
            tag, closing = name.lower(), m[1]
            if tag in RAW:
                if not closing and not m[3].endswith("/"):
                    stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                    at = stop.end() if stop else end
                continue
            if tag in INLINE:
                if tag == "a":
                    in_link = 0 if closing else 1
                elif tag in ("br", "img"):
                    buffer.append(" ")
                continue
            flush()
            in_link = 0
            if closing:
                if places.get(tag):
                    close(places[tag][-1])
                continue
            if tag == "head" or tag == "html":
                continue
            closes = CLOSES_OWN.get(tag)
            if closes:
                place = last(closes)
                if place > last(LISTS):
                    close(place)
            elif tag in CLOSES_P and self.tag[stack[-1]] == "p":
                close(len(stack) - 1)
            if tag in VOID:
                continue
            attributes = m[3]
            names: set[int] = set()
            hidden = False
            if attributes and not attributes.isspace():
                for value in _NAMES.findall(attributes):
                    for word in _WORD.findall(value):
                        names.update(_GROUP_OF.get(word.lower(), ()))
                hidden = bool(_HIDDEN.search(attributes))
            self.tag.append(tag)
            self.parent.append(stack[-1])
            self.names.append(tuple(names))
            self.hidden.append(hidden)
            if not m[3].endswith("/"):
                places.setdefault(tag, []).append(len(stack))
                stack.append(len(self.tag) - 1)
        flush()

    def features(self) -> np.ndarray:
        n = len(self.tag)
        parent = self.parent
        chars, links, words, blocks, marks = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        own, long = [0] * n, [0] * n
        for owner, text, link, count in zip(self.block_owner, self.block_text, self.block_link, self.block_words):
            size = len(text)
            chars[owner] += size
            own[owner] += size
            links[owner] += link
            words[owner] += count
            blocks[owner] += 1
            marks[owner] += len(_MARKS.findall(text))
            long[owner] += size > 120
        size, paragraphs, forms = [1] * n, [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            p = parent[i]
            chars[p] += chars[i]
            links[p] += links[i]
            words[p] += words[i]
            blocks[p] += blocks[i]
            marks[p] += marks[i]
            long[p] += long[i]
            size[p] += size[i]
            paragraphs[i] += self.tag[i] == "p"
            paragraphs[p] += paragraphs[i]
            forms[i] += self.tag[i] in ("form", "button", "fieldset")
            forms[p] += forms[i]
        depth, place, siblings, seen = [0] * n, [0] * n, [0] * n, [0] * n
        above = np.zeros((n, len(ABOVE) + len(GROUPS) + 1), dtype=np.float32)
        mine = np.zeros((n, len(TAGS) + len(GROUPS)), dtype=np.float32)
        for i in range(n):
            if i:
                p = parent[i]
                depth[i] = depth[p] + 1
                place[i] = seen[p]
                seen[p] += 1
                above[i] = above[p]
                if self.tag[p] in _ABOVE_AT:
                    above[i, _ABOVE_AT[self.tag[p]]] = 1
                for g in self.names[p]:
                    above[i, len(ABOVE) + g] = 1
                above[i, -1] = max(above[p, -1], self.hidden[i])
            if self.tag[i] in _TAG_AT:
                mine[i, _TAG_AT[self.tag[i]]] = 1
            for g in self.names[i]:
                mine[i, len(TAGS) + g] = 1
        for i in range(1, n):
            siblings[i] = seen[parent[i]]
        total = max(chars[0], 1)
        up = [max(chars[p], 1) if p >= 0 else total for p in parent]
        c = np.asarray(chars, dtype=np.float32)
        s = np.asarray(size, dtype=np.float32)
        numbers = np.column_stack([
            np.log1p(c), np.log1p(own), np.asarray(links) / np.maximum(c, 1), c / s, np.asarray(marks) / np.maximum(words, 1), c / np.maximum(blocks, 1),
            c / total, c / np.asarray(up), paragraphs, long, forms, np.log1p(s), depth, place, siblings,
            np.asarray(place) / np.maximum(siblings, 1), np.arange(n) / n, c / np.maximum(words, 1),
        ]).astype(np.float32)
        return np.hstack([numbers, mine, above])

    def decode(self, odds: np.ndarray) -> str:
        """Blocks of the elements kept by the best consistent choice."""
        n = len(self.tag)
        keep, drop = odds.tolist(), (-odds).tolist()
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            keep[p] += max(keep[i], drop[i])
            drop[p] += drop[i]
        kept = [False] * n
        kept[0] = keep[0] > drop[0]
        for i in range(1, n):
            kept[i] = kept[self.parent[i]] and keep[i] > drop[i]
        return "\n".join(t for o, t in zip(self.block_owner, self.block_text) if kept[o])


_TAG_AT = {t: i for i, t in enumerate(TAGS)}
_ABOVE_AT = {t: i for i, t in enumerate(ABOVE)}


class Boosted:
    """Gradient-boosted regression trees for the log-odds of a yes/no label, level by level over binned features."""

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        binned = np.column_stack([np.searchsorted(e, column, side="right") for e, column in zip(self.edges, x.T)])
        rows, columns = binned.shape
        flat = binned + np.arange(columns) * BINS
        self.base = float(np.log(weight[y == 1].sum() / weight[y == 0].sum()))
        odds, self.trees = np.full(rows, self.base), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-odds))
            gradient, curve = (y - p) * weight, np.maximum(p * (1 - p) * weight, 1e-6)
            node = np.zeros(rows, dtype=np.int64)
            feature, cut = np.zeros(2**DEPTH - 1, dtype=np.int64), np.full(2**DEPTH - 1, BINS)
            for level in range(DEPTH):
                for k in range(2**level):
                    here = np.flatnonzero(node == k)
                    at = 2**level - 1 + k
                    if len(here) < 20:
                        continue
                    cells = flat[here].ravel()
                    g = np.bincount(cells, np.repeat(gradient[here], columns), columns * BINS).reshape(columns, BINS).cumsum(1)
                    h = np.bincount(cells, np.repeat(curve[here], columns), columns * BINS).reshape(columns, BINS).cumsum(1)
                    gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1)
                    best = int(np.argmax(gain[:, :-1]))
                    feature[at], cut[at] = divmod(best, BINS - 1)
                at = 2**level - 1 + node
                node = 2 * node + (binned[np.arange(rows), feature[at]] > cut[at])
            g = np.bincount(node, gradient, 2**DEPTH)
            h = np.bincount(node, curve, 2**DEPTH)
            leaf = RATE * g / (h + 1)
            odds += leaf[node]
            self.trees.append((feature, cut, leaf))
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        binned = np.column_stack([np.searchsorted(e, column, side="right").astype(np.int8) for e, column in zip(self.edges, x.T)])
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for level in range(DEPTH):
                at = 2**level - 1 + node
                node = 2 * node + (binned[rows, feature[at]] > cut[at])
            out += leaf[node]
        return out


@cache
def _vocabulary() -> list[str]:
    """Made-up words, some with a mark at the end."""
    rng, letters = np.random.default_rng(5), list("abcdefghijklmnoprstuvwäéñ")
    found = ["".join(rng.choice(letters, int(rng.integers(2, 10)))) for _ in range(1500)]
    return [w + ("." if i % 10 == 0 else "," if i % 12 == 1 else "") for i, w in enumerate(found)]


def generated_page(rng: np.random.Generator) -> tuple[str, str]:
    """A page of a random layout, and its main text."""
    vocabulary = _vocabulary()

    def words(low: int, high: int) -> str:
        return " ".join([vocabulary[i] for i in rng.integers(0, len(vocabulary), int(rng.integers(low, high + 1)))])

    pick = lambda *options: options[int(rng.integers(len(options)))]
    maybe = lambda p, text: text if rng.random() < p else ""
    main: list[str] = []

    def block(tag: str, low: int, high: int) -> str:
        text = words(low, high)
        main.append(text)
        body = pick(text, text, f"<b>{text}</b>", text.replace(" ", " <a href='/x'>", 1) + "</a>" if " " in text else text)
        return f"<{tag}>{body}" + pick(f"</{tag}>", f"</{tag}>", "" if tag in ("p", "li") else f"</{tag}>")

    def links(n: int, tag: str = "li") -> str:
        inner = "".join(f"<{tag}><a href='/{i}'>{words(1, 3)}</a></{tag}>" for i in range(n))
        return f"<ul>{inner}</ul>" if tag == "li" else inner

    def side(kind: str) -> str:
        if kind == "ad":
            return f"<div class='{pick('ad', 'ads', 'advert', 'sponsored', 'promo', 'ad-slot')}'>{pick('', '<p>')}{words(3, 40)}</div>"
        if kind == "notice":
            return f"<div {pick('class', 'id')}='{pick('cookie-notice', 'consent', 'notice', 'gdpr-banner', 'cookie-bar')}'><p>{words(8, 30)}</p><button>{words(1, 2)}</button></div>"
        if kind == "form":
            return f"<form class='{pick('newsletter', 'subscribe', 'search', 'login', '')}'><p>{words(2, 15)}</p><label>{words(1, 3)}</label><input><button>{words(1, 2)}</button></form>"
        if kind == "share":
            return f"<div class='{pick('share', 'social-buttons', 'sharing')}'>{links(4, 'span')}</div>"
        if kind == "comments":
            one = lambda: f"<{pick('div', 'li', 'div')} class='{pick('comment', 'comment-body', 'reply')}'>{maybe(0.6, '<h4>' + words(1, 3) + '</h4>')}<p>{words(5, 60)}</p></div>"
            return f"<{pick('section', 'div')} {pick('id', 'class')}='{pick('comments', 'discussion', 'reader-comments', 'respond')}'><h3>{words(1, 3)}</h3>" + "".join(one() for _ in range(int(rng.integers(1, 6)))) + pick("</section>", "</div>")
        if kind == "aside":
            return f"<{pick('aside', 'div')} class='{pick('sidebar', 'side', 'related', 'widget')}'><h3>{words(1, 4)}</h3>{maybe(0.7, links(4))}{maybe(0.6, '<p>' + words(5, 50) + '</p>')}" + pick("</aside>", "</div>")
        return ""

    def header() -> str:
        name = pick("<header>{}</header>", "<div class='header'>{}</div>", "<div id='masthead'>{}</div>")
        return name.format(f"<{pick('div', 'p', 'h2')}>{words(1, 8)}</{pick('div', 'p', 'h2')}>" + maybe(0.4, f"<p>{words(3, 10)}</p>"))

    def nav() -> str:
        return pick("<nav>{}</nav>", "<div class='menu'>{}</div>", "<ul class='nav'>{}</ul>", "<nav class='breadcrumb'>{}</nav>").format(links(int(rng.integers(3, 9)), pick("li", "li", "span")))

    def article() -> str:
        opening, closing = pick(("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ("<div class='content'>", "</div>"), ("<div id='main'>", "</div>"), ("<div class='post-body'>", "</div>"), ("<section class='entry'>", "</section>"), ("<div class='story'><div class='text'>", "</div></div>"), ("<div>", "</div>"))
        out = [opening]
        if rng.random() < 0.8:
            out.append(maybe(0.15, "<header>") + block("h1", 2, 12))
        brief = rng.random() < 0.25
        for _ in range(1 if brief else int(rng.integers(1, 12))):
            kind = 0.0 if brief else rng.random()
            if kind < 0.72:
                out.append(block("p", 1, int(rng.choice([12, 40, 150]))) if brief or rng.random() < 0.15 else block("p", 8, 120))
            elif kind < 0.8:
                out.append(block(pick("h2", "h3"), 1, 8))
            elif kind < 0.88:
                out.append(f"<{pick('ul', 'ol')}>" + "".join(block("li", 2, 20) for _ in range(int(rng.integers(2, 6)))) + pick("</ul>", "</ol>"))
            elif kind < 0.92:
                out.append("<blockquote>" + block("p", 5, 40) + "</blockquote>")
            elif kind < 0.95:
                out.append("<table>" + "".join("<tr>" + block("td", 1, 6) + block("td", 1, 6) + "</tr>" for _ in range(3)) + "</table>")
            else:
                out.append(block("pre", 4, 30))
            if rng.random() < 0.08:
                out.append(side(pick("ad", "aside", "form", "share", "notice")))
        out.append(maybe(0.1, side("comments")) + closing)
        return "".join(out)

    head = f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title><style>p{{}}</style><script>x('<p>')</script></head><body>"
    top = [maybe(0.4, side("notice")), maybe(0.5, header()), maybe(0.8, nav()), maybe(0.5, side("ad")), maybe(0.25, side("aside"))]
    rng.shuffle(top)
    end = [maybe(0.3, side("comments")), maybe(0.3, side("aside")), maybe(0.3, side("ad")), maybe(0.3, side("form")), maybe(0.2, side("share"))]
    footer = maybe(0.8, pick("<footer>{}</footer>", "<footer>&copy; {}</footer>", "<div class='footer'><p>{}</p></div>", "<div id='footer'>{}</div>").format(words(2, 40) + maybe(0.3, links(4, "span"))))
    wrap = pick(("", ""), ("", ""), ("<div class='wrapper'>", "</div>"), ("<div id='page'><div class='container'>", "</div></div>"))
    page = head + wrap[0] + "".join(top) + article() + "".join(end) + wrap[1] + footer + maybe(0.85, "</body></html>")
    return page, "\n".join(" ".join(m.split()) for m in main)


@cache
def train(pages: int = TRAIN_PAGES, seed: int = 11) -> Boosted:
    """Trees fitted on ``pages`` generated pages; a block's label is whether it is main text."""
    rng = np.random.default_rng(seed)
    xs, ys, ws = [], [], []
    for _ in range(pages):
        html, text = generated_page(rng)
        page, expected = Page(html), set(text.split("\n"))
        good = [0] * len(page.tag)
        bad = [0] * len(page.tag)
        for owner, line in zip(page.block_owner, page.block_text):
            (good if line in expected else bad)[owner] += len(line)
        direct = [g + b for g, b in zip(good, bad)]
        for i in range(len(page.tag) - 1, 0, -1):
            good[page.parent[i]] += good[i]
        xs.append(page.features())
        ys += [g > 0 for g in good]
        ws += [0.5 + 1.5 * (d > 0) for d in direct]
    x, y, w = np.vstack(xs), np.asarray(ys, dtype=np.float64), np.asarray(ws)
    return Boosted().fit(x, y, w)


def extract_batch(pages: Sequence[str | None], model: Boosted) -> list[str]:
    """Main texts of some pages."""
    parsed = [Page(p or "") for p in pages]
    features = [p.features() for p in parsed]
    odds = model.odds(np.vstack(features)) if features else np.zeros(0)
    ends = np.cumsum([len(f) for f in features])
    return [p.decode(odds[end - len(p.tag) : end]) for p, end in zip(parsed, ends)]


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", model: Boosted | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``."""
    model = model or train()
    slim = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            texts = extract_batch(batch.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op4_pages(spark, sf_dir):
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
