"""Main text of web pages: boosted trees over DOM nodes, decoded so that the tree never contradicts itself.

A page becomes a tree of block elements; every run of text between block boundaries is a leaf. Each node gets features:
text and link density of its subtree, its place and depth, what its siblings look like, and how its tag, attribute tokens and
those of its ancestors are spread between main text and the rest in training. Gradient-boosted regression trees
(logistic loss, histogram splits) give each node the probability that its subtree holds main text. Decoding then
chooses labels of the largest total likelihood such that nothing inside a rejected node is accepted and an accepted
element holds accepted text.

No table labels pages, so the model is fitted on pages whose labels are known by construction: page layouts drawn from
``BOILERPLATE`` and ``MAIN`` names, filled with paragraphs of a bounded sample of the table's own pages (``SAMPLE`` pages of at
most ``SAMPLE_BYTES`` bytes, smallest hash of page_id first). Extraction covers every page and its whole html.

Scripts, styles, comments and form controls hold no text by definition. Character references are decoded; white space inside
a block becomes one space; blocks are joined by a newline.

Defined cases: null and empty pages give the empty text; broken or cut-off markup is read as far as it goes, open elements
ending with the page; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cellweave.llm.common import small_batches

SAMPLE, SAMPLE_BYTES, LAYOUTS = 200, 65_536, 900
TREES, DEPTH, RATE, BINS, LEAF = 60, 4, 0.25, 32, 20.0

#: Names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("script style template noscript title textarea select button iframe object svg math canvas audio video".split())
#: An element of the first kind ends when one of the second begins beside it.
IMPLIED_END = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",),
}
#: Names that layouts give to what is not the article, and to what is.
BOILERPLATE = {
    "nav": "nav menu navbar navigation main-menu breadcrumb breadcrumbs topbar tabs pagination pager toc skip-links",
    "header": "header site-header masthead branding logo banner top page-header hero",
    "footer": "footer site-footer copyright colophon bottom legal credits page-footer",
    "aside": "sidebar aside widget widget-area rail related related-posts recommended trending popular tags archive blogroll categories",
    "ad": "ad ads advert advertisement sponsor sponsored promo promoted adsense ad-slot commercial outbrain taboola",
    "notice": "cookie cookie-notice cookie-banner consent gdpr alert notice notification popup modal overlay subscribe newsletter paywall disclaimer",
    "share": "share social social-share sharing follow author-bio byline meta post-meta toolbar",
    "comments": "comments comment comment-list comment-body responses discussion replies disqus thread user-comments reader-comments feedback",
    "form": "search search-form login signup contact-form form comment-form respond",
}
MAIN = "content article post entry story main text body article-body post-content entry-content main-content story-body page-content article-text post-body maincontent"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S
)
_ATTR = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_STOPS = re.compile(r"[.!?…]").findall


@dataclass
class Tree:
    """Nodes in page order, parents before children; a leaf has its text and no tag but ``#text``."""

    tags: list[str] = field(default_factory=list)
    names: list[tuple[str, ...]] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    marks: list[int | None] = field(default_factory=list)

    def add(self, tag: str, names: tuple[str, ...], parent: int, text: str = "", links: int = 0, mark: int | None = None) -> int:
        for own, value in zip((self.tags, self.names, self.parents, self.texts, self.links, self.marks), (tag, names, parent, text, links, mark), strict=True):
            own.append(value)
        return len(self.tags) - 1


def _names(attributes: str) -> tuple[str, ...]:
    """Attribute tokens, whole and by word: ``cookie-notice`` also says ``cookie`` and ``notice``."""
    out: dict[str, None] = {}
    for groups in _ATTR.findall(attributes):
        for token in "".join(groups).lower().replace("_", "-").split():
            out[token] = None
            out.update(dict.fromkeys(_NAME.findall(token)))
    return tuple(out)


def parse(page: str) -> Tree:
    tree = Tree()
    root = tree.add("html", (), -1)
    stack, run, in_link, link_chars = [root], [], 0, 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join("".join(run).split())
        if text:
            tree.add("#text", (), stack[-1], text, link_chars)
        run.clear()
        link_chars = 0

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            piece = html.unescape(page[at:stop])
            run.append(piece)
            if in_link:
                link_chars += len(piece.strip())
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if tag in NO_TEXT:
            if not closing and not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = close.end() if close else end
            if tag not in ("script", "style", "template"):
                run.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            continue
        flush()
        if closing:
            if tag == "p" and not any(tree.tags[k] == "p" for k in stack):
                continue
            for k in range(len(stack) - 1, 0, -1):
                if tree.tags[stack[k]] == tag:
                    del stack[k:]
                    break
            continue
        if tag in ("html", "body") and len(stack) == 1 and tag == "html" or tag in VOID:
            continue
        if tree.tags[stack[-1]] == "p":
            stack.pop()
        for k in range(len(stack) - 1, 0, -1):
            here = tree.tags[stack[k]]
            if here in IMPLIED_END.get(tag, ()):
                break
            if here == tag and tag in IMPLIED_END or {here, tag} == {"dt", "dd"} or {here, tag} == {"td", "th"}:
                del stack[k:]
                break
        mark = 1 if 'data-main="1"' in attributes else 0 if 'data-main="0"' in attributes else None
        stack.append(tree.add(tag, _names(attributes), stack[-1], mark=mark))
    flush()
    return tree


@dataclass
class Spread:
    """Log odds of tags and attribute tokens in main text."""

    odds: dict[str, float]

    def of(self, tag: str, names: tuple[str, ...]) -> tuple[float, float, float]:
        found = [self.odds[n] for n in names if n in self.odds]
        return self.odds.get("<" + tag, 0.0), min(found, default=0.0), max(found, default=0.0)


FEATURES = 27


def node_features(tree: Tree, spread: Spread) -> np.ndarray:
    n = len(tree.tags)
    chars, links, stops, runs, size = ([0] * n for _ in range(5))
    children: dict[int, list[int]] = defaultdict(list)
    for i in range(n):
        if tree.tags[i] == "#text":
            chars[i], links[i], stops[i], runs[i] = len(tree.texts[i]), tree.links[i], len(_STOPS(tree.texts[i])), 1
        if i:
            children[tree.parents[i]].append(i)
    longest = chars.copy()
    for i in range(n - 1, 0, -1):
        p = tree.parents[i]
        for sums in (chars, links, stops, runs):
            sums[p] += sums[i]
        size[p] += size[i] + 1
        longest[p] = max(longest[p], longest[i])
    place, same, mean = [0] * n, [1.0] * n, [float(chars[0])] * n
    for own in children.values():
        tags, average = Counter(tree.tags[k] for k in own), sum(chars[k] for k in own) / len(own)
        for k, i in enumerate(own):
            place[i], same[i], mean[i] = k, tags[tree.tags[i]] / len(own), average
    rows = np.zeros((n, FEATURES))
    depth, inherited, before = [0] * n, [(0.0, 0.0, 0.0, 0.0)] * n, 0
    total = max(chars[0], 1)
    for i in range(n):
        p, k = tree.parents[i], place[i]
        tag, low, high = spread.of(tree.tags[i], tree.names[i])
        up = inherited[p] if i else (0.0, 0.0, 0.0, 0.0)
        inherited[i] = (min(up[0], tag), max(up[1], tag), min(up[2], low), max(up[3], high))
        depth[i] = depth[p] + 1 if i else 0
        own = children[p] if i else [0]
        left, right = (own[k - 1] if k else -1), (own[k + 1] if k + 1 < len(own) else -1)
        c = chars[i]
        rows[i] = (
            tag, low, high, *up, np.log1p(c), links[i] / (c + 1), stops[i] / (c + 10), np.log1p(runs[i]), np.log1p(size[i]),
            np.log1p(c / (runs[i] + 0.01)), np.log1p(longest[i]), c / total, c / (chars[p] + 1) if i else 1.0, depth[i], before / total, len(children[i]),
            len(own), k / len(own), same[i], np.log1p(mean[i]), np.log1p(chars[left]) if left >= 0 else -1.0,
            np.log1p(chars[right]) if right >= 0 else -1.0, links[p] / (chars[p] + 1) if i else 0.0, float(tree.tags[i] == "#text"),
        )
        if tree.tags[i] == "#text":
            before += c
    return rows


def node_labels(tree: Tree) -> np.ndarray:
    """Of a marked page: whether a node's subtree holds main text."""
    n = len(tree.tags)
    state, out = [0] * n, np.zeros(n, int)
    for i in range(n):
        mark = tree.marks[i]
        state[i] = mark if mark is not None else (state[tree.parents[i]] if i else 0)
        if tree.tags[i] == "#text" and state[i]:
            out[i] = 1
    for i in range(n - 1, 0, -1):
        out[tree.parents[i]] |= out[i]
    return out


@dataclass
class BoostedTrees:
    """Complete binary trees, level by level: feature and threshold of each split, value of each leaf."""

    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, value in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - (2**DEPTH - 1)]
        return out


def fit_boosted_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, ridge: float = 1.0) -> BoostedTrees:
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = BoostedTrees(float(np.log(mean / (1 - mean))))
    margin, rows = np.full(len(x), model.base), np.arange(len(x))
    splits = 2**DEPTH - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, threshold, place = np.zeros(splits, int), np.full(splits, np.inf), np.zeros(splits, int)
        at = np.zeros(len(x), int)
        for level in range(DEPTH):
            first = 2**level - 1
            node, count = at - first, 2**level
            best = np.full(count, 1e-6)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                key = node * (BINS + 1) + binned[:, j]
                gs = np.bincount(key, g, count * (BINS + 1)).reshape(count, -1).cumsum(1)
                hs = np.bincount(key, h, count * (BINS + 1)).reshape(count, -1).cumsum(1)
                gl, hl, gt, ht = gs[:, : len(e)], hs[:, : len(e)], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(hl < LEAF / 20) | (ht - hl < LEAF / 20)] = 0
                k = gain.argmax(1)
                better = gain[np.arange(count), k] > best
                best[better] = gain[np.arange(count), k][better]
                chosen = first + np.flatnonzero(better)
                feature[chosen], threshold[chosen], place[chosen] = j, e[k[better]], k[better]
            right = (binned[rows, feature[at]] > place[at]) & np.isfinite(threshold[at])
            at = 2 * at + 1 + right
        leaf = at - splits
        value = RATE * np.bincount(leaf, g, splits + 1) / (np.bincount(leaf, h, splits + 1) + ridge)
        model.trees.append((feature, threshold, value))
        margin += value[leaf]
    return model


def decode(tree: Tree, margin: np.ndarray) -> list[bool]:
    """Labels of the largest likelihood in which rejected nodes hold nothing accepted."""
    yes, no = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)
    n = len(tree.tags)
    none, best, some = no.copy(), np.zeros(n), np.full(n, -np.inf)
    # none: all of the subtree rejected. best: node accepted, children as is best; some: how much the best loses by accepting a child.
    gained = np.zeros(n)
    for i in range(n - 1, -1, -1):
        if tree.tags[i] == "#text":
            best[i] = yes[i]
        else:
            best[i] = yes[i] + gained[i] + min(0.0, some[i]) if np.isfinite(some[i]) else -np.inf
        if i:
            p = tree.parents[i]
            none[p] += none[i]
            gained[p] += max(best[i], none[i])
            some[p] = max(some[p], best[i] - none[i])
    out = [False] * n
    forced = [False] * n
    children: dict[int, list[int]] = defaultdict(list)
    for i in range(1, n):
        children[tree.parents[i]].append(i)
    for i in range(n):
        if i == 0:
            out[i] = best[i] > none[i]
        else:
            out[i] = out[tree.parents[i]] and (best[i] > none[i] or forced[i])
        if out[i] and children[i] and not any(best[k] > none[k] for k in children[i]):
            forced[max(children[i], key=lambda k: best[k] - none[k])] = True
    return out


@dataclass
class Extractor:
    spread: Spread
    trees: BoostedTrees

    def __call__(self, pages: list[str]) -> list[str]:
        parsed = [parse(p) for p in pages]
        features = [node_features(t, self.spread) for t in parsed]
        margins = self.trees.margin(np.concatenate(features)) if features else np.empty(0)
        out, at = [], 0
        for tree in parsed:
            n = len(tree.tags)
            chosen = decode(tree, margins[at : at + n])
            out.append("\n".join(t for t, tag, own in zip(tree.texts, tree.tags, chosen, strict=True) if own and tag == "#text"))
            at += n
        return out


class Layouts:
    """Pages of known labels: drawn layouts, filled with given paragraphs."""

    def __init__(self, paragraphs: list[str], seed: int = 5):
        self.rng = random.Random(seed)
        self.paragraphs = paragraphs or ["Nothing is known about the words of these pages yet, so this line stands in for them."]
        self.words = sorted({w for p in self.paragraphs for w in p.split()[:40]})[:20_000]

    def some(self, low: int, high: int) -> str:
        return html.escape(" ".join(self.rng.choice(self.words) for _ in range(self.rng.randint(low, high))))

    def paragraph(self) -> str:
        p = self.rng.choice(self.paragraphs)
        kind = self.rng.random()
        if kind < 0.12:
            p = " ".join(p.split()[: self.rng.randint(1, 6)])
        elif kind < 0.3:
            p = " ".join(p.split()[: self.rng.randint(5, 25)])
        p = html.escape(p)
        if self.rng.random() < 0.15:
            words = p.split()
            k = self.rng.randrange(len(words)) if words else 0
            words[k : k + 1] = [f'<a href="/x">{" ".join(words[k : k + 1])}</a>']
            p = " ".join(words)
        return p

    def named(self, kind: str) -> str:
        name = self.rng.choice(BOILERPLATE[kind].split())
        return self.rng.choice([f'class="{name}"', f'id="{name}"', f'class="{name} {self.some(1, 1)[:6]}-{self.rng.randint(1, 9)}"', f'class="box" id="{name}"'])

    def links(self, low: int = 2, high: int = 9) -> str:
        items = [f'<a href="/{i}">{self.some(1, 4)}</a>' for i in range(self.rng.randint(low, high))]
        return self.rng.choice(["<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", " | ".join(items), "".join(f"<div>{i}</div>" for i in items)])

    def boilerplate(self, kind: str) -> str:
        rng = self.rng
        tag = rng.choice({"nav": ["nav", "nav", "div", "ul"], "header": ["header", "header", "div"], "footer": ["footer", "footer", "div"], "aside": ["aside", "aside", "div", "section"], "form": ["form", "form", "div"], "comments": ["section", "div", "div", "aside", "ol"]}.get(kind, ["div", "div", "section", "aside", "p"]))
        bare = tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.6
        inside = {
            "nav": lambda: self.links(),
            "header": lambda: f"<{rng.choice(['h1', 'h2', 'div', 'p'])}>{self.some(1, 5)}" + rng.choice(["", self.links(1, 4)]),
            "footer": lambda: rng.choice(["&copy; ", "Copyright 2024 ", ""]) + rng.choice([self.some(2, 8) + " &middot; " + self.paragraph(), self.some(3, 12), f"<p>{self.some(2, 9)}</p>" + self.links(1, 5)]),
            "aside": lambda: f"<h3>{self.some(1, 4)}</h3>" + rng.choice([self.links(), f"<p>{self.paragraph()}</p>", self.links(1, 3) + f"<p>{self.some(5, 25)}</p>"]),
            "ad": lambda: rng.choice([self.some(3, 14), self.paragraph(), f"<p>{self.some(3, 20)}</p>", f'<a href="/ad">{self.some(2, 9)}</a>']),
            "notice": lambda: f"<p>{rng.choice([self.some(5, 30), self.paragraph()])}</p>" + rng.choice(["", "<button>OK</button>", '<a href="/ok">OK</a>']),
            "share": lambda: rng.choice([self.links(1, 5), f"<span>{self.some(1, 6)}</span>", f"<p>{self.some(3, 15)}</p>"]),
            "comments": lambda: rng.choice(["", f"<h3>{self.some(1, 3)}</h3>"]) + "".join(f'<{d} class="{rng.choice(["comment", "reply", "c", "item", "comment-body"])}">{rng.choice(["", f"<b>{self.some(1, 2)}</b>", f"<span>{self.some(1, 2)}</span>"])}{rng.choice(["<p>", "", "<p>"])}{self.paragraph()}</{d}>' for d in [rng.choice(["div", "li", "article", "div"])] for _ in range(rng.randint(1, 6))),
            "form": lambda: f"<label>{self.some(1, 4)}</label><input type=text>" + rng.choice(["", f"<p>{self.some(2, 14)}</p>", "<button>Go</button>"]),
        }[kind]()
        name = "" if bare else " " + self.named(kind)
        return f'<{tag}{name} data-main="0">{inside}</{tag}>'

    def page(self) -> str:
        rng, kinds = self.rng, list(BOILERPLATE)
        body = []
        if rng.random() < 0.85:
            level = rng.choice(["h1", "h1", "h2"])
            body.append(f"<{level}>{self.some(3, 10)}</{level}>")
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 14, 25])):
            body.append(
                rng.choices(
                    [f"<p>{self.paragraph()}</p>", f"<p><b>{self.paragraph()}<br><p>{self.paragraph()}</p>", f"<h2>{self.some(2, 7)}</h2>", "<ul>" + "".join(f"<li>{self.some(3, 18)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>", f"<blockquote>{self.paragraph()}</blockquote>", f"<div>{self.paragraph()}</div>", f"<table><tr><td>{self.some(1, 5)}<td>{self.some(1, 5)}</table>", f"<pre>{self.paragraph()}</pre>"],
                    [12, 3, 2, 1.5, 1, 2, 0.5, 0.5],
                )[0]
            )
            if rng.random() < 0.08:
                body.append(self.boilerplate(rng.choice(["ad", "share", "notice", "aside", "form", "nav"])))
        names = MAIN.split()
        tag = rng.choice(["article", "article", "main", "div", "div", "section", "td"])
        name = f' class="{rng.choice(names)}"' if tag in ("div", "section", "td") and rng.random() < 0.85 or rng.random() < 0.3 else ""
        main = f'<{tag}{name} data-main="1">{"".join(body)}</{tag}>'
        bare = rng.random()
        if bare < 0.02:
            return f'<body data-main="1">{self.paragraph()}'
        if bare < 0.08:  # no element of its own
            main = "".join(body)
        if bare >= 0.08 and rng.random() < 0.3:
            main = f'<div class="{rng.choice(["wrap", "container", "row", "layout", "page", "inner", "column"])}">{main}' + (self.boilerplate("aside") if rng.random() < 0.5 else "") + "</div>"
        if bare >= 0.08 and rng.random() < 0.2:
            main = f'<main>{main}{self.boilerplate("comments") if rng.random() < 0.5 else ""}</main>'
        above = [self.boilerplate(k) for k in rng.sample(["nav", "header", "ad", "notice", "nav", "aside", "share", "form"], rng.randint(0, 5))]
        below = [self.boilerplate(k) for k in rng.sample([*kinds, "comments", "footer"], rng.randint(0, 6))]
        if rng.random() < 0.7:
            below.append(self.boilerplate("footer"))
        end = "</body></html>" if rng.random() < 0.9 else ""
        start = ' data-main="1"' if bare < 0.08 else ""
        return f"<html><head><title>x</title></head><body{start}>" + "".join(above) + main + "".join(below) + end


def fit_extractor(paragraphs: list[str], layouts: int = LAYOUTS) -> Extractor:
    maker = Layouts(paragraphs)
    trees = [parse(maker.page()) for _ in range(layouts)]
    labels = [node_labels(t) for t in trees]
    main, rest = Counter(), Counter()
    for tree, own in zip(trees, labels, strict=True):
        for tag, names, y in zip(tree.tags, tree.names, own, strict=True):
            (main if y else rest).update(["<" + tag, *names])
    for name in MAIN.split():
        main[name] += 3
    for names in BOILERPLATE.values():
        for name in names.split():
            rest[name] += 3
    total_main, total_rest = sum(main.values()) + 1, sum(rest.values()) + 1
    odds = {k: float(np.log((main[k] + 0.5) / total_main) - np.log((rest[k] + 0.5) / total_rest)) for k in {*main, *rest} if main[k] + rest[k] >= 3}
    spread = Spread(odds)
    x = np.concatenate([node_features(t, spread) for t in trees])
    return Extractor(spread, fit_boosted_trees(x, np.concatenate(labels).astype(float)))


def sample_paragraphs(pages: DataFrame, most: int = SAMPLE) -> list[str]:
    """Texts of at most ``most`` pages, to fill layouts with."""
    small = pages.where(F.octet_length("html").between(1, SAMPLE_BYTES)).select("page_id", "html")
    rows = small.orderBy(F.xxhash64("page_id"), "page_id").limit(most).select("html").collect()
    texts = [t for r in rows for t in parse(r.html).texts if len(t) > 40]
    return sorted(set(texts))


def extract_text(pages: DataFrame) -> DataFrame:
    """A row per page: page_id, url, text, n_chars."""
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(fit_extractor(sample_paragraphs(pages)))
    names = ["page_id", "url", "text", "n_chars"]
    types = [to_arrow_type(pages.schema["page_id"].dataType), to_arrow_type(pages.schema["url"].dataType), pa.string(), pa.int64()]

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = shared.value(batch.column("html").to_pylist())
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types, strict=True)], names)

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(extract, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
