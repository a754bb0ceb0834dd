"""Pages as flat trees of blocks and text runs, with the features that the extractor's trees look at.

Only block elements are nodes; a run of text between two block boundaries is a leaf.
Inline elements count towards a run (links) and disappear. Scripts, styles, comments,
form controls and the like give no text. The reader is tolerant: end tags may be
missing, stray ones are ignored, a cut tag at the end is dropped.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np

# Elements of HTML.
_GROUPS = {
    "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "paragraph": "p",
    "item": "li dt dd",
    "list": "ul ol dl menu",
    "article": "article main",
    "nav": "nav",
    "aside": "aside dialog",
    "header": "header",
    "footer": "footer",
    "form": "form fieldset legend",
    "table": "table thead tbody tfoot tr td th caption",
    "quote": "blockquote pre figure figcaption address details summary",
    "generic": "div section center body html",
}
KINDS = ("text", *_GROUPS)
_KIND = {tag: KINDS.index(name) for name, tags in _GROUPS.items() for tag in tags.split()}
_NO_TEXT = frozenset("script style title noscript template iframe object svg canvas audio video select textarea button datalist noframes noembed xmp".split())
_CONTROLS = frozenset("input select textarea button".split())
_CELLS = frozenset("td th caption".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag ends the nearest open one of the first set, up to one of the second.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Ancestors that a node is told of.
_INSIDE = ("article", "nav", "aside", "header", "footer", "form", "item")

_markup = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # a comment; an open one takes the rest
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.S,
).search
_attributes = re.compile(r"""(?:^|[\s"'/])(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I).findall
_tokens = re.compile(r"[A-Z]?[a-z]+|[A-Z]+").findall


@lru_cache(maxsize=20_000)
def attribute_tokens(attrs: str) -> tuple[frozenset[str], str]:
    """Lower-case words of class, id and role; and the mark of a training page."""
    words, mark = set(), ""
    for name, *values in _attributes(attrs):
        value = "".join(values)
        if name.lower() == "data-main":
            mark = value
        else:
            words.update(w.lower() for w in _tokens(value))
    return frozenset(words), mark


class Nodes:
    """Nodes of a batch of pages, in page order; a page's first node is its root."""

    def __init__(self) -> None:
        self.kind: list[int] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self.depth: list[int] = []
        self.inside: list[int] = []
        self.tokens: list[frozenset[str]] = []
        self.mark: list[str] = []
        self.text: list[str] = []
        self.linked: list[int] = []
        self.controls: list[int] = []
        self.pages: list[int] = []

    def __len__(self) -> int:
        return len(self.kind)

    def add(self, kind: int, parent: int, tokens: frozenset[str] = frozenset(), mark: str = "", text: str = "", linked: int = 0) -> int:
        at = len(self.kind)
        root = parent < 0
        self.kind.append(kind)
        self.parent.append(parent)
        self.end.append(at + 1)
        self.depth.append(0 if root else self.depth[parent] + 1)
        own = 0 if root else 1 << self.kind[parent]
        self.inside.append(own if root else self.inside[parent] | own)
        self.tokens.append(tokens)
        self.mark.append(mark or ("" if root else self.mark[parent]))
        self.text.append(text)
        self.linked.append(linked)
        self.controls.append(0)
        return at


def read(page: str, out: Nodes) -> None:
    """Adds the nodes of one page to ``out``."""
    root = out.add(_KIND["html"], -1)
    out.pages.append(root)
    stack: list[tuple[str, int]] = [("", root)]
    run: list[str] = []
    linked, link_at = 0, 0  # link_at: stack size where the open link began
    at = 0

    def told(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        run.append(text)
        if link_at:
            linked += len(" ".join(text.split()))

    def ended() -> None:
        """A block boundary: the run so far is a leaf."""
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                out.add(0, stack[-1][1], text=text, linked=linked)
            run.clear()
        linked = 0

    def closed(size: int) -> None:
        nonlocal link_at
        ended()
        while len(stack) > size:
            out.end[stack.pop()[1]] = len(out)
        if link_at > size:
            link_at = 0

    while (m := _markup(page, at)) is not None:
        if m.start() > at:
            told(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        kind = _KIND.get(tag)
        if m["end"]:
            if tag == "a":
                link_at = 0
            elif kind is not None and tag not in ("body", "html"):
                same = _HEADINGS if tag in _HEADINGS else (tag,)
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in same:
                        closed(k)
                        break
                    if stack[k][0] in _CELLS and KINDS[kind] != "table":
                        break
                else:
                    ended()
            continue
        if tag == "a":
            link_at = len(stack)
        elif tag == "br":
            run.append("\n")
        elif tag == "hr":
            ended()
        elif kind is not None:
            if stack[-1][0] == "p" or (tag in _HEADINGS and stack[-1][0] in _HEADINGS):
                closed(len(stack) - 1)
            ends, limits = _ENDS.get(tag, ((), ()))
            for k in range(len(stack) - 1, 0, -1) if ends else ():
                if stack[k][0] in ends:
                    closed(k)
                    break
                if stack[k][0] in limits:
                    break
            ended()
            tokens, mark = attribute_tokens(m["attrs"]) if "=" in m["attrs"] else (frozenset(), "")
            stack.append((tag, out.add(kind, stack[-1][1], tokens, mark)))
        else:
            if tag in _CONTROLS:
                out.controls[stack[-1][1]] += 1
            if tag in _NO_TEXT and not m["attrs"].rstrip().endswith("/"):
                close = _closing(tag)(page, at)
                at = close.end() if close else len(page)
    if at < len(page):
        told(page[at:])
    closed(0)


@lru_cache(maxsize=64)
def _closing(tag: str):
    return re.compile(rf"</{re.escape(tag)}\b[^>]*+(?:>|\Z)", re.I).search


# features ------------------------------------------------------------------

FEATURES = (
    *(f"is_{k}" for k in KINDS),
    *(f"in_{k}" for k in _INSIDE),
    *("depth", "tokens", "tokens_above_low", "tokens_above_high", "tokens_below_low", "tokens_below_high"),
    *("chars", "words_a_run", "runs", "link_density", "tag_density", "punctuation", "capitals", "digits", "controls"),
    *("share_of_page", "share_of_parent", "before", "place", "siblings", "same_siblings", "sibling_chars", "parent_link_density"),
)
_STOPS = ".,;:!?"
_capital, _digit = re.compile(r"[A-ZÀ-Þ]").findall, re.compile(r"[0-9©]").findall


def token_scores(nodes: Nodes, scores: dict[str, float]) -> np.ndarray:
    """Sum of the scores of each node's attribute words."""
    return np.array([sum(map(scores.get, t, [0.0] * len(t))) if t else 0.0 for t in ([w for w in t if w in scores] for t in nodes.tokens)])


def features(nodes: Nodes, scores: dict[str, float]) -> np.ndarray:
    """A row per node: its kind and surroundings, attribute words, density of its subtree, depth and siblings."""
    n = len(nodes)
    kind, parent, end = (np.array(x, np.int64) for x in (nodes.kind, nodes.parent, nodes.end))
    inside, depth = np.array(nodes.inside, np.int64), np.array(nodes.depth, float)
    up = np.where(parent < 0, np.arange(n), parent)

    def below(own: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        sums = np.concatenate(([0.0], np.cumsum(own)))
        return sums[end] - sums[np.arange(n)]

    chars = np.array([len(t) for t in nodes.text], float)
    runs = below((kind == 0).astype(float))
    words = below(np.array([t.count(" ") + 1 if t else 0 for t in nodes.text], float))
    stops = below(np.array([sum(map(t.count, _STOPS)) if t else 0 for t in nodes.text], float))
    capitals = below(np.array([len(_capital(t)) if t else 0 for t in nodes.text], float))
    digits = below(np.array([len(_digit(t)) if t else 0 for t in nodes.text], float))
    linked, controls = below(np.array(nodes.linked, float)), below(np.array(nodes.controls, float))
    first = np.concatenate(([0.0], np.cumsum(chars)[:-1]))
    total = below(chars)
    some = np.maximum(total, 1)

    own = token_scores(nodes, scores)
    above_low, above_high = own * 0, own * 0
    below_low, below_high = own.copy(), own.copy()
    if own.any():
        low, high = above_low.tolist(), above_high.tolist()
        for i, p in enumerate(nodes.parent):
            if p >= 0:
                low[i], high[i] = min(low[p], own[p]), max(high[p], own[p])
        above_low, above_high = np.array(low), np.array(high)
        low, high = own.tolist(), own.tolist()
        for i in range(n - 1, 0, -1):
            p = nodes.parent[i]
            if p >= 0:
                low[p], high[p] = min(low[p], low[i]), max(high[p], high[i])
        below_low, below_high = np.array(low), np.array(high)

    page = np.array(nodes.pages)[np.searchsorted(nodes.pages, np.arange(n), side="right") - 1]
    siblings = np.bincount(up, minlength=n)[up].astype(float)
    _, alike, same = np.unique(up * len(KINDS) + kind, return_inverse=True, return_counts=True)
    order = np.argsort(up, kind="stable")
    place = np.empty(n)
    place[order] = np.arange(n) - np.searchsorted(up[order], up[order])
    links = linked / some
    columns = [
        *(kind == k for k in range(len(KINDS))),
        *((inside >> KINDS.index(k)) & 1 for k in _INSIDE),
        *(depth, own, above_low, above_high, below_low, below_high),
        *(np.log1p(total), np.log1p(words / np.maximum(runs, 1)), np.log1p(runs), links, below((kind > 0).astype(float)) / some, stops / np.maximum(words, 1), capitals / np.maximum(words, 1), digits / some, np.minimum(controls, 9)),
        *(total / some[page], total / some[up], (first - first[page]) / some[page], place / np.maximum(siblings, 1), np.log1p(siblings), np.log1p(same[alike]), np.log1p(total[up] / np.maximum(siblings, 1)), links[up]),
    ]
    return np.stack([np.asarray(c, np.float32) for c in columns], axis=1)
