"""HTML as a tree of block elements and text runs, and features of its nodes.

A small forgiving parser: end tags that HTML implies, void and raw-text elements, comments,
broken attributes and cut-off pages. Inline elements belong to their block. The places of open
elements are kept per tag, so a tag costs the same however deep it stands.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right

import numpy as np

# fixed values: elements of HTML by kind
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What these hold is not markup; without an end tag it reaches to the end of the page.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul".split())
#: An element of the key ends open ones of the values, up to the first of the last list.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"}),
}
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
TOKEN = re.compile(r"[a-z0-9]+|[A-Z][a-z0-9]*")
MARKS = ".,;:!?"
NAMING = ("class", "id", "role", "aria-label", "itemprop")

TAG_GROUPS = [
    {"article", "main"}, {"section", "div", "center"}, {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}, {"ul", "ol", "dl", "menu", "dir"},
    {"li", "dt", "dd"}, {"nav"}, {"aside"}, {"header"}, {"footer"}, {"form", "fieldset", "button", "legend", "search", "dialog"},
    {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"blockquote", "pre", "figure", "figcaption", "address", "details", "summary"},
    {"html", "body"}, {"head"}, {"#text"},
]
TOKEN_GROUPS = [set(x.split()) for x in (
    "article content post main entry story body text prose copy maincontent articlebody",
    "nav menu navbar navigation navlinks breadcrumb breadcrumbs crumbs pagination pager tabs toolbar toc skip links",
    "header masthead topbar top logo branding brand hero",
    "footer bottom copyright colophon legal imprint foot",
    "sidebar aside side widget widgets rail related recommended recommendations more trending popular teaser teasers complementary",
    "ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promotion promoted banner commercial dfp",
    "cookie cookies notice notices consent gdpr alert popup modal overlay toast warning message disclaimer privacy newsletter subscribe signup paywall",
    "comment comments commentlist reply replies discussion disqus respondents reviews review feedback guestbook thread reader readers",
    "form search login share sharing social tools button buttons input contact poll rating",
    "hidden none invisible print sr only",
)]
_TAG_AT = {t: i for i, group in enumerate(TAG_GROUPS) for t in group}
_TOKEN_AT = {t: i for i, group in enumerate(TOKEN_GROUPS) for t in group}
FEATURES = 17 + 2 * (len(TAG_GROUPS) + len(TOKEN_GROUPS))


class Node:
    __slots__ = ("tag", "parent", "depth", "tokens", "text", "links", "tags", "controls", "mark", "place", "runs", "blocks")

    def __init__(self, tag: str, parent: int, depth: int, place: int):
        self.tag, self.parent, self.depth, self.place = tag, parent, depth, place
        self.tokens: list[int] = []
        self.text: list[str] = []  # of a run
        self.links = self.tags = self.controls = self.runs = self.blocks = 0
        self.mark = False


def named(attributes: str) -> tuple[list[int], bool]:
    """Token groups that an element's names hint at, and whether it bears the mark that
    training pages put on main text."""
    groups, mark = [], False
    if attributes.strip(" />\t\r\n"):
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name in NAMING:
                groups.extend(_TOKEN_AT[t] for t in (x.lower() for x in TOKEN.findall(value)) if t in _TOKEN_AT)
            elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower() or name == "aria-hidden" and value == "true":
                groups.append(len(TOKEN_GROUPS) - 1)
            elif name == "data-main":
                mark = True
    return groups, mark


def tree(page: str) -> list[Node]:
    """Nodes in page order, parents first. Text is in nodes named #text, one per run."""
    nodes = [Node("html", -1, 0, 0)]
    stack = [0]  # open blocks
    places: dict[str, list[int]] = {}  # where in the stack each tag is open, outermost first
    inline: dict[str, int] = {}  # open inline elements, for links only
    run = -1

    def close(at: int) -> None:
        nonlocal run
        for node in stack[at:]:
            places[nodes[node].tag].pop()
        del stack[at:]
        run = -1
        inline.clear()

    def innermost(tag: str) -> int:
        """0 if none is open."""
        here = places.get(tag)
        return here[-1] if here else 0

    def add(tag: str) -> int:
        parent = nodes[stack[-1]]
        nodes.append(Node(tag, stack[-1], parent.depth + 1, parent.runs + parent.blocks))
        if tag == "#text":
            parent.runs += 1
        else:
            parent.blocks += 1
        return len(nodes) - 1

    def write(text: str) -> None:
        nonlocal run
        if "&" in text:
            text = html.unescape(text)
        if run < 0:
            if text.isspace():
                return
            run = add("#text")
        node = nodes[run]
        node.text.append(text)
        if inline.get("a"):
            node.links += len(text.strip())

    at = 0
    while at < len(page):
        found = TAG.search(page, at)
        if not found:
            write(page[at:])
            break
        if found.start() > at:
            write(page[at:found.start()])
        at = found.end()
        ended, tag, attributes = found.groups()
        if ended:
            tag = ended.lower()
            if tag not in BLOCK:
                if inline.get(tag):
                    inline[tag] -= 1
            elif innermost(tag):
                close(innermost(tag))
            continue
        if not tag:
            continue
        if not attributes.endswith(">"):
            break  # the page ends inside a tag
        tag = tag.lower()
        if tag in RAW:
            nodes[stack[-1]].tags += 1
            nodes[stack[-1]].controls += tag in ("textarea", "select")
            if not attributes.endswith("/>"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            if run >= 0:
                nodes[run].text.append(" ")
            continue
        if tag not in BLOCK:
            if run >= 0:
                nodes[run].tags += 1
            nodes[stack[-1]].controls += tag in ("input", "label", "option")
            if tag not in VOID and not attributes.endswith("/>"):
                inline[tag] = inline.get(tag, 0) + 1
            continue
        # blocks end an open paragraph, and what HTML ends for them
        if innermost("p"):
            close(innermost("p"))
        drop, stop = ENDS.get(tag, (frozenset(), frozenset()))
        last = max((innermost(t) for t in stop), default=0)
        cut = [here[bisect_right(here, last)] for here in (places.get(t, ()) for t in drop) if here and here[-1] > last]
        if cut:
            close(min(cut))
        run = -1
        if tag == "html":
            continue
        new = add(tag)
        nodes[new].tokens, nodes[new].mark = named(attributes)
        if tag not in VOID:
            places.setdefault(tag, []).append(len(stack))
            stack.append(new)
            inline.clear()
    return nodes


def clean(text: list[str]) -> str:
    """One block's text: white space as one space, trimmed."""
    return " ".join("".join(text).split())


def features(pages: list[list[Node]]) -> tuple[np.ndarray, list[str]]:
    """A row of numbers per node of all pages, and the texts of the runs (empty for blocks)."""
    texts, own, place, bits, around, ends = [], [], [], [], [], []
    parent: list[int] = []
    root: list[int] = []
    for nodes in pages:
        first = len(texts)
        end = [first + i + 1 for i in range(len(nodes))]
        for i in range(len(nodes) - 1, 0, -1):  # parents first, so a subtree is a stretch
            p = nodes[i].parent
            if end[i] > end[p]:
                end[p] = end[i]
        ends.extend(end)
        for x in nodes:
            t = clean(x.text) if x.text else ""
            texts.append(t)
            own.append((len(t), x.links, 1 + x.tags, sum(map(t.count, MARKS)) if t else 0, t.count(" ") + 1 if t else 0,
                        x.tag == "p", x.tag == "li", x.controls + (x.tag in ("button", "form")), bool(t)))
            place.append((x.depth, x.place, _TAG_AT.get(x.tag, 1)))
            above = first + max(x.parent, 0)
            parent.append(above)
            root.append(first)
            mine = 1 << place[-1][2]
            for k in x.tokens:
                mine |= 1 << len(TAG_GROUPS) + k
            bits.append(mine)
            around.append(around[above] | bits[above] if x.parent >= 0 else 0)
    n, up = len(texts), np.array(parent)
    sums = np.concatenate([np.zeros((1, 9)), np.cumsum(np.array(own, float), axis=0)])
    chars, links, tags, marks, words, paragraphs, items, controls, runs = (sums[np.array(ends)] - sums[:-1]).T
    depth, at, kind = np.array(place).T
    here = np.array([x.runs + x.blocks for nodes in pages for x in nodes], float)
    siblings = np.maximum(here[up], 1)
    same = np.bincount(up * len(TAG_GROUPS) + kind, minlength=n * len(TAG_GROUPS))[up * len(TAG_GROUPS) + kind].astype(float)
    row = np.zeros((n, FEATURES), np.float32)
    row[:, :17] = np.stack([
        depth, np.log1p(chars), np.log1p(tags), np.log1p(chars / tags), links / np.maximum(chars, 1),
        chars / np.maximum(chars[np.array(root)], 1), chars / np.maximum(chars[up], 1), at / siblings,
        np.log1p(siblings), np.log1p(same), marks / np.maximum(chars, 1), np.log1p(words), np.log1p(paragraphs), np.log1p(items),
        np.log1p(controls), np.log1p(chars / np.maximum(runs, 1)), same / siblings], axis=1)
    groups = np.arange(len(TAG_GROUPS) + len(TOKEN_GROUPS))
    for column, of in ((17, bits), (17 + len(groups), around)):
        row[:, column:column + len(groups)] = np.array(of, np.int64)[:, None] >> groups & 1
    return row, texts


def follows(nodes: list[Node]) -> np.ndarray:
    """Runs that are all their block holds: they share its fate."""
    return np.array([x.tag == "#text" and nodes[x.parent].blocks == 0 for x in nodes])
