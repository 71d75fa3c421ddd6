"""Main text of web pages by gradient-boosted trees over DOM nodes.

Every block element and text run is a node with features of its subtree (text density, links,
punctuation), its tag and the tokens of its names, those of its ancestors, depth and siblings. Boosted trees
give the log odds that a node holds main text. Decoding is hierarchical: a node may be chosen
only if its parent is, and the choice with the highest total likelihood is found by one pass up
and one down, so no part is kept out of a part that is dropped.

The trees are trained on pages composed here, of many layouts, whose main text is known; their
words come from a bounded sample of the table (``SAMPLE`` pages with the smallest ids,
``WORDS`` words of each). The model is a few kilobytes and goes to the executors with the code.

* null or empty html: empty text; a page without main text: empty text
* broken, cut-off and very long pages are parsed as far as they go, whole
* repeated rows are extracted alike; an empty table gives an empty result (the trees are then
  trained on a built-in word list)
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingline.llm.boosting import Trees, fit
from pingline.llm.common import chunks_of
from pingline.llm.html_tree import features, follows, tree

#: Bound of the sample that training words come from, and the number of training pages.
SAMPLE, WORDS, PAGES, SEED = 64, 200, 1000, 11
PLAIN = "a the of and to in is it was for on with as by at from that this one part more time day year work word page line text".split()


def compose(words: list[str], rng: random.Random) -> str:
    """A page whose blocks of main text bear the attribute data-main."""

    def say(low: int, high: int) -> str:
        text = " ".join(rng.choice(words) for _ in range(int(np.exp(rng.uniform(np.log(low), np.log(high))))))
        if rng.random() < 0.2:
            text = rng.choice(["<b>{}</b>", "<em>{}</em>", "<b>{}", '{} <a href="/x">more</a>']).format(text)
        return text + rng.choice([".", ".", ".", "", "!", "&amp;"])

    def links(low: int, high: int) -> str:
        items = [f'<a href="/{rng.choice(words)}">{say(1, 3)}</a>' for _ in range(rng.randint(low, high))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if rng.random() < 0.7 else " | ".join(items)

    def box(tags: list[str], names: list[str], inner: str, plain: float = 0.3) -> str:
        """An element that says what it is by its tag or by its names."""
        if tags and rng.random() < 0.5:
            tag = rng.choice(tags)
            name = "" if rng.random() < 0.6 else rng.choice(names)
        else:
            tag, name = rng.choice(["div", "div", "section"]), rng.choice(names)
        key = rng.choice(["class", "class", "id"])
        if name and rng.random() < plain:
            name = name + rng.choice(["-box", " block", "-wrap", "-1", "_inner"])
        return f'<{tag} {key}="{name}">{inner}</{tag}>' if name else f"<{tag}>{inner}</{tag}>"

    def prose(low: int, high: int) -> str:
        return "".join(f"<p>{say(2, 60)}</p>" if rng.random() < 0.7 else say(2, 30) for _ in range(rng.randint(low, high)))

    def advert() -> str:
        return box([], ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "sponsor"],
                   rng.choice([say(2, 40), f"<p>{say(2, 30)}</p>", f'<a href="/buy">{say(2, 12)}</a>']))

    def notice() -> str:
        return box(["dialog"] if rng.random() < 0.3 else [], ["cookie-notice", "notice", "cookie", "consent", "gdpr", "alert", "popup", "newsletter", "subscribe", "paywall"],
                   rng.choice([say(4, 40), f"<p>{say(4, 40)}</p>"]) + rng.choice(["", "<button>OK</button>"]))

    def form() -> str:
        inner = f"<label>{say(1, 3)}</label><input name=q>" + rng.choice(["", "<textarea>x</textarea>", f"<p>{say(3, 15)}</p>"]) + f"<button>{say(1, 2)}</button>"
        return f"<form>{inner}</form>" if rng.random() < 0.8 else box([], ["form", "search", "login", "contact-form"], inner)

    def comments() -> str:
        one = lambda: rng.choice(['<div class="comment">{}</div>', '<article class="comment">{}</article>', "<li>{}</li>", '<p>{}</p>', "<div><h4>{}</h4>{}</div>"]).replace(
            "{}", f"<p>{say(3, 60)}</p>" if rng.random() < 0.6 else say(3, 60))
        return box([], ["comments", "comment-list", "discussion", "replies", "reader-comments", "reviews", "comment-section", "responses comments"],
                   rng.choice(["", f"<h2>{say(1, 3)}</h2>", f"<h3>{say(1, 3)}</h3>"]) + "".join(one() for _ in range(rng.randint(1, 8))) + (form() if rng.random() < 0.3 else ""))

    def aside() -> str:
        return box(["aside"], ["sidebar", "widget", "related", "side", "recommended", "trending", "rail"],
                   rng.choice(["", f"<h3>{say(1, 3)}</h3>"]) + rng.choice([links(2, 8), prose(1, 4), links(1, 4) + prose(1, 2)]))

    def share() -> str:
        return box([], ["share", "social", "breadcrumb", "pagination", "toolbar", "tools"], links(1, 5))

    def menu() -> str:
        return box(["nav"], ["nav", "menu", "navbar", "navigation", "main-menu"], links(2, 10))

    longest = 250 if rng.random() < 0.75 else 6  # a quarter of the pages say little

    def main_block() -> str:
        kind = rng.random()
        if kind < 0.74:
            return f"<p data-main>{say(1, longest)}" + rng.choice(["</p>", "</p>", "</p>", "", "<br>"])
        if kind < 0.82:
            return f"<h{rng.randint(2, 4)} data-main>{say(1, 10)}</h2>".replace("</h2>", "</h2></h3></h4>")
        if kind < 0.88:
            return "<ul>" + "".join(f"<li data-main>{say(1, 40)}</li>" for _ in range(rng.randint(1, 6))) + "</ul>"
        if kind < 0.92:
            return f"<blockquote><p data-main>{say(3, 60)}</p></blockquote>"
        if kind < 0.95:
            return f"<pre data-main>{say(3, 60)}</pre>"
        if kind < 0.98:
            return f'<div data-main>{say(3, 120)}</div>'
        return "<table>" + "".join(f"<tr><td data-main>{say(1, 5)}</td><td data-main>{say(1, 5)}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>"

    blocks = [main_block() for _ in range(rng.choice([1, 1, 2, 2, 3, 5, 8, 12, 20]))]
    if rng.random() < 0.8:
        blocks.insert(0, f"<h{rng.choice([1, 1, 1, 2])} data-main>{say(1, 14)}</h1></h2>")
    for make in (advert, aside, share, notice, form):
        if rng.random() < 0.18:
            blocks.insert(rng.randint(0, len(blocks)), "</p>" + make())
    body = "".join(blocks)
    style = rng.random()
    if style < 0.55:
        body = f"<article>{body}</article>" if rng.random() < 0.8 else f'<article class="{rng.choice(["post", "entry", "story"])}">{body}</article>'
    elif style < 0.7:
        body = f"<main>{body}</main>"
    else:
        body = f'<div class="{rng.choice(["content", "post", "entry-content", "article-body", "story", "main", "text", "post-body"])}">{body}</div>'
    if rng.random() < 0.3:
        body = rng.choice(["<main>{}</main>", '<div id="main">{}</div>', '<div class="container">{}</div>', "<section>{}</section>"]).format(body + (comments() if rng.random() < 0.4 else ""))
    before = [box(["header"], ["header", "masthead", "site-header", "topbar", "top"], rng.choice(["", f"<h1>{say(1, 4)}</h1>", f"<p>{say(1, 10)}</p>", say(1, 5)]) + (menu() if rng.random() < 0.5 else ""))
              for _ in range(rng.random() < 0.5)]
    before += [make() for make, odds in ((menu, 0.7), (advert, 0.5), (notice, 0.3), (share, 0.2), (form, 0.15), (aside, 0.15)) if rng.random() < odds]
    after = [make() for make, odds in ((comments, 0.4), (aside, 0.35), (advert, 0.3), (share, 0.2), (form, 0.2), (notice, 0.15)) if rng.random() < odds]
    rng.shuffle(before)
    rng.shuffle(after)
    foot = box(["footer"], ["footer", "bottom", "copyright", "site-footer"], rng.choice([f"&copy; {say(1, 20)}", f"<p>{say(1, 30)}</p>", links(1, 6), links(1, 4) + f"<p>{say(1, 20)}</p>"])) if rng.random() < 0.85 else ""
    page = "".join([*before, body, *after, foot])
    if rng.random() < 0.3:
        page = f'<div class="{rng.choice(["wrapper", "page", "container", "site"])}">{page}</div>'
    head = f"<head><title>{say(1, 10)}</title><style>p{{}}</style></head>" if rng.random() < 0.8 else ""
    return f"<!DOCTYPE html><html>{head}<body>{page}" + rng.choice(["</body></html>", "</body></html>", ""])


def training(words: list[str], pages: int = PAGES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Features of composed pages' nodes, and whether each holds main text."""
    rng = random.Random(seed)
    rows, labels = [], []
    for _ in range(pages):
        nodes = tree(compose(words, rng))
        holds = np.zeros(len(nodes), bool)
        for i, x in enumerate(nodes):
            if x.mark or x.tag == "#text" and nodes[x.parent].mark:
                holds[i] = True
        for i in range(len(nodes) - 1, 0, -1):
            holds[nodes[i].parent] |= holds[i]
        own = ~follows(nodes)
        rows.append(features([nodes])[0][own])
        labels.append(holds[own])
    return np.concatenate(rows), np.concatenate(labels).astype(float)


#: The last trees fitted, by their words.
_FITTED: dict[str, Trees] = {}


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Trees:
    """Trees for the table's language. Reads a bounded number of words of bounded pages."""
    # ids first, then the words of those pages: no page travels whole, however many tasks read
    last = pages.select(F.col(id_col).alias("id")).where("id IS NOT NULL").orderBy("id").limit(SAMPLE).agg(F.max("id")).first()[0]
    text = F.regexp_replace(F.coalesce(html_col, F.lit("")), "(?s)<(script|style).*?</\\1>|<[^>]*>|&[a-z]*;?", " ")
    sample = pages.where(F.col(id_col) <= F.lit(last)).select(F.col(id_col).alias("id"), F.slice(F.split(text, "\\s+"), 1, WORDS).alias("w"))
    words = [w for r in sample.orderBy("id", "w").limit(SAMPLE).collect() for w in r["w"] if w and len(w) < 40]
    words = sorted(words) if len(words) > 100 else PLAIN
    known = "\0".join(words)  # the trees depend on the words alone
    if known not in _FITTED:
        _FITTED.clear()
        _FITTED[known] = fit(*training(words))
    return _FITTED[known]


def decode(parents: list[int], scores: np.ndarray, tied: np.ndarray) -> np.ndarray:
    """The likeliest choice of nodes of which each has its parent chosen; tied nodes are
    chosen with their parents."""
    keep = np.where(tied, 0, -np.logaddexp(0, -scores)).tolist()
    drop = np.where(tied, 0, -np.logaddexp(0, scores)).tolist()
    for i in range(len(parents) - 1, 0, -1):
        keep[parents[i]] += max(keep[i], drop[i])
        drop[parents[i]] += drop[i]
    chosen = np.zeros(len(parents), bool)
    chosen[0] = keep[0] > drop[0]
    for i in range(1, len(parents)):
        chosen[i] = chosen[parents[i]] and (tied[i] or keep[i] > drop[i])
    return chosen


def extract(pages: list[str], trees: Trees) -> list[str]:
    """Main text of each page: blocks in page order, an empty line between them."""
    if not pages:
        return []
    parsed = [tree(p) for p in pages]
    rows, texts = features(parsed)
    scores, out, low = trees.scores(rows), [], 0
    for nodes in parsed:
        high = low + len(nodes)
        chosen = decode([x.parent for x in nodes], scores[low:high], follows(nodes))
        out.append("\n\n".join(t for t, c in zip(texts[low:high], chosen) if c and t))
        low = high
    return out


def extracted(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", text_col: str = "text", trees: Trees | None = None) -> DataFrame:
    """``pages`` without html, with the main text; a column named as the text is replaced."""
    model = trees if trees is not None else train(pages, id_col, html_col)
    slim = pages.select(*(c for c in pages.columns if c not in (html_col, text_col)), html_col)
    at = len(slim.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, 1 << 20, at):
            texts = extract([x or "" for x in batch.column(at).to_pylist()], model)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(texts, pa.string())], [*batch.schema.names[:at], text_col])

    return slim.mapInArrow(run, T.StructType([*slim.schema.fields[:at], T.StructField(text_col, T.StringType())]))
