"""Lexical search against a plain scorer."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pingline.llm import lexical_search as ls

RNG = random.Random(12)
WORDS = ["".join(RNG.choice("abcdeghilmnorstu") for _ in range(RNG.randint(2, 6))) for _ in range(300)] + ["Größe", "naïve", "中文", "X1", "é"]
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain(docs, items, best=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    corpus, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * corpus // length
            score = sum(math.floor(1000 * math.log((2 * corpus + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(found)[:best], 1)]
    return sorted(out, key=str)


def prose(n):
    return " ".join(RNG.choice(WORDS).upper() if RNG.random() < 0.1 else RNG.choice(WORDS[: RNG.choice([20, 300])]) + RNG.choice(["", ".", ",", "-x"]) for _ in range(n))


def corpus():
    passages = [prose(25) for _ in range(12)]
    docs = [(i, prose(RNG.randint(1, 150))) for i in range(500)]
    docs += [(600 + i, prose(40) + " " + passages[i % 12] + " " + prose(40)) for i in range(30)]
    docs += [(700 + i, docs[3][1]) for i in range(40)]  # ties
    docs += [(5, docs[5][1]), (None, docs[3][1]), (None, None), (801, None), (802, ""), (803, " .,;\n"), (804, "\x7f{}~"), (805, "ÄÖ ß")]
    docs += [(806, prose(60_000)), (807, passages[0])]
    items = [*enumerate(passages), (20, None), (21, ""), (22, "..."), (23, docs[3][1]), (23, docs[3][1]), (24, "unheard qqq"), (None, passages[1]),
             (25, "ÄÖ ß Größe"), (26, prose(2000))]
    RNG.shuffle(docs)
    return docs, items


DOCS, ITEMS = corpus()


def run(ready, docs, items, parts=5):
    d = ready.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in docs], "doc_id long, text string, n int, size int, doc int, query string").repartition(parts)
    i = ready.createDataFrame([(i, t, 9, 8) for i, t in items], "item_id long, text string, rank int, score int")
    return sorted((tuple(r) for r in ls.search(d, i).collect()), key=str)


def test_equals_the_plain_scorer(ready):
    assert run(ready, DOCS, ITEMS) == plain(DOCS, ITEMS)


@pytest.mark.parametrize("block, leaf, lot", [(7, 2, 10_000), (64, 4, 40), (4096, 64, 150)])
def test_trees_and_lots_of_any_size(ready, monkeypatch, block, leaf, lot):
    for name, value in (("BLOCK", block), ("LEAF", leaf), ("LOT", lot)):
        monkeypatch.setattr(ls, name, value)
    pairs = ls.Items([(q, q, t.encode()) for q, (_, text) in enumerate(ITEMS) for t in sorted(set(terms(text)))])
    assert len(pairs.terms) < len(ITEMS)
    assert run(ready, DOCS[:200], ITEMS) == plain(DOCS[:200], ITEMS)


def test_empty(ready):
    assert run(ready, [], ITEMS) == [] and run(ready, DOCS[:50], []) == []
    assert run(ready, [(1, None), (2, "")], ITEMS) == []


def vectors(n, width, rng):
    rows = [np.sort(rng.choice(width, rng.integers(1, 9), replace=False)) for _ in range(n)]
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return ptr, np.concatenate(rows), rng.integers(1, 10**6, ptr[-1])


def test_bounds_hold_and_prune(monkeypatch):
    monkeypatch.setattr(ls, "LEAF", 16)
    rng = np.random.default_rng(3)
    width, n = 60, 2000
    ptr, term, part = vectors(n, width, rng)
    items = ls.Items([(q, q, str(t).encode()) for q in range(20) for t in (range(width) if q == 0 else rng.choice(width, 5, replace=False).tolist())])
    weight = rng.integers(0, 9000, width)
    queries = ls.Queries(items, weight, 10)
    tree = ls.Tree(ptr, term, part, part * queries.root[term], queries)
    dense = np.zeros((n, width), np.int64)
    dense[np.repeat(np.arange(n), np.diff(ptr)), term] = part
    for q, mine in enumerate(items.terms):
        score = (dense[:, mine] * weight[mine]).sum(axis=1)
        for node, (start, end, _, _) in enumerate(tree.nodes):
            assert score[tree.order[start:end]].max() <= tree.bound[node, q]
    queries.search(tree, np.arange(n))
    for q, mine in enumerate(items.terms):
        score = (dense[:, mine] * weight[mine]).sum(axis=1)
        want = sorted((-s, i) for i, s in enumerate(score.tolist()) if s > 0)[:10]
        assert queries.found[q] == want
    leaves = sum(left < 0 for _, _, left, _ in tree.nodes)
    assert queries.opened < 20 * leaves  # some subtrees were passed over


def test_long_texts_come_in_pieces(monkeypatch):
    text = prose(5000).encode()
    whole = [t for some in ls.terms_of(text) for t in some]
    monkeypatch.setattr(ls, "PIECE", 100)
    assert [t for some in ls.terms_of(text) for t in some] == whole
    assert [t for some in ls.terms_of(b"a" * 1000) for t in some] == [b"a" * 1000]
