"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from pingline.llm import projected_search as ps
from pingline.llm.queries import QUERIES


def brute(rows, asked, k=5):
    """Per query all candidates, nearest first."""
    good = [(i, np.asarray(v, float)) for i, v in rows
            if v is not None and None not in v and len(v) == 16 and np.isfinite(np.asarray(v, float)).all() and np.asarray(v, float).any()]
    ids, m = [i for i, _ in good], np.stack([v / np.abs(v).max() for _, v in good])
    m = m / np.sqrt((m * m).sum(axis=1))[:, None]
    out = {}
    for q in asked:
        at = next((j for j, i in enumerate(ids) if i == q), None)
        if at is not None:
            score = np.round(m @ m[at], 9)
            out[q] = sorted({(-s, math.inf if i is None else i) for s, i in zip(score.tolist(), ids) if i != q})[:k]
    return out


def check(ready, rows, recall, asked=None, parts=4, **more):
    table = ready.createDataFrame([(i, v, 1, 2.0, "x") for i, v in rows], "vec_id long, embedding array<float>, cell int, score double, q string").repartition(parts)
    asked = {i for i, _ in rows if i is not None and i % 10 == 0} if asked is None else asked
    queries = table.where("vec_id % 10 = 0") if asked is not None else table
    got = {}
    for r in ps.nearest(table, queries, **more).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute([(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows], asked)
    assert set(got) == {q for q, found in want.items() if found}
    hit = total = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1)) and len(found) == len(want[q])
        order = [(-s, math.inf if i is None else i) for _, i, s in found]
        assert order == sorted(order) and q not in [i for _, i in order] and len(set(order)) == len(order)
        hit += sum(x <= want[q][-1][0] + 1e-8 for x, _ in order)
        total += len(want[q])
    assert hit >= recall * total
    return got


def clustered(rng, n):
    centres = rng.normal(size=(12, 16))
    return (centres[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, 16))).astype("f4").tolist()


@pytest.mark.parametrize("make", ["clustered", "uniform"])
def test_recall(ready, monkeypatch, make):
    for name, value in (("ROWS", 200), ("QUERIES", 30), ("LEAF", 8), ("SAMPLE", 300)):
        monkeypatch.setattr(ps, name, value)
    rng = np.random.default_rng(4)
    vectors = clustered(rng, 1500) if make == "clustered" else rng.normal(size=(1500, 16)).astype("f4").tolist()
    check(ready, list(enumerate(vectors)), 0.9)


def test_small_tables_are_exact_and_odd_rows_take_no_part(ready):
    rng = np.random.default_rng(5)
    rows = list(enumerate(clustered(rng, 40)))
    copy = rows[3][1]
    rows += [(100 + i, copy) for i in range(30)]  # ties: smaller ids first, more of them than asked for
    rows += [(200, [2 * x for x in copy]), (210, [-x for x in copy]), (220, [1e30 * x for x in copy]), (230, [1e-30 * x for x in copy])]
    rows += [(300, None), (310, [0.0] * 16), (320, [-0.0] * 16), (330, [1.0] * 15), (340, []), (350, [float("nan")] + [1.0] * 15),
             (360, [float("inf")] + [1.0] * 15), (370, [None] + [1.0] * 15), (None, rows[7][1]), (None, None)]
    rows += [rows[10], rows[10], (20, rows[11][1])]  # repeated rows, and an id with two vectors
    assert 300 not in check(ready, [r for r in rows if r[0] != 20], 1.0)
    table = ready.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert ps.nearest(table, table.where("vec_id = 20")).where("query_id = vec_id").count() == 0


def test_fewer_candidates_than_asked_for(ready):
    rng = np.random.default_rng(6)
    got = check(ready, list(enumerate(clustered(rng, 3))), 1.0)
    assert len(got[0]) == 2
    assert check(ready, [(0, [1.0] * 16)], 1.0) == {}


def test_empty(ready):
    empty = ready.createDataFrame([], "vec_id long, embedding array<float>")
    assert ps.nearest(empty, empty).count() == 0
    useless = ready.createDataFrame([(0, [0.0, 0.0]), (1, None)], "vec_id long, embedding array<float>")
    assert ps.nearest(useless, useless).count() == 0


def test_a_hot_vector_is_never_searched_pair_by_pair(ready):
    rng = np.random.default_rng(7)
    rows = [*enumerate(clustered(rng, 300)), *((1000 + i, [1.0] * 8 + [0.5] * 8) for i in range(2000))]
    got = check(ready, rows, 0.98)
    assert [i for _, i, _ in got[1990]] == [1000, 1001, 1002, 1003, 1004]
    assert [i for _, i, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005]


def test_the_stopping_test():
    assert abs(ps.chi_square(15.507, 8) - 0.95) < 1e-4 and abs(ps.quantile(0.95, 8) - 15.507) < 1e-3
    rng = np.random.default_rng(8)
    onto = ps.directions(64)
    x, y = rng.normal(size=(2, 3000, 64))
    ratio = (((x - y) @ onto) ** 2).sum(axis=1) / ((x - y) ** 2).sum(axis=1)
    assert 0.9 < np.mean(ratio <= ps.quantile(0.95, 8)) < 0.99
    # near neighbours are found without verifying most rows
    base = rng.normal(size=(4000, 64))
    unit = base + 0.0
    unit[::2] = base[1::2] + 0.05 * rng.normal(size=(2000, 64))
    length = np.sqrt((unit * unit).sum(axis=1))
    tree = ps.Tree(np.arange(4000), unit, unit / length[:, None] @ onto)
    for i in range(0, 400, 2):
        found = tree.nearest(tree.vectors[tree.ids == i][0], tree.lengths[tree.ids == i][0], unit[i] / length[i] @ onto, 2, ps.quantile(0.95, 8), 4.0)
        assert [d for _, d in found] == [i, i + 1]
    assert tree.verified < 200 * 4000 / 4


def test_recall_on_the_given_table(ready):
    d = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], np.asarray(r["embedding"], float)) for r in ready.read.parquet(f"{d}/embeddings.parquet").collect()]
    m = np.stack([v / np.sqrt(v @ v) for _, v in rows])
    df = QUERIES["op11_nearest"](ready, d)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], []).append(r)
    assert set(got) == {i for i, _ in rows if i % 50 == 0}
    hit = 0
    for q, found in got.items():
        score = m @ m[q]
        score[q] = -2
        assert all(abs(r["score"] - score[r["vec_id"]]) < 1e-12 for r in found) and len(found) == 5
        hit += len({r["vec_id"] for r in found} & set(np.argsort(-score)[:5].tolist()))
    assert hit >= 0.9 * 5 * len(got)
