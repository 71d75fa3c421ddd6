"""Exact dedup, near-dedup and suffix dedup against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pingline.llm import exact_dedup, near_dedup, suffix_dedup

RNG = random.Random(5)
WORDS = [RNG.choice("bcdfghklmnprst") + RNG.choice("aeiou") + RNG.choice("lmnrst") + RNG.choice(["", "er", "ing", "ß", "中"]) for _ in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus():
    """Copies, white-space variants, near copies, shared passages, one long text, nulls, empties."""
    base = [prose(RNG.randint(1, 120)) for _ in range(60)]
    shared, long = prose(30), prose(9000)
    texts = [*base, *base[:10], base[3].replace(" ", " \n\t "), " " + base[3], base[4] + "  ", None, "", "", None, " ", "\n", long, long + " x"]
    texts += [prose(20) + " " + shared + " " + prose(20) for _ in range(12)]
    texts += ["a" * 200, "a" * 120, "ab" * 60, "x", "x y", "X Y"]
    for t in base[20:30]:
        w = t.split()
        w[len(w) // 2] = "zzz"
        texts.append(" ".join(w))
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    RNG.shuffle(rows)
    return rows


ROWS = corpus()


def by_id(df):
    out = {}
    for r in df.collect():
        out[r["doc_id"]] = r
    return out


# ---- exact ---------------------------------------------------------------


def exact_brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[ \t-\r]+", " ", t or "")].append(i)
    return {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}


@pytest.mark.parametrize("weak", [False, True])
def test_exact_equals_brute_force(docs, weak):
    """With a weak hash nearly all chunks collide, and texts are told apart all the same."""
    how = {"hash_of": lambda c: F.length(c).cast("long") % 3} if weak else {}
    got = {i: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for i, r in by_id(exact_dedup.exact_duplicates(docs(ROWS), **how)).items()}
    assert got == exact_brute(ROWS)


def test_exact_edges(docs):
    assert exact_dedup.exact_duplicates(docs([])).count() == 0
    got = exact_dedup.exact_duplicates(docs([(None, "a"), (None, "a"), (2, "a"), (2, "a"), (None, "b")])).collect()
    assert sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"]) for r in got) == [(-1, -1, 1), (-1, 2, 4), (-1, 2, 4), (2, 2, 4), (2, 2, 4)]
    assert sum(r["kept"] for r in got) == 2


def test_exact_keeps_the_rows_as_they_were(docs):
    left = exact_dedup.drop_duplicates(docs(ROWS + [ROWS[0], ROWS[0]]))
    assert left.columns == docs([]).columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(i for i, x in exact_brute(ROWS).items() if x[2])


def test_chunks_cover_the_text(docs):
    t = prose(3000)
    chunks = docs([(1, t)]).select(exact_dedup.chunks(F.col("text")).alias("c")).first()["c"]
    assert "".join(chunks) == t and len(chunks) > 5
    moved = docs([(1, "one two " + t)]).select(exact_dedup.chunks(F.col("text")).alias("c")).first()["c"]
    assert len(set(chunks) & set(moved)) >= len(chunks) // 2  # cuts follow the content


# ---- near ----------------------------------------------------------------


def print_brute(text):
    words = re.findall(b"[^\x20\x09-\x0d]+", re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_brute(prints, bits):
    ids, root = sorted(prints), {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_near_equals_brute_force(docs):
    got = by_id(near_dedup.near_duplicates(docs(ROWS)))
    prints = {i: print_brute(t) for i, t in ROWS}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in got.items()} == groups_brute(prints, 2)


def test_spark_hashes_alike(docs):
    """A shingle's hash is Spark's own xxhash64."""
    assert docs([(1, "a b c")]).select(F.xxhash64("text")).first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("bits,segments", [(2, 3), (2, 5), (1, 2), (3, 4), (0, 3)])
def test_links_lose_none(ready, bits, segments):
    """Fingerprints in balls around a few centres: every pair within the distance is found."""
    rng = random.Random(bits * 10 + segments)
    values = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(12):
            v = centre
            for _ in range(rng.randint(0, 3)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {frozenset((r["a"], r["b"])) for r in near_dedup.links(ready.createDataFrame([(v,) for v in signed], "fp long"), bits, segments).collect()}
    want = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
    assert got == want


def test_components_of_a_path_and_a_star(ready):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(300, 200), (250, 300)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in near_dedup.components(ready.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 250: 200, 300: 200}


def test_near_edges(docs):
    assert near_dedup.near_duplicates(docs([])).count() == 0
    got = near_dedup.near_duplicates(docs([(None, ""), (5, None), (5, None), (9, " \n")])).collect()
    assert {r["component_id"] for r in got} == {5} and {r["fingerprint"] for r in got} == {"0" * 16}
    alone = near_dedup.near_duplicates(docs([(None, "a b c d")])).first()
    assert alone["component_id"] is None


def test_one_of_each_group_stays(docs):
    got = by_id(near_dedup.near_duplicates(docs(ROWS)))
    left = near_dedup.keep_one(docs(ROWS + [ROWS[0]]))
    assert left.columns == docs([]).columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({r["component_id"] for r in got.values()})


# ---- suffixes ------------------------------------------------------------


def cut_brute(rows):
    first, out = {}, []
    texts = [(i if i is not None else 2**63 - 1, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for p in range(len(b) - 49):
            s = b[p:p + 50]
            first[s] = min(i, first.get(s, i))
    for i, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum()), kept))
    return sorted(out)


def cut_got(df):
    rows = suffix_dedup.without_repeats(df.select("doc_id", "text")).select("doc_id", "found.*").collect()
    return sorted((r["doc_id"] if r["doc_id"] is not None else 2**63 - 1, r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows)


def test_suffixes_equal_brute_force(docs):
    assert cut_got(docs(ROWS)) == cut_brute(ROWS)


def test_suffixes_of_dense_repeats(docs, monkeypatch):
    """Few letters, mutated copies and tiny batches and blocks: every path, many borders."""
    rng = random.Random(9)
    base = "".join(rng.choice("ab") for _ in range(3000))
    rows = []
    for i in range(40):
        a = rng.randrange(2000)
        t = list(base[a:a + rng.randint(30, 900)])
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = "c"
        rows.append((rng.randrange(30) if i % 9 else None, "".join(t)))
    monkeypatch.setattr(suffix_dedup, "SORTED", 300)
    assert cut_got(docs(rows)) == cut_brute(rows)


def test_blocks_of_a_long_text():
    """A text cut into blocks has the same windows, each once."""
    text = prose(800).encode()
    whole = suffix_dedup.parse([text])
    assert int(whole[2].sum()) == len(text) - suffix_dedup.LENGTH + 1
    size = 1000
    seen = set()
    for at in range(0, len(text) - suffix_dedup.LENGTH + 1, size - suffix_dedup.LENGTH):
        _, start, count, *_ = suffix_dedup.parse([text[at:at + size - 1]])
        for s, c in zip(start.tolist(), count.tolist()):
            assert not seen & set(range(at + s, at + s + c))
            seen |= set(range(at + s, at + s + c))
    assert seen == set(range(len(text) - suffix_dedup.LENGTH + 1))


def test_suffix_edges(docs):
    assert suffix_dedup.without_repeats(docs([])).count() == 0
    t = prose(40)
    assert cut_got(docs([(1, t), (1, t), (None, t), (None, "")])) == cut_brute([(1, t), (1, t), (None, t), (None, "")])


def test_what_is_left_is_text(docs):
    passage = "é" * 40
    left = suffix_dedup.drop_repeats(docs([(1, passage), (2, passage), (3, "q" + passage + "z"), (4, None), (5, "unlike the rest")]))
    assert left.columns == docs([]).columns
    got = {r["doc_id"]: r["text"] for r in left.collect()}
    assert got[1] == passage and got[5] == "unlike the rest" and 2 not in got and 4 not in got
    assert set(got[3]) <= set("qéz") and got[3][0] == "q" and got[3][-1] == "z"
