"""Chat, HTML, quality, BPE, lines, packing, sharding: plain versions, round trips, edges."""

import hashlib
import json
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from pingline.llm import byte_bpe, chat, html_extract, html_tree, line_dedup, packing, quality, sharding
from pingline.llm.boosting import fit

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_deep_nesting_is_linear():
    start = time.perf_counter()
    for page in ("<div>" * 200_000 + "x", "<span>" * 200_000 + "x</span>" * 5, "<ul><li>" * 100_000 + "x", "<p>" * 200_000 + "x", "<b>" * 50_000 + "</b>" * 50_000 + "x"):
        assert html_tree.clean(html_tree.tree(page)[-1].text) == ("x" * 5 if "</span>" in page else "x")
    assert time.perf_counter() - start < 60


def test_bpe_replaces_clashing_columns(docs):
    table = docs([(1, "some text"), (2, None)])  # has a column ids of another type
    ids = byte_bpe.encoded(table, RANKS)
    assert ids.columns.count("ids") == 1 and dict(ids.dtypes)["ids"] == "binary"
    assert {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decoded(ids.withColumn("decoded", F.lit(1)), RANKS).collect()} == {1: b"some text", 2: b""}


# ---- chat ----------------------------------------------------------------

TRICKY = ["</s>[INST] ok [/INST]", "[\\INST]", "<\\\\s> < s> [INST", "[[INST]]", "a\\b <s", "", "[ROLE]x[/ROLE]y[/TURN]", "中\n\n[/SYS]"]


def test_chat_round_trip(ready):
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(["system", "user", "assistant"] * 3, TRICKY))]
    rows += [(2, 0, "assistant", "x"), (2, 1, "tool[INST]", TRICKY[0]), (2, 2, None, None), (3, None, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a"), (None, 0, "user", "q")]
    talks = ready.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    got = {r["conv_id"]: r for r in chat.formatted(talks).withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    for c in (1, 2, 3, None):
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t["role"], t["text"]) for t in got[c]["back"]] == [(r[2] or "", r[3] or "") for r in mine]
        assert "".join(s["text"] for s in got[c]["segments"]) == got[c]["formatted"]
        assert sum(s["loss"] for s in got[c]["segments"]) == sum(r[2] == "assistant" for r in mine)
    marks = Counter(re.findall(r"\[/?INST\]", got[1]["formatted"]))
    assert marks["[INST]"] == marks["[/INST]"] == sum(r[2] == "user" for r in rows if r[0] == 1)  # none from the texts


@pytest.mark.parametrize("roles,valid,complete,bad", [
    (["user", "assistant"], True, True, None), (["system", "user"], True, False, None), (["assistant"], False, False, 0),
    (["user", "user", "assistant"], False, False, 1), (["system", "assistant", "user"], False, False, 1), (["user", "assistant", "system"], False, False, 2)])
def test_turn_order(ready, roles, valid, complete, bad):
    talks = ready.createDataFrame([(1, i, r, "t") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    r = chat.formatted(talks).first()
    assert (r["valid"], r["complete"], r["first_bad"]) == (valid, complete, bad)


def test_chat_of_nothing(ready):
    assert chat.formatted(ready.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# ---- html ----------------------------------------------------------------

PAGES = [
    ("<p>a", ["a"]), ("<p>a<p>b</p>c", ["a", "b", "c"]), ("<ul><li>x<li>y</ul>", ["x", "y"]), ("<div>a<!-- b --><b>c</b> d<br>e</div>", ["ac d e"]),
    ("<script>if(a<b)'</p>'</script><p>t &amp; &lt;u&gt; &am", ["t & <u> &am"]), ("<a title='<p>'>k</a>", ["k"]), ("<p>x<p cla", ["x"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]), ("a < b <3", ["a < b <3"]), ("<SCRIPT>x", []),
    ("<article><p>a</p><noscript>b<p>c</p></article>d", ["a", "b", "c", "d"]), ("<p>a<svg><path d='x'>b</svg> c<p>d", ["ab c", "d"]),
    ("<p>a <math><mi>x</mi>=<mn>1</p><p>b", ["a x=1", "b"]), ("<object data=x><p>a<video><p>b", ["a", "b"]), ("<template><p>a", ["a"]),
    ("<dl><dt>a<dd>b<dl><dd>c</dl><dt>d</dl>", ["a", "b", "c", "d"]), ("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul>", ["a", "b", "c", "d", "e"]), ("", []), ("<p>  \n </p>", [])]


@pytest.mark.parametrize("page,runs", PAGES)
def test_runs(page, runs):
    assert [html_tree.clean(n.text) for n in html_tree.tree(page) if n.tag == "#text" and html_tree.clean(n.text)] == runs


@pytest.fixture(scope="module")
def trees():
    return fit(*html_extract.training(html_extract.PLAIN))


def test_held_out_accuracy(trees):
    rows, labels = html_extract.training(html_extract.PLAIN, 150, seed=77)
    assert ((trees.scores(rows) > 0) == labels).mean() > 0.99
    rng, right = random.Random(78), 0
    for _ in range(100):
        page = html_extract.compose(html_extract.PLAIN, rng)
        nodes = html_tree.tree(page)
        want = [html_tree.clean(n.text) for n in nodes if n.tag == "#text" and nodes[n.parent].mark]
        right += html_extract.extract([page.replace(" data-main", "")], trees)[0] == "\n\n".join(w for w in want if w)
    assert right >= 90


def test_no_part_of_a_dropped_part(trees):
    rng = random.Random(4)
    for _ in range(30):
        nodes = html_tree.tree(html_extract.compose(html_extract.PLAIN, rng))
        scores = np.array([rng.gauss(0, 2) for _ in nodes])
        tied = html_tree.follows(nodes)
        chosen = html_extract.decode([n.parent for n in nodes], scores, tied)
        assert all(not c or n.parent < 0 or chosen[n.parent] for c, n in zip(chosen, nodes))


def test_decoding_is_the_likeliest():
    rng = random.Random(6)
    for _ in range(40):
        parents = [-1] + [rng.randrange(i) for i in range(1, 9)]
        scores = np.array([rng.gauss(0, 2) for _ in parents])
        got = html_extract.decode(parents, scores, np.zeros(9, bool))
        yes, no = -np.logaddexp(0, -scores), -np.logaddexp(0, scores)
        best = max((m for m in range(512) if all(not m >> i & 1 or i == 0 or m >> parents[i] & 1 for i in range(9))),
                   key=lambda m: sum(yes[i] if m >> i & 1 else no[i] for i in range(9)))
        assert [bool(best >> i & 1) for i in range(9)] == got.tolist()


ARTICLE = """<html><body><div class="cookie-notice">We use cookies <button>OK</button></div><header><h1>The Site</h1></header>
<nav><ul><li><a href="/">Home</a></li><li><a href="/b">News</a></li></ul></nav><main><article><h1>A title</h1><p>First &eacute; line
 with words, and more of them.</p><div class="ad">Buy now and save a lot of money</div><p>Second paragraph, here it is.</p></article>
<section class="comments"><h3>Comments</h3><div class="comment"><p>I do not agree at all with this text.</p></div></section></main>
<aside class="sidebar"><p>Related things to read</p></aside><form><label>Name</label><input></form><footer>&copy; 2024 The Site</footer></body></html>"""


def test_pages_through_spark(ready, trees):
    plain = re.compile(r"<article>(.*?)</article>", re.S)
    pages = ready.createDataFrame([(1, "u", ARTICLE, "old"), (2, None, None, None), (None, "u", "", None), (4, "u", ARTICLE, None)], "page_id long, url string, html string, text string")
    got = html_extract.extracted(pages, trees=trees)
    assert got.columns == ["page_id", "url", "text"]
    texts = sorted(r["text"] for r in got.collect())
    want = "A title\n\nFirst é line with words, and more of them.\n\nSecond paragraph, here it is."
    assert texts == ["", "", want, want] and plain.search(ARTICLE)
    assert html_extract.extracted(pages.limit(0)).count() == 0


def test_given_pages(ready, trees):
    """The tables' pages: everything in the article element, and nothing else."""
    import html

    rows = ready.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = html_extract.extract([r["html"] for r in rows], trees)
    for r, g in zip(rows, got):
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", p).replace("<br>", " ")).split()) for p in re.split("</?(?:p|h1)>", inner)]
        assert g == "\n\n".join(p for p in parts if p)


# ---- quality -------------------------------------------------------------


def counts_brute(text):
    words = re.findall("[^ \t-\r]+", text or "")
    seen = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    again = {j for i in range(len(words) - 4) if seen[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^ \t-\r]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again), len(lines))


def test_counts():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a ", "b ", "é ", "a b c d e ", "\n", "#", "\x0b", "\x85", " ", "中"]) for _ in range(rng.randint(0, 60)))
        assert quality.counts_of(text.encode()) == counts_brute(text)


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.3), (50, 7, 0.2), (400, 3, 0.02), (30, 30, 0.5), (20000, 150, 0.01)])
def test_binomial_tail(n, k, p):
    from fractions import Fraction
    from math import comb

    if n <= 1000:
        q = Fraction(p)
        want = float(sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1)))
        assert abs(quality.tail(n, k, p) - want) < 1e-9
    else:
        assert 0 < quality.tail(n, k, p) < 1e-3


def test_cutoffs_keep_their_promise(docs, ready):
    """Clean texts have short words, bad ones long ones; the cutoff lies between them."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        rows.append((i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(9, 12) if bad else rng.randint(3, 6))) for _ in range(40)), "en" if i % 2 else None))
        labels.append((i, 0 if bad else 1))
    labels += [(1, None), (None, 1), (10**6, 1), (2, 1)]
    table = docs(rows)
    marked = ready.createDataFrame(labels, "doc_id long, quality int")
    got = quality.judged(table, marked, limit=0.1, delta=0.1).collect()
    clean = [r for r in got if r["doc_id"] % 5]
    assert sum(not r["kept"] for r in clean) <= 0.1 * len(clean)
    assert all(not r["kept"] and "long_words" in r["rejected_by"] for r in got if r["doc_id"] % 5 == 0)
    left = quality.keep_good(table, marked, limit=0.1, delta=0.1)
    assert left.columns == table.columns and {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in got if r["kept"]}


def test_quality_edges(docs, ready):
    none = ready.createDataFrame([], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.judged(docs([(1, None), (2, ""), (None, "w " * 50), (4, " ".join(map(str, range(30))))]), none).collect()}
    assert [got[i]["base_failed"] for i in (1, 2, None, 4)] == [True, True, True, False]
    assert got[4]["kept"] and not got[1]["kept"]
    assert quality.judged(docs([]), none).count() == 0


# ---- byte-level BPE ------------------------------------------------------


def test_bpe_is_the_library(docs):
    import base64

    rng = random.Random(8)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    letters = "aesrvltmdXZ'' '  \n\t1 9.!é中　’ẞÀ😀́  -<|"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(300)]
    texts += [None, "", "'", "'ll'lll 're'r", "a" * 3000, "ab" * 700 + " x", " " * 400 + "x", "don't 'tis we'LL", "\n\n\n", "<|endoftext|>"]
    table = docs(list(enumerate(texts))).select("doc_id", "text", F.lit(1).alias("offsets"))
    ids = byte_bpe.encoded(table.drop("offsets"), RANKS, offsets_col="offsets")
    for r in byte_bpe.decoded(ids, RANKS).collect():
        text = (texts[r["doc_id"]] or "").encode()
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(texts[r["doc_id"]] or "")
        assert bytes(r["decoded"]) == text
        assert r["offsets"][-1] == len(text) and r["offsets"] == sorted(set(r["offsets"]))
    assert byte_bpe.encoded(docs([]).drop("ids"), RANKS).count() == 0


def test_scan_equals_stepping():
    after, _ = byte_bpe.automaton()
    rng = np.random.RandomState(1)
    for n in (1, 5, 256, 257, 5000, 70_000):
        classes = rng.randint(0, after.shape[1], n).astype(np.uint8)
        state, want = 0, []
        for c in classes.tolist():
            want.append(state)
            state = int(after[state, c])
        assert byte_bpe.scan(classes, after).tolist() == want


def test_memory_turns_over(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBER", 3)
    coder = byte_bpe.Coder(RANKS)
    texts = [f"word{i} common".encode() for i in range(30)] * 2
    ids = [coder.encode([t])[0][0] for t in texts]
    assert ids[:30] == ids[30:] and len(coder.known) <= 8


# ---- lines ---------------------------------------------------------------


def test_lines_equal_brute_force(ready):
    rng = random.Random(5)
    urls = ["http://www.A.com/x", "https://a.com:80/y", "b.org/z", None, "//c.net", "http://u@m.d.com?q"]
    pages = [(i, rng.choice(urls), "\n".join(rng.choice([" menu ", "menu", "foot", f"line {rng.randrange(400)}", "", " "]) for _ in range(rng.randint(0, 8)))) for i in range(200)]
    pages += [(500, "b.org", None), (None, "b.org", "foot"), (501, "lonely.com", "foot\nmenu"), (502, "pair.com", "foot\nown\nmenu"), (503, "pair.com", "menu\nother"),
              (504, "pair.com", "long " * 60_000 + "\nmenu")]
    table = ready.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, text string, lines string")
    host = {u: h for u, h in zip(urls + ["b.org", "lonely.com"], ["a.com", "a.com", "b.org", None, "c.net", "d.com", "b.org", "lonely.com"])} | {"pair.com": "pair.com"}
    total, held = Counter(host[u] for _, u, _ in pages), Counter()
    for _, u, t in pages:
        held.update((host[u], x) for x in {y.strip() for y in (t or "").split("\n")})
    drop = {(h, x) for (h, x), n in held.items() if x and n >= 2 and n > 0.3 * total[h]}
    assert drop
    got = {r["page_id"]: r for r in line_dedup.without_boilerplate(table, line_dedup.host_of("url")).collect()}
    for i, u, t in pages:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if (host[u], x.strip()) not in drop]
        assert (got[i]["text"], got[i]["lines"]["n_lines"], got[i]["lines"]["n_dropped"]) == ("\n".join(kept), len(lines), len(lines) - len(kept))
    assert line_dedup.without_boilerplate(table.limit(0), line_dedup.host_of("url")).count() == 0


# ---- packing -------------------------------------------------------------


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["alpha", "beta", "it's", "don't", "naïve", "中文", "X-1", "😀", "q" * 80, "123", "<|endoftext|>"]
    out = [(i, " ".join(rng.choice(words) for _ in range(int(rng.paretovariate(0.9) * 6)))) for i in range(250)]
    out = [(i, t[:60_000]) for i, t in out]
    out += [(310, "a<|endoftext|>b <|startoftext|> <|endoftext|><|endoftext|>"), (311, "<|endoftext|"), (312, " lead\ttab\x0bvt\x1cfs\x85nel\u2003em\u00a0nbsp ")]
    return out + [(300, None), (301, ""), (302, " \n "), (None, "no id"), (400, "twice"), (400, "twice"), (303, "word " * 3000)]


@pytest.mark.parametrize("window", [64, 2048])
def test_packing_loses_and_doubles_nothing(docs, texts, window):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    pieces = packing.pack(docs(texts), WORDS, window=window).collect()
    want = Counter((i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in texts)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[(r["doc_id"], r["doc_tokens"])].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    made = Counter()
    for (i, n), parts in by_doc.items():
        copies = 2 if i == 400 else 1
        parts.sort(key=lambda r: r["start"])
        ids = [x for r in parts[::copies] for x in np.frombuffer(r["ids"], "<u4").tolist()]
        assert len(ids) == n and [r["start"] for r in parts[::copies]] == np.cumsum([0, *(r["length"] for r in parts[::copies])])[:-1].tolist()
        made[(i, tuple(ids))] += copies
    assert made == want
    lengths = []
    for parts in by_sequence.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends and length > 0
            ends += length
        lengths.append(ends)
    assert max(lengths) <= window and all(n == window or n & (n - 1) == 0 for n in lengths)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_least_squares_and_plan():
    histogram = np.zeros(101, np.int64)
    histogram[[60, 40, 30, 10]] = 500, 500, 90, 90
    columns = packing.combinations(np.flatnonzero(histogram), 100)
    assert sorted(map(tuple, columns.tolist())) == [(10, 30, 60), (30, 30, 40), (40, 60, 0)]
    x = packing.least_squares(columns, histogram, 2000)
    fitted = np.zeros(101)
    for c, v in zip(columns.tolist(), x):
        for p in c:
            fitted[p] += v * (p > 0)
    assert (x >= 0).all() and np.abs(fitted - histogram).max() < 120
    places, taken, sequences = packing.plan(histogram, 100)
    assert (taken <= histogram).all() and taken.sum() > 900
    for length in (10, 30, 40, 60):
        mine = places[places[:, 0] == length]
        assert mine[0, 1] == 0 and (mine[1:, 1] == mine[:-1, 2]).all() and mine[-1, 2] == taken[length]


def test_forms_of_a_word_are_new_once():
    encoder = packing.WordEncoder(WORDS)
    encoder.encode(pa.array(["Straße straße, STRASSE straße!? éte ÉTE. éte", "strasse STRAßE;"]))
    assert encoder.known.keys() == {b"", "straße".encode(), b"strasse", "éte".encode(), b",", b"!?", b".", b";"}
    encoder.encode(pa.array(["Éte Strasse. straße,"]))
    assert len(encoder.ids) == sum(encoder.sizes[s] for s in encoder.known.values())


def test_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    rng = random.Random(12)
    # marks that combine, letters whose lower case is two or another's, signs that begin control strings or contractions
    parts = ["a", "E", "H", "h", "\u0331", "\u0301", "\u0307", "\u0338", "İ", "\u212a", "\u212b", "ß", "ẞ", "ÿ", "Ÿ", "×", "µ", "º", "½", "Σ", "中", "\u1100", "\u1161",
             "'s", "'S", "'LL", "<|", "|>", "endoftext", "<|endoftext|>", "<|ENDOFTEXT|>", ".", ",", "$", "=", "_", "</w>", "7", "\x00", "É", "Naïve", " ", " ", " ", "\n", "\u00a0", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(50))) for _ in range(1500)]
    texts += [f"x {chr(c)} {chr(c)}. y{chr(c)}Z, {chr(c)}{chr(c)}" for c in range(0x2000)] + ["", "q" * 300 + "!" * 300]
    encoder = packing.WordEncoder(WORDS)
    for at in range(0, len(texts), 700):
        some = texts[at:at + 700]
        ids, bounds = encoder.encode(pa.array(some))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library.encode(t, add_special_tokens=False).ids for t in some]


@pytest.mark.parametrize("change", ["case", "control"])
def test_other_vocabularies_are_taken_word_by_word(tmp_path, change):
    from tokenizers import Tokenizer

    with open(WORDS, encoding="utf-8") as file:
        rules = json.load(file)
    if change == "case":
        rules["normalizer"]["normalizers"].pop()
    else:
        rules["added_tokens"][0]["content"] = "beta!"
    (tmp_path / "other.json").write_text(json.dumps(rules))
    library, encoder = Tokenizer.from_file(str(tmp_path / "other.json")), packing.WordEncoder(str(tmp_path / "other.json"))
    texts = ["Alpha ALPHA, alpha Beta! beta!", "it's"]
    ids, bounds = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_long_words_are_let_go(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBER", 100)
    encoder = packing.WordEncoder(WORDS)
    for at in range(0, 1000, 50):  # words too long to remember
        encoder.encode(pa.array([" ".join("x" * 70 + f"{i}" for i in range(at, at + 50))]))
    assert len(encoder.sizes) <= 200


def test_packing_edges(docs):
    assert packing.pack(docs([]), WORDS).count() == 0
    assert [(r["length"], r["doc_tokens"]) for r in packing.pack(docs([(1, None)]), WORDS).collect()] == [(1, 1)]


# ---- sharding ------------------------------------------------------------


def ring_by_hand(rows, shards, nodes):
    """Every row placed one by one. Rows: (distance key per position, arc) from the ring."""
    points, owners = sharding.ring(shards, nodes)
    points, owners = points.tolist(), owners.tolist()

    def arc(position):
        return next((i for i, p in enumerate(points) if p >= position), 0)

    # clockwise from the point before the arc
    order = sorted(range(len(rows)), key=lambda i: (arc(rows[i][0]), (rows[i][0] - points[arc(rows[i][0]) - 1]) % (1 << 64), *rows[i][1:]))
    even, more = divmod(len(rows), shards)
    room = [even + (s < more) for s in range(shards)]
    out, over = {}, []
    for i in order:
        shard = owners[arc(rows[i][0])]
        if room[shard]:
            room[shard] -= 1
            out[i] = shard
        else:
            over.append(i)
    for i in over:
        at = arc(rows[i][0])
        while not room[owners[at % len(owners)]]:
            at += 1
        room[owners[at % len(owners)]] -= 1
        out[i] = owners[at % len(owners)]
    return out


@pytest.mark.parametrize("shards, nodes", [(5, 3), (8, 64)])
def test_shards_equal_a_plain_ring(docs, shards, nodes):
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot", "hot", f"text {rng.randrange(200)}", None])) for i in range(700)] + [(5, "hot"), (5, "hot"), (None, "x"), (None, "hot"), (900, "long " * 50_000)]
    table = docs(rows)
    text = F.coalesce("text", F.lit(""))
    placed = table.select("doc_id", F.crc32(text).alias("crc"), F.xxhash64(text).alias("position"), F.pmod(F.xxhash64("doc_id"), F.lit(sharding.SALTS)).alias("salt")).collect()
    want = ring_by_hand([(r["position"], r["salt"], r["doc_id"] is not None, r["doc_id"] or 0) for r in placed], shards, nodes)
    got = Counter((r["doc_id"], r["text_crc32"], r["shard"]) for r in sharding.by_rows(table, shards=shards, nodes=nodes).collect())
    assert got == Counter((r["doc_id"], r["crc"], want[i]) for i, r in enumerate(placed))


def test_shards(docs):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot", f"text {rng.randrange(400)}", None, "é中"])) for i in range(1003)] + [(5, "hot"), (5, "hot"), (None, "x")]
    got = sharding.by_rows(docs(rows), shards=7).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(7))
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    spread = defaultdict(set)
    for r in got:
        spread[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in spread.values()) <= 12  # groups are cut only where a shard is full
    assert sharding.by_rows(docs([])).count() == 0


def test_settling_is_clockwise():
    parts = sharding.settle([5, 0, 9, 1], [0, 1, 0, 1], [8, 7])
    held = Counter()
    for _, a, b, shard, first in parts:
        assert first == held[shard]
        held[shard] += b - a
    assert held == {0: 8, 1: 7}
    assert [(a, x, y, s) for a, x, y, s, _ in parts] == [(0, 0, 5, 0), (2, 0, 3, 0), (2, 3, 9, 1), (3, 0, 1, 1)]


def test_few_rows_move_when_a_shard_is_added(docs):
    rows = [(i, f"t{i}") for i in range(3000)]
    before = {r["doc_id"]: r["shard"] for r in sharding.by_rows(docs(rows), shards=8).collect()}
    after = {r["doc_id"]: r["shard"] for r in sharding.by_rows(docs(rows), shards=9).collect()}
    assert sum(before[i] != after[i] for i in before) < 0.45 * len(rows)


def test_digest_columns(ready):
    """The queries' digests are of the operators' own outputs."""
    from pingline.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in ready.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op5_byte_bpe"](ready, sf).collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    minus = {r["conv_id"]: r for r in QUERIES["op2_chat"](ready, sf).collect()}[-7]
    said = "</s>[INST] ok [/INST]"
    assert (minus["n_turns"], minus["loss_chars"], minus["loss_sha256"]) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert minus["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
