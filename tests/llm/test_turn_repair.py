"""Conversation repair against an exhaustive search and a plain pass over the rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pingline.llm import turn_repair as tr
from pingline.llm.queries import QUERIES

RNG = random.Random(13)


def plain(rows):
    """Cheapest (cost, edits) by relaxing every state until nothing changes; states are (rows
    used, last initial), all of them, with whole edit strings."""
    best = {(0, ""): (0, "", [])}
    for i in range(len(rows) + 1):
        changed = True
        while changed:  # insertions
            changed = False
            for (j, last), (cost, edits, out) in list(best.items()):
                if j != i:
                    continue
                for role in ("user", "assistant"):
                    if ok(last, role[0]):
                        new = (cost + 5, edits + "I", [*out, (role, "")])
                        if (i, role[0]) not in best or new[:2] < best[i, role[0]][:2]:
                            best[i, role[0]], changed = new, True
        if i == len(rows):
            break
        initial, fault, _, role, text = rows[i]
        for (j, last), (cost, edits, out) in list(best.items()):
            if j != i:
                continue
            moves = [(last, 2, "D", [])]
            if fault not in (tr.BLANK, tr.DUPLICATE):
                extra = 5 if fault == tr.CUT else 0
                if ok(last, initial):
                    moves.append((initial, extra, "K", [(role, text)]))
                moves += [(r[0], 1 + extra, "R", [(r, text)]) for r in ("user", "assistant") if ok(last, r[0])]
            for to, c, e, line in moves:
                new = (cost + c, edits + e, out + line)
                if (i + 1, to) not in best or new[:2] < best[i + 1, to][:2]:
                    best[i + 1, to] = new
    cost, edits, out = min((best[k] for k in ((len(rows), ""), (len(rows), "a")) if k in best), key=lambda x: x[:2])
    return cost, edits, "\n".join(f"{r}:{t}" for r, t in out)


def ok(last, initial):
    return (last + initial) in ("s", "u", "su", "ua", "au")


def conversation(n, roles="suaax"):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    out = []
    for i in range(n):
        role = names[RNG.choice(roles)]
        out.append(tr.Row(role[0], RNG.choice([0, 0, 0, 1, 2, 3]), i, role, f"t{i}"))
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 8, 13, 30])
def test_search_is_the_cheapest_and_ascii_least(n):
    for _ in range(60 if n < 20 else 15):
        rows = conversation(n)
        cost, edits = tr.cheapest(rows)
        want = plain(rows)
        assert (cost, edits) == want[:2]
        assert "\n".join(f"{r}:{t}" for r, t in tr.replayed(rows, edits)) == want[2]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in tr.replayed(rows, edits)))


@pytest.mark.parametrize("size", [1, 2, 7])
def test_pieces_join_to_the_whole(size):
    for _ in range(40):
        rows = conversation(RNG.randint(1, 25))
        joined = tr.Joined()
        for at in range(0, len(rows), size):
            joined.add(tr.piece_of(rows[at:at + size]))
        cost, edits, text = plain(rows)
        assert joined.result()[5:] == (cost, edits, hashlib.sha256(text.encode()).hexdigest())


def brute(rows):
    """The whole contract, from the original rows."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        at = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        way = zlib.crc32(at.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        convs[conv] += [(turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    out = {}
    for conv, turns in convs.items():
        name = "" if conv is None else f"={conv}"
        same = lambda r, t: hashlib.sha256(f"{len(name)}:{name}:{len(r)}:{r}:{t}".encode()).digest()
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], same(x[1], x[2])))
        seen, marked = set(), []
        for turn, role, text in turns:
            end = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = tr.BLANK if not end else tr.DUPLICATE if (role, text) in seen else tr.CUT if end[-1] not in ".!?" else 0
            seen.add((role, text))
            marked.append(tr.Row(role[:1] or " ", fault, turn, role, text))
        cost, edits, text = plain(marked)
        numbers = {r.turn for r in marked} - {None}
        initials = [r.initial for r in marked]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
                     *(sum(r.fault == f for r in marked) for f in (tr.BLANK, tr.DUPLICATE, tr.CUT)),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, edits, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}


def table(ready, rows):
    data = [(*r, "x", 1, 2, 3) for r in rows]
    return ready.createDataFrame(data, "conv_id long, turn long, role string, text string, part string, row int, same int, fault int")


def sayings():
    rows = []
    for conv in [*range(60), None]:
        for turn in range(RNG.randint(1, 9)):
            role = RNG.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = RNG.choice(["Ja.", "so", " ", "", None, "eh?\n", "Nein! ", f"das {turn}.", "Δ ß.", "\x0b\x0c", "a. "])
            rows.append((conv, RNG.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += rows[:7]  # repeated rows
    rows += [(900, t, "user" if t % 2 == 0 else "assistant", f"line {t % 50}.") for t in range(700)]  # a long one
    rows += [(901, t, "user", "word " * 40_000 + f"{t}.") for t in range(4)]  # very long texts
    rows += [(902, 5, "user", "tie."), (902, 5, "assistant", "tie."), (902, 5, "user", "a tie.")]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone"))
    RNG.shuffle(rows)
    return rows


ROWS = sayings()


def test_equals_brute_force(ready):
    want = brute(ROWS)
    assert got(tr.after_damage(table(ready, ROWS))) == want
    assert sum(v[6] == "" for v in want.values()) >= 1


def test_partitioning_does_not_matter(ready):
    want = brute(ROWS)
    before = ready.conf.get("spark.sql.shuffle.partitions")
    try:
        ready.conf.set("spark.sql.shuffle.partitions", "97")  # most conversations lie at a border
        assert got(tr.after_damage(table(ready, ROWS).repartition(13))) == want
    finally:
        ready.conf.set("spark.sql.shuffle.partitions", before)


def test_empty(ready):
    assert tr.after_damage(table(ready, [])).count() == 0


def test_query_on_the_given_table(ready):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in ready.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op13_turn_repair"](ready, d)
    assert [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"] * 2
    assert got(df) == brute(rows)
