import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pingline.operators import calendar, lookup
from pingline.operators.ordered import carry_last, id_chunk, previous, running_total, time_chunk

T0 = datetime(2026, 3, 1)


def km(a, b):
    la, lo, lb, lp = map(math.radians, (a[0], a[1], b[0], b[1]))
    x = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(x), math.sqrt(1 - x))


def brute(points):
    out = {}
    for i, (tid, *p) in enumerate(points):
        d = sorted((km(p, q), oid) for oid, *q in points if oid != tid)
        out[tid] = [o for _, o in d[:3]] + [o for x, o in d[3:5] if x <= 10.0]
    return out


def knn(rows, points):
    got = {}
    out = lookup.nearest_neighbours(rows(points, "tower_id string, lat double, lon double"))
    for r in out.orderBy("tower_id", "rank").collect():
        got.setdefault(r.tower_id, []).append(r.neighbor_id)
    return got


def cluster(rng, n, lat, lon, spread):
    return [(lat + rng.gauss(0, spread), lon + rng.gauss(0, spread)) for _ in range(n)]


def test_neighbours_match_brute_force(rows):
    rng = random.Random(5)
    places = cluster(rng, 60, 35, -100, 0.02) + cluster(rng, 40, 35.1, -100, 2) + cluster(rng, 10, 0, 179.99, 0.05)
    places += cluster(rng, 10, 0, -179.99, 0.05) + cluster(rng, 8, 89.9, 0, 0.05)
    points = [(f"t{i:03d}", *p) for i, p in enumerate(places)]
    assert knn(rows, points) == brute(points)


def test_neighbours_with_a_third_at_one_place(rows):
    rng = random.Random(6)
    places = [(35.0, -100.0)] * 40 + cluster(rng, 80, 35, -100, 0.3)
    points = [(f"t{i:03d}", *p) for i, p in enumerate(places)]
    assert knn(rows, points) == brute(points)


def test_few_towers(rows):
    points = [("a", 0.0, 0.0), ("b", 0.0, 1.0), ("c", 50.0, 50.0)]
    assert knn(rows, points) == {"a": ["b", "c"], "b": ["a", "c"], "c": ["b", "a"]}


def test_fourth_neighbour_must_be_near_and_ties_go_to_the_lower_id(rows):
    deg = 1 / 111.19492664
    near = [("m", 0.0, 0.0), ("b", 0.0, deg), ("a", 0.0, -deg), ("c", deg, 0.0), ("d", -10.1 * deg, 0.0), ("e", -10.2 * deg, 0.0)]
    assert knn(rows, near)["m"] == ["a", "b", "c"]
    closer = [*near[:4], ("d", -9.9 * deg, 0.0), ("e", -10.2 * deg, 0.0)]
    assert knn(rows, closer)["m"] == ["a", "b", "c", "d"]


def test_as_of(rows):
    at = lambda m: T0 + timedelta(minutes=m)
    data = [("p", 1, at(10), None), ("p", 2, at(20), "A"), ("p", 3, at(20), None), ("p", 4, at(500), None),
            ("p", 5, at(600), "B"), ("p", 6, at(599), None), ("p", 7, at(3000), None), ("q", 8, at(1), None)]
    df = rows(data, "k string, id int, ts timestamp_ntz, tower string")
    got = {r.id: r.now for r in lookup.as_of(df, ["k"], ["ts", "id"], "tower", "now").collect()}
    assert got == {1: "A", 2: "A", 3: "A", 4: "A", 5: "B", 6: "A", 7: "B", 8: None}


def test_as_of_matches_brute_force_with_one_busy_key(spark, rows):
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = "busy" if rng.random() < 0.4 else f"k{rng.randrange(20)}"
        data.append((key, i, T0 + timedelta(seconds=rng.randrange(200_000)), f"T{i}" if rng.random() < 0.2 else None))
    out = lookup.as_of(rows(data, "k string, id int, ts timestamp_ntz, tower string"), ["k"], ["ts", "id"], "tower", "now", 1800)
    for r in out.collect():
        mine = sorted((d[2], d[1], d[3]) for d in data if d[0] == r.k and d[3])
        before = [x for x in mine if (x[0], x[1]) <= (r.ts, r.id)]
        assert r.now == (before[-1][2] if before else mine[0][2] if mine else None)


def test_weighted_pick_matches_bisect(spark, rows):
    import bisect

    n = 300
    shares = lookup.cumulative_shares(spark.range(1, n + 1).withColumnRenamed("id", "rank")).cache()
    bounds = [r.hi for r in shares.orderBy("rank").collect()]
    assert bounds[-1] == 1.0 and bounds == sorted(bounds)
    raw = [1 / r**0.8 for r in range(1, n + 1)]
    assert all(abs(b - sum(raw[: i + 1]) / sum(raw)) < 1e-9 for i, b in enumerate(bounds))
    rng = random.Random(8)
    us = [rng.random() for _ in range(500)] + [0.0, 1.0, bounds[0], bounds[10], math.nextafter(bounds[10], 2)] + [0.5] * 200
    probes = rows(list(enumerate(us)), "id int, u double")
    got = {r.id: r.rank for r in lookup.weighted_pick(probes, shares).collect()}
    assert got == {i: bisect.bisect_left(bounds, u) + 1 for i, u in enumerate(us)}


# ---- ordered helpers ----------------------------------------------------


@pytest.mark.parametrize("chunk,fan", [(1, 2), (7, 3), (1000, 4096)])
def test_running_total(rows, chunk, fan):
    rng = random.Random(9)
    data = [("ab"[rng.random() < 0.7], i, rng.randrange(10)) for i in rng.sample(range(2000), 300)]
    df = rows(data, "k string, i long, v long")
    out = running_total(df, ["k"], ["i"], {"upto": "v", "n": F.lit(1)}, id_chunk("i", chunk), fan).collect()
    assert len(out) == 300
    for r in out:
        mine = [d for d in data if d[0] == r.k and d[1] <= r.i]
        assert (r.upto, r.n) == (sum(d[2] for d in mine), len(mine))


@pytest.mark.parametrize("seconds", [1, 60, 100_000])
def test_previous_and_carry(rows, seconds):
    rng = random.Random(10)
    data = [("ab"[rng.random() < 0.7], i, T0 + timedelta(seconds=rng.randrange(5000)), rng.choice([None, i])) for i in range(200)]
    df = rows(data, "k string, id int, ts timestamp_ntz, v int")
    chunk = time_chunk("ts", seconds)
    before = {r.id: r.prev for r in previous(df, ["k"], ["ts", "id"], {"prev": "id"}, chunk).collect()}
    carried = {r.id: r.now for r in carry_last(df, ["k"], ["ts", "id"], "v", "now", chunk).collect()}
    for k in "ab":
        seq = sorted((d[2], d[1], d[3]) for d in data if d[0] == k)
        last = None
        for i, (_, rid, v) in enumerate(seq):
            last = v if v is not None else last
            assert before[rid] == (seq[i - 1][1] if i else None)
            assert carried[rid] == last


# ---- windows and sessions -----------------------------------------------


def sessions(rows):
    rng = random.Random(11)
    data = [(i, T0 + timedelta(seconds=rng.randrange(7200)), rng.randrange(0, 900)) for i in range(150)]
    return data, rows(data, "session_id int, start_ts timestamp_ntz, duration_s int")


def test_every_ping_is_in_exactly_one_window(rows):
    data, df = sessions(rows)
    pings = calendar.explode_pings(df).cache()
    assert pings.count() == sum(max(1, d // 10) for _, _, d in data)
    total = 0
    for w in range(16):
        low, high = T0 + timedelta(minutes=15 * w), T0 + timedelta(minutes=15 * w + 15)
        total += calendar.clip(pings, F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")).count()
    assert total == pings.count()
    windows = calendar.window_totals(calendar.assign_windows(pings)).collect()
    assert sum(r.pings for r in windows) == total
    assert all(r.window_start.minute % 15 == 0 for r in windows)


def test_ping_at_the_end_belongs_to_the_next_window(rows):
    df = rows([(1, T0 + timedelta(minutes=14, seconds=50), 25)], "session_id int, start_ts timestamp_ntz, duration_s int")
    got = {r.window_start: (r.pings, r.spilled_pings) for r in calendar.window_totals(calendar.assign_windows(calendar.explode_pings(df))).collect()}
    assert got == {T0: (1, 0), T0 + timedelta(minutes=15): (1, 1)}


def test_calendar(spark):
    got = calendar.calendar_between(spark, "2026-03-01 00:07:00", "2026-03-01 01:00:00", streams=["cdr", "seq"])
    assert got.count() == 10
    assert got.agg(F.min("window_start")).first()[0] == T0


def test_sparse_ids_and_a_burst(rows):
    """Chunks of one row, and a chunk with nearly all rows, in several groups of chunks."""
    ids = [i * 1_000_003 for i in range(40)] + list(range(50_000_000, 50_000_200))
    df = rows([("a", i, i if i % 3 == 0 else None) for i in ids], "k string, id long, v long")
    chunk = id_chunk("id", 1000)
    before = {r.id: r.prev for r in previous(df, [], ["id"], {"prev": "id"}, chunk, fan=7).collect()}
    carried = {r.id: r.now for r in carry_last(df, ["k"], ["id"], "v", "now", chunk, fan=7).collect()}
    last, known = None, None
    for i in sorted(ids):
        known = i if i % 3 == 0 else known
        assert (before[i], carried[i]) == (last, known)
        last = i


def test_spread_join_equals_a_join(spark):
    from pingline.operators.joins import spread_join

    many = spark.range(500).select("id", F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 9).alias("k"))
    side = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        got = spread_join(many, side, ["k"], how).select("k", "id", "v")
        assert sorted(map(str, got.collect())) == sorted(map(str, many.join(side, "k", how).select("k", "id", "v").collect()))
