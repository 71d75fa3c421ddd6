import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pingline.operators import quality

T0 = datetime(2026, 3, 1)
NTZ = lambda t: F.lit(t).cast("timestamp_ntz")


def test_injected_faults_are_found_exactly(spark):
    hit = F.pmod(F.xxhash64("id"), F.lit(10)) == 0
    clean = spark.range(2000).select("id", (F.col("id") * 1.5).cast("string").alias("amount"), F.lit("t").alias("tower"), hit.alias("hit"))
    n = clean.filter("hit").count()
    spoiled = clean.withColumn("amount", F.when(F.col("hit"), "bad").otherwise(F.col("amount")))
    got = quality.corruption(spoiled.withColumn("p", F.lit(1)), ["p"], ["tower"], {"amount": "double"}).first()
    assert (got.corrupt_rows, got.total_rows) == (n, 2000)
    twice = clean.unionByName(clean.filter("hit"))
    assert quality.duplicates(twice, ["id", "amount", "tower"], "id").count() == n
    assert sorted(quality.deduplicate(twice).collect()) == sorted(clean.collect())
    gaps = quality.missing_windows(clean.select("id"), clean.filter("not hit").select("id"), ["id"])
    assert gaps.count() == n


def test_late(rows):
    df = rows([(1, T0 + timedelta(minutes=30)), (2, T0 + timedelta(minutes=30, microseconds=1)), (3, T0)], "id int, at timestamp_ntz")
    assert [r.id for r in quality.late(df, "at", NTZ(T0), 1800).collect()] == [2]


def test_out_of_order_counts_steps_back(rows):
    minutes = [0, 5, 3, 4, 2, 9]
    df = rows([("f", i, T0 + timedelta(minutes=m)) for i, m in enumerate(minutes)], "f string, pos long, ts timestamp_ntz")
    for size in (1, 2, 100):
        got = quality.out_of_order(df, ["f"], "pos", chunk_size=size).first()
        assert (got.total_rows, got.out_of_order_rows) == (6, 2)


def test_flapping_matches_brute_force(rows):
    rng = random.Random(3)
    at, data = T0, []
    for i in range(400):
        at += timedelta(seconds=rng.choice([10, 30, 200]))
        data.append(("m", i, at, rng.choice(["healthy", "critical"])))
    df = rows(data, "m string, id long, ts timestamp_ntz, status string")
    got = {r.id: r.toggles for r in quality.flapping(df, "m", "status", "ts", "id", 300, 4).collect()}
    changes = [(d[1], d[2]) for p, d in zip(data, data[1:]) if p[3] != d[3]]
    want = {i: sum(t - timedelta(seconds=300) <= u <= t for _, u in changes) for i, t in changes}
    assert got == {i: n for i, n in want.items() if n >= 4}


def test_stale_triggers_match_brute_force(rows):
    rng = random.Random(4)
    done = [(i, rng.choice("ab"), T0 + timedelta(seconds=rng.randrange(40_000))) for i in range(120)]
    ups = [(rng.choice("ab"), T0 + timedelta(seconds=rng.randrange(40_000))) for _ in range(30)]
    ups.append((done[0][1], done[0][2] + timedelta(seconds=1800)))
    got = quality.stale_triggers(rows(done, "id int, k string, ts timestamp_ntz"), rows(ups, "k string, ts timestamp_ntz"), "k")
    want = {i for i, k, t in done if not any(k == u and t < v <= t + timedelta(seconds=1800) for u, v in ups)}
    assert {r.id for r in got.collect()} == want


def test_schema_drift(spark, rows):
    got = quality.schema_drift(["a", "x"], ["a", "b"], spark).collect()
    assert sorted(map(tuple, got)) == [("b", "removed"), ("x", "added")]
    payloads = rows([('{"a": 1, "x": 2}',), ('{"a": 1, "b": 2}',), ('{"a": 1, "b": 2}',)], "p string")
    got = quality.payload_drift(payloads, "p", ["a", "b"]).collect()
    assert sorted(map(tuple, got)) == [("b", "removed", 1), ("x", "added", 1)]
    broken = rows([('{"a": 1',), ("[1]",), (None,), ('{"a": 1, "b": 2}',)], "p string")
    got = quality.payload_drift(broken, "p", ["a", "b"]).collect()
    assert sorted(map(tuple, got)) == [("", "absent", 1), ("", "malformed", 2)]


def test_replay_and_drift(rows):
    df = rows([("p", T0), ("p", T0 + timedelta(hours=1)), ("q", T0)], "period string, arrived_at timestamp_ntz")
    done = rows([("p", T0), ("q", T0)], "period string, completed_at timestamp_ntz")
    assert [(r.period, r.replayed_rows) for r in quality.stale_replay(df, done, ["period"]).collect()] == [("p", 1)]
    drift = quality.post_run_drift(df, ["period"], NTZ(T0 + timedelta(minutes=1))).collect()
    assert [(r.period, r.baseline, r.current, r.drift) for r in drift] == [("p", 1, 2, 1)]


def test_status_checks(rows):
    schema = "m string, status string, temperature double, vibration double, pressure double"
    df = rows([("machine_07", "critical", 25.0, 10.0, 5.0), ("machine_11", "healthy", 35.0, 12.0, 5.0)], schema)
    assert [r.m for r in quality.inconsistent_status(df).collect()] == ["machine_07"]
    assert [r.m for r in quality.phantom_entities(df, "m", ["machine_07"]).collect()] == ["machine_11"]


def test_times(rows):
    df = rows([("old", T0 - timedelta(hours=1)), ("new", T0), ("ahead", T0 + timedelta(hours=2))], "m string, updated_at timestamp_ntz")
    assert [r.m for r in quality.stale(df, NTZ(T0), 3600).collect()] == ["old"]
    assert [r.m for r in quality.in_future(df, "updated_at", NTZ(T0)).collect()] == ["ahead"]


def test_rolling_degradation(rows):
    runs = rows(list(enumerate([0.97, 0.96, 0.955, 0.94, 0.98, 0.97, 0.99, 0.5])), "run long, m double")
    got = quality.rolling_degradation(runs, "run", "m", 0.95).collect()
    assert [(r.first_run, r.last_run, r.drops, r.first_value, r.last_value) for r in got] == [(0, 3, 3, 0.97, 0.94)]


def test_references_and_keys(rows):
    refs = rows([("v1",), ("v2",), ("v2",)], "model string")
    assert [tuple(r) for r in quality.dangling_references(refs, rows([("v1",)], "model string"), "model").collect()] == [("v2", 2)]
    assert [tuple(r) for r in quality.repeated_keys(refs, ["model"]).collect()] == [("v2", 2)]
