"""Streams that correct, remember, latch, time out, compact and isolate."""

import gzip
import os
import time
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pingline.session import scratch_path
from pingline.sources import bronze
from pingline.streaming import isolate, jobs, keyed
from pingline.streaming.corrections import CorrectedWindows
from pingline.streaming.seen import SeenKeys
from pingline.streaming.tiers import Tiers, tiered

T0 = datetime(2026, 3, 1)


def where(spark, name="state"):
    base = scratch_path(spark, name).removeprefix("file:")
    return f"{base}/in", f"{base}/out", f"{base}/checkpoint"


def deliver(spark, folder, number, rows, schema):
    """One file of a stream, later than all before it."""
    path = f"{folder}/file={number:03d}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    for name in os.listdir(path):
        os.utime(f"{path}/{name}", (1_700_000_000 + number, 1_700_000_000 + number))


def stream(spark, folder, schema, per_trigger=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(f"{folder}/*")


# ---- corrections -----------------------------------------------------------


def at(minutes):
    return T0 + timedelta(minutes=minutes)


PINGS = "stream string, ts timestamp"


def windows_of(batches, delay=10):
    """What every batch writes, by a plain pass."""
    newest, open_, written, out = None, defaultdict(int), {}, []
    for batch, rows in enumerate(batches):
        before = newest
        late = defaultdict(int)
        for name, minute in rows:
            if minute is None:
                continue
            w = (name, minute // 15 * 15)
            if before is not None and w[1] + 15 <= before - delay:
                late[w] += 1
            else:
                open_[w] += 1
            newest = minute if newest is None else max(newest, minute)
        for w, change in late.items():
            revision, total = written.get(w, (0, 0))
            written[w] = (revision + 1, total + change)
            out.append((*w, revision + 1, total + change, change, batch))
        for w in [w for w in open_ if newest is not None and w[1] + 15 <= newest - delay]:
            written[w] = (0, open_[w])
            out.append((*w, 0, open_[w], open_.pop(w), batch))
    return sorted(out)


def test_corrections_follow_a_plain_pass(spark):
    batches = [
        [("a", 0), ("a", 3), ("b", 14), ("a", None)], [("a", 40), ("b", 44)], [("a", 1), ("a", 2), ("b", 50), ("b", 5)],
        [("a", 2), ("a", 90)], [("c", 7), ("a", 4), ("c", 8)], [("c", 7)], [], [("b", 100), ("a", 91), ("b", 61)], [("b", 61), ("a", 200)],
    ]
    folder, out, checkpoint = where(spark)
    for i, rows in enumerate(batches):
        deliver(spark, folder, i, [(n, None if m is None else at(m)) for n, m in rows], PINGS)
    windows = CorrectedWindows(spark, out, {"stream": "string"})
    half = lambda: jobs.run_available(stream(spark, folder, PINGS), windows.on_batch, checkpoint)
    half()
    deliver(spark, folder, 99, [("a", at(3))], PINGS)  # the stream goes on where it stopped
    half()
    minutes = lambda t: int((t - T0).total_seconds() // 60)
    got = sorted((r.stream, minutes(r.window_start), r.revision, r.records, r.change, r.batch) for r in windows.changes().collect())
    # a file without rows is a micro-batch too
    assert got == windows_of([*batches, [("a", 3)]])
    assert {r[2] for r in got} >= {0, 1, 2}
    last = {}
    for name, minute, revision, records, _, _ in got:
        last[name, minute] = (records, max(revision, last.get((name, minute), (0, 0))[1])) if revision >= last.get((name, minute), (0, 0))[1] else last[name, minute]
    assert {(r.stream, minutes(r.window_start)): (r.records, r.revision) for r in windows.current().collect()} == last


def test_a_batch_that_runs_again_writes_the_same(spark):
    _, out, _ = where(spark)
    windows = CorrectedWindows(spark, out, {"stream": "string"})
    frames = [spark.createDataFrame([(n, at(m)) for n, m in rows], PINGS) for rows in ([("a", 0)], [("a", 60)], [("a", 1), ("b", 2)])]
    for i, frame in enumerate(frames):
        windows.on_batch(frame, i)
        once = sorted(map(str, windows.changes().collect()))
        windows.on_batch(frame, i)
        assert sorted(map(str, windows.changes().collect())) == once


# ---- keys seen -------------------------------------------------------------


def test_keys_are_known_for_ever(spark):
    schema = "id long, part string, v int"
    folder, out, checkpoint = where(spark)
    first = [(i, "x", 1) for i in range(50)]
    for i, rows in enumerate([first, [*first, (7, "y", 2), (None, "x", 3)], [(None, "x", 4), (None, None, 5)], [], first, [(99, "z", 6)] * 5]):
        deliver(spark, folder, i, rows, schema)
    seen = SeenKeys(spark, out, ["id", "part"], buckets=4, compact_every=2)
    jobs.run_available(stream(spark, folder, schema), seen.on_batch, checkpoint)
    deliver(spark, folder, 98, [*first, (100, "z", 7)], schema)
    jobs.run_available(stream(spark, folder, schema), seen.on_batch, checkpoint)  # after a restart too
    got = sorted((str(r.id), str(r.part)) for r in seen.rows().collect())
    assert got == sorted([*((str(i), "x") for i in range(50)), ("7", "y"), ("None", "x"), ("None", "None"), ("99", "z"), ("100", "z")])
    # compaction leaves few folders
    assert all(len(os.listdir(f"{out}/index/{b}")) <= 4 for b in os.listdir(f"{out}/index") if b.startswith("bucket="))


def test_a_batch_that_runs_again_finds_its_rows_new(spark):
    _, out, _ = where(spark)
    seen = SeenKeys(spark, out, ["id"], buckets=2, compact_every=0)
    a, b = (spark.createDataFrame([(i,) for i in r], "id long") for r in (range(10), range(5, 15)))
    for frame, number in ((a, 0), (b, 1), (b, 1)):
        seen.on_batch(frame, number)
    assert sorted(r.id for r in seen.rows().collect()) == list(range(15))


def test_dedup_over_many_shuffled_files(spark):
    folder, out, checkpoint = where(spark)
    rows = spark.range(1000).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 2600).alias("ts"))
    rows.union(rows).repartition(40, F.rand(3)).write.parquet(f"{folder}/once")
    seen = SeenKeys(spark, out, ["event_id"], compact_every=3)
    jobs.run_available(stream(spark, folder, "event_id long, ts timestamp", 6), seen.on_batch, checkpoint)
    assert seen.rows().count() == 1000 == seen.rows().distinct().count()


# ---- latch -------------------------------------------------------------------


def test_latch_is_written_once(spark):
    schema = "period string, batch_no int, quality double, ts timestamp"
    folder, out, checkpoint = where(spark)
    read = lambda batch, good, bad, minute: [("p", batch, 0.9, at(minute))] * good + [("p", batch, 0.1, at(minute + 1))] * bad
    deliver(spark, folder, 0, read(0, 11, 0, 0), schema)
    deliver(spark, folder, 1, [*read(1, 5, 1, 10), ("q", 0, None, at(0)), (None, 0, 0.9, at(0))], schema)
    deliver(spark, folder, 2, read(2, 0, 500, 20), schema)  # far below the share now
    run = lambda: jobs.append_available(keyed.weather_latch(stream(spark, folder, schema)), out, checkpoint)
    run()
    once = spark.read.parquet(out).collect()
    assert [(r.period, r.batch_no, r.total_then, r.valid_then, r.batches_then) for r in once] == [("p", 1, 17, 16, 2)]
    assert once[0].latched_at == at(11)
    deliver(spark, folder, 3, read(3, 5000, 0, 30), schema)  # above it again: no second latch, nor a moved one
    run()  # from the checkpoint
    assert spark.read.parquet(out).collect() == once


# ---- absence -----------------------------------------------------------------


def test_timers_report_what_never_came(spark):
    folder, out, checkpoint = where(spark)
    hours = [[("a", 5), ("b", 10)], [("a", 20), ("x", 21)], [("a", 50)], [("a", 95)], [("a", 200), ("b", 199)]]
    for i, rows in enumerate(hours):
        deliver(spark, folder, i, [(n, at(m)) for n, m in rows], PINGS)
    since = int((T0 - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    run = lambda: jobs.append_available(keyed.absent_windows(stream(spark, folder, PINGS), "stream", ["a", "b", "silent"], since), out, checkpoint)
    run()
    got = sorted((r.stream, int((r.window_start - T0).total_seconds()) // 60) for r in spark.read.parquet(out).collect())
    closed = range(0, 200 - 10 - 14, 15)
    here = {("a", 0), ("b", 0), ("a", 15), ("a", 45), ("a", 90)}
    assert got == sorted((n, w) for n in ("a", "b", "silent") for w in closed if (n, w) not in here)
    run()  # nothing new, nothing twice
    assert spark.read.parquet(out).count() == len(got)


def test_unanswered_starts(spark):
    schema = "name string, event_id long, kind string, ts timestamp"
    folder, out, checkpoint = where(spark)
    rows = [("j", 1, "done", 0), ("j", 2, "done", 5), ("j", 3, "next", 5), ("j", 4, "done", 50), ("k", 5, "next", 55), ("j", 6, "other", 60),
            ("k", 7, "done", 70), ("k", 8, "next", 100), ("j", 9, "done", 101), ("j", 10, "done", 190), ("z", 11, "other", 400), ("j", 12, "next", 300)]
    for i in range(0, len(rows), 3):
        deliver(spark, folder, i, [(n, e, k, at(m)) for n, e, k, m in rows[i:i + 3]], schema)
    late = keyed.unanswered(stream(spark, folder, schema), "name", F.col("kind") == "done", F.col("kind") == "next", 1800, salts=3)
    jobs.append_available(late, out, checkpoint)
    # 1 is answered by 3; 2 is not, as an answer comes later than its start; 7 just in time
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [2, 4, 9, 10]


class HeldState:
    """A state as the timers' functions see it, in one process."""

    def __init__(self):
        self.get, self.mark, self.hasTimedOut = None, 0, False

    exists = property(lambda self: self.get is not None)

    def update(self, value):
        self.get = value

    def remove(self):
        self.get = None

    def setTimeoutTimestamp(self, millis):
        assert millis > self.mark

    def getCurrentWatermarkMs(self):
        return self.mark


def test_a_busy_name_costs_no_time_per_pair_and_no_state_per_row():
    within, hour, n = 1_800_000_000, 3_600_000_000, 10_000
    draw = np.random.default_rng(4)
    base = int((T0 - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    us = base + draw.integers(0, 3 * hour, 2 * n) + np.repeat([0, 6 * hour], n)  # two busy spells, quiet between
    starts = draw.random(2 * n) < 0.5
    frame = pd.DataFrame({"event_id": np.arange(2 * n), "us": us, "starts": starts})
    last = np.sort(us[~starts])
    after = np.append(last, 2**62)[np.searchsorted(last, us, side="right")]
    want = frame.event_id[starts & (after > us + within)].tolist()
    follow, state, got, sizes = keyed._follow(within), HeldState(), [], []
    began = time.perf_counter()
    for spell in (0, 1):
        chunks = [frame[i:min(i + 3000, (spell + 1) * n)] for i in range(spell * n, (spell + 1) * n, 3000)]
        got += [i for out in follow(("j",), iter(chunks), state) for i in out["event_id"]]
        sizes.append(sum(map(len, state.get)))
        state.mark = (base + (6 * spell + 3) * hour) // 1000 - 600_000
    state.hasTimedOut, state.mark = True, (base + 10 * hour) // 1000
    got += [i for out in follow(("j",), iter(()), state) for i in out["event_id"]]
    assert time.perf_counter() - began < 5
    assert sorted(got) == want and want
    # unanswered starts, and two follow-ups for each half hour
    assert max(sizes) < 100 and not state.exists


# ---- tiers -------------------------------------------------------------------


def adding(spark, path, fan):
    return Tiers(spark, path, lambda df: df.groupBy("k").agg(F.sum("n").alias("n")), fan)


def test_tiers_keep_reads_few(spark):
    _, out, _ = where(spark)
    tiers = adding(spark, out, 4)
    for i in range(90):
        tiers.add(spark.createDataFrame([(i % 3, 1), (9, i)], "k int, n long").coalesce(1), i)
        if i % 13 == 0:
            tiers.add(spark.createDataFrame([(0, 10**6)], "k int, n long"), i)  # delivered again: already there
    assert len(tiers.parts()) <= 3 * 4
    assert sum(p["last"] - p["first"] + 1 for p in tiers.parts()) == 90
    got = {r.k: r.n for r in tiers.total().collect()}
    assert got == {0: 30, 1: 30, 2: 30, 9: sum(range(90))}
    # parts that merges replaced are deleted, but for the last few
    left = sum(len(os.listdir(f"{out}/{level}")) for level in os.listdir(out) if level.startswith("level"))
    assert left <= len(tiers.parts()) + 4 * 8


def test_a_part_without_manifest_does_not_count(spark):
    _, out, _ = where(spark)
    tiers = adding(spark, out, 4)
    assert tiers.total() is None
    tiers.add(spark.createDataFrame([(1, 1)], "k int, n long"), 0)
    spark.createDataFrame([(1, 50)], "k int, n long").write.parquet(f"{out}/level0/batch=1")  # the run that failed
    assert [(r.k, r.n) for r in tiers.total().collect()] == [(1, 1)]
    tiers.add(spark.createDataFrame([(1, 2)], "k int, n long"), 1)
    assert [(r.k, r.n) for r in tiers.total().collect()] == [(1, 3)]


def test_streams_in_tiers_give_the_counts(spark):
    folder, out, checkpoint = where(spark)
    schema = "k int, n long"
    for i in range(11):
        deliver(spark, folder, i, [(i % 2, 1), (5, i)], schema)
    tiers = adding(spark, out, 3)
    jobs.run_available(stream(spark, folder, schema), tiered(tiers, lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))), checkpoint)
    assert {r.k: r.n for r in tiers.total().collect()} == {0: 6, 1: 5, 5: 55}


# ---- isolation ---------------------------------------------------------------


def test_bad_files_go_alone(spark, rows):
    folder, out, checkpoint = where(spark)
    hour = f"{folder}/par_day=20260301/par_hour=04"
    os.makedirs(hour)
    line = '{"phone_out": "%d", "phone_in": "2", "cell_tower": "T", "time": "2026-03-01T04:00:00Z"}\n'
    for i in range(24):
        data = gzip.compress((line % i * 3 + ("no json\n" if i == 5 else "")).encode())
        with open(f"{hour}/{i:02d}.jsonl.gz", "wb") as f:
            f.write(data[:-9] if i in (3, 4, 17) else b"not gzip at all" if i == 20 else data)
    dimension = rows([("1", "known", T0)], "phone string, hash string, created_at timestamp_ntz")
    store, probe = jobs.ping_files(dimension, "salt")
    jobs.run_available(isolate.notifications(spark, folder, "*.jsonl.gz", 10), isolate.isolating(out, store, probe), checkpoint)
    assert spark.read.parquet(f"{out}/bronze").count() == 20 * 3
    assert spark.read.parquet(f"{out}/quarantine").count() == 1
    dead = isolate.dead_letters(spark, out).collect()
    assert sorted(r.path[-11:-9] for r in dead) == ["03", "04", "17", "20"] and all(r.error and r.attempts == 3 for r in dead)
    counted = spark.read.parquet(f"{out}/counters").agg(F.sum("records")).first()[0]
    assert counted == 60


def test_an_unreadable_file_fails_before_pings_are_shuffled(spark, rows):
    folder, out, _ = where(spark)
    os.makedirs(hour := f"{folder}/par_day=20260301/par_hour=04")
    data = gzip.compress(b'{"phone_out": "1", "phone_in": "2", "cell_tower": "T", "time": "2026-03-01T04:00:00Z"}\n' * 50)
    for name, content in (("good", data), ("truncated", data[:-9])):
        with open(f"{hour}/{name}.jsonl.gz", "wb") as f:
            f.write(content)
    asked = []
    store, _ = jobs.ping_files(rows([("1", "known", T0)], "phone string, hash string, created_at timestamp_ntz"), "salt")
    with pytest.raises(Exception):
        store(spark, [f"{hour}/{name}.jsonl.gz" for name in ("good", "truncated")], lambda table: asked.append(table) or f"{out}/{table}")
    assert asked == []


def test_storing_that_fails_is_halved(spark):
    _, out, _ = where(spark)

    def store(session, paths, folder):
        session.createDataFrame([(p,) for p in paths], "path string").write.parquet(folder("t"))
        if "c" in paths:
            raise ValueError("c cannot be stored")

    on_batch = isolate.isolating(out, store, lambda session, paths: None)
    batch = spark.createDataFrame([(p,) for p in "abcde"], "path string")
    for _ in range(2):  # a rerun leaves one copy
        on_batch(batch, 0)
        assert sorted(r.path for r in spark.read.parquet(f"{out}/t").collect()) == list("abde")
        assert [(r.path, r.batch) for r in isolate.dead_letters(spark, out).collect()] == [("c", 0)]


# ---- records by offset ---------------------------------------------------------


def test_records_come_once_in_batches(spark):
    from pingline.sources import records

    folder, out, checkpoint = where(spark)
    payloads = lambda low, high: spark.range(low, high, 1, 3).select(F.concat(F.lit("é"), F.col("id")).alias("payload"))
    assert records.append_records(payloads(0, 23), folder, 4) == 23
    run = lambda: jobs.append_available(records.record_stream(spark, folder, records.NOTIFICATION_BATCH), out, checkpoint)
    run()
    run()  # nothing new
    assert spark.read.parquet(out).count() == 23
    assert records.append_records(payloads(23, 31), folder) == 31
    run()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("record", "batch", "payload").collect())
    assert got == [(i, i // 5, f"é{i}") for i in range(31)]
    reader = records.RecordReader(folder, 5)
    assert reader.latestOffset() == {"record": 31} and records.RecordReader(folder, 5).partitions({"record": 31}, {"record": 31}) == []
    # a planned batch is read again just as it was
    again = [r for p in reader.partitions({"record": 7}, {"record": 25}) for r in reader.read(p)]
    assert again == [(i, i // 5, f"é{i}") for i in range(7, 25)]
