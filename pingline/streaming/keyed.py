"""Jobs whose answer is a state per key: a latch that is written once, and timers that speak
when nothing came.

What a micro-batch holds of a key is added up inside each partition before it travels, so the
task that holds a busy key's state gets a few rows per partition, not the key's rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pingline.functions.columns import VALID_QUALITY, epoch_micros
from pingline.operators.monitoring import MIN_READINGS, MIN_VALID_SHARE

# ---- latch -----------------------------------------------------------------


def _batch_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(period, batch_no, valid, ts) rows to counts per period and weather batch."""
    held = []
    for batch in batches:
        t = batch.to_pandas()
        held.append(t.groupby(["period", "batch_no"], dropna=False).agg(total=("valid", "size"), valid=("valid", "sum"), arrived=("us", "max")).reset_index())
    if held:
        t = pd.concat(held).groupby(["period", "batch_no"], dropna=False, as_index=False).agg({"total": "sum", "valid": "sum", "arrived": "max"})
        yield pa.RecordBatch.from_pandas(t.astype({"batch_no": "int32", "total": "int64", "valid": "int64", "arrived": "int64"}), preserve_index=False)


_COUNTS = "period string, batch_no int, total long, valid long, arrived long"
_LATCH = "total long, valid long, batches long, latched boolean"


def _latch(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    total, valid, batches, latched = state.get if state.exists else (0, 0, 0, False)
    parts = pd.concat(list(frames)).groupby("batch_no", as_index=False).agg({"total": "sum", "valid": "sum", "arrived": "max"})
    out = []
    # counters always grow; the flag is only ever set, and only where it was not
    for row in parts.sort_values(["arrived", "batch_no"]).itertuples(index=False):
        total, valid, batches = total + int(row.total), valid + int(row.valid), batches + 1
        if not latched and total >= MIN_READINGS and valid / total >= MIN_VALID_SHARE:
            latched = True
            out.append((key[0], int(row.batch_no), int(row.arrived), total, valid, batches))
    state.update((total, valid, batches, latched))
    if out:
        yield pd.DataFrame(out, columns=["period", "batch_no", "arrived", "total_then", "valid_then", "batches_then"])


def weather_latch(readings: DataFrame) -> DataFrame:
    """One row per period, when its counters first meet the thresholds; nothing that comes later
    changes or repeats it. ``readings`` is a stream of (period, batch_no, quality, ts)."""
    valid = F.coalesce(F.col("quality") >= VALID_QUALITY, F.lit(False)).cast("int")
    slim = readings.where("period IS NOT NULL").select("period", F.col("batch_no").cast("int").alias("batch_no"), valid.alias("valid"), epoch_micros("ts").alias("us"))
    latched = slim.mapInArrow(_batch_counts, _COUNTS).groupBy("period").applyInPandasWithState(
        _latch, "period string, batch_no int, arrived long, total_then long, valid_then long, batches_then long", _LATCH, "append", GroupStateTimeout.NoTimeout)
    return latched.withColumn("latched_at", F.timestamp_micros("arrived")).drop("arrived")


# ---- absence -----------------------------------------------------------------


def _presence(roster: list[str], width: int):
    """(name, us) rows to the windows each name was seen in, and a tick per name of the roster
    at the newest time, so that names without a row get a state, and its timers, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], int] = {}
        newest = None
        for batch in batches:
            for name, us in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if us is None:
                    continue
                newest = us if newest is None else max(newest, us)
                if name is not None:
                    at = (name, us // width)
                    seen[at] = max(us, seen.get(at, us))
        if newest is None:
            return
        rows = [(name, window, us) for (name, window), us in seen.items()] + [(name, None, newest) for name in roster]
        names, windows, times = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(windows, pa.int64()), pa.array(times, pa.timestamp("us", "UTC"))], ["name", "at", "ts"])

    return run


def _watch(roster: list[str], first: int, width: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[0] not in roster:
            return
        frontier, seen = state.get if state.exists else (first, [])
        seen = set(seen)
        if not state.hasTimedOut:
            for frame in frames:
                seen.update(int(x) for x in frame["at"].dropna())
        passed = state.getCurrentWatermarkMs() * 1000 // width  # windows below this number have ended
        missing = [w for w in range(frontier, passed) if w not in seen]
        frontier = max(frontier, passed)
        state.update((frontier, sorted(w for w in seen if w >= frontier)))
        state.setTimeoutTimestamp(max((frontier + 1) * width // 1000, state.getCurrentWatermarkMs() + 1))
        for at in range(0, len(missing), 10_000):
            yield pd.DataFrame({"name": key[0], "at": missing[at:at + 10_000]})

    return run


def absent_windows(events: DataFrame, name: str, roster: list[str], since_micros: int, seconds: int = 900, delay: str = "10 minutes") -> DataFrame:
    """A row for every window, from ``since`` on, that the watermark passed without an event of
    a name in the roster: name, window_start. ``events`` is a stream with ``ts``."""
    width = seconds * 1_000_000
    slim = events.select(F.col(name).alias("name"), epoch_micros("ts").alias("us"))
    seen = slim.mapInArrow(_presence(roster, width), "name string, at long, ts timestamp").withWatermark("ts", delay)
    missing = seen.groupBy("name").applyInPandasWithState(
        _watch(roster, since_micros // width, width), "name string, at long", "frontier long, seen array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    return missing.select(F.col("name").alias(name), F.timestamp_micros(F.col("at") * width).alias("window_start"))


# ---- follow-ups ----------------------------------------------------------------

_NEVER = np.iinfo("int64").max  # later than any deadline


def _ends(times: np.ndarray, width: int) -> np.ndarray:
    """The first and the last time of every ``width`` wide slot, ascending. A start has a later
    time within ``width`` among these just when it has one among all: one in its own slot if
    the slot's last is later, one in the next slot if that slot's first comes early enough."""
    times = np.sort(times)
    turns = np.diff(times // width) != 0
    return times[np.append(True, turns) | np.append(turns, True)] if len(times) else times


def _follow(within: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ids, times, follows = (np.array(x, "int64") for x in (state.get if state.exists else ([], [], [])))
        if not state.hasTimedOut:
            held = [(ids, times, follows)]
            for frame in frames:
                starts = frame["starts"].to_numpy("bool")
                begun, came = frame[starts].astype({"event_id": "int64", "us": "int64"}), frame["us"][~starts].astype("int64")
                held.append((begun["event_id"].to_numpy(), begun["us"].to_numpy(), _ends(came.to_numpy(), within)))
            ids, times, follows = map(np.concatenate, zip(*held))
            follows = _ends(follows, within)
        now = state.getCurrentWatermarkMs() * 1000
        first = np.searchsorted(follows, times, side="right")  # later than the start
        answered = np.append(follows, _NEVER)[first] <= times + within
        due = times + within <= now  # no follow-up can come any more
        late, open_ = ~answered & due, ~answered & ~due
        # what has not arrived yet is later than the watermark, and so is what it looks for
        follows = follows[follows > now - within]
        if open_.any():
            state.update((ids[open_].tolist(), times[open_].tolist(), follows.tolist()))
            state.setTimeoutTimestamp(max(int(times[open_].min()) + within, now + 1000) // 1000 + 1)
        elif len(follows):
            state.update(([], [], follows.tolist()))
            state.setTimeoutTimestamp((int(follows[-1]) + within) // 1000 + 2)
        elif state.exists:
            state.remove()
        if late.any():
            yield pd.DataFrame({"name": key[0], "event_id": ids[late], "us": times[late]})

    return run


def unanswered(events: DataFrame, name: str, starts: Column, follows: Column, within_seconds: int, delay: str = "10 minutes", salts: int = 8) -> DataFrame:
    """Events that meet ``starts`` and are not followed, within the time, by one of the same
    name that meets ``follows``: name, event_id, ts. A start is judged when the watermark has
    passed its deadline. A busy name's starts are dealt over ``salts`` states; its follow-ups,
    of which a state keeps the last while only, go to all of them."""
    kinds = events.where(starts | follows).withColumn("starts", starts)
    mine = F.array(F.pmod(F.xxhash64("event_id"), F.lit(salts)).cast("int"))
    every = F.array(*(F.lit(i) for i in range(salts)))
    dealt = kinds.withWatermark("ts", delay).select(
        F.col(name).alias("name"), "event_id", epoch_micros("ts").alias("us"), "starts", "ts", F.explode(F.when(F.col("starts"), mine).otherwise(every)).alias("salt"))
    found = dealt.groupBy("name", "salt").applyInPandasWithState(
        _follow(within_seconds * 1_000_000), "name string, event_id long, us long", "ids array<long>, times array<long>, follows array<long>",
        "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.col("name").alias(name), "event_id", F.timestamp_micros("us").alias("ts"))
