"""Calendars, session expansion and window assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pingline.functions.columns import PING_SECONDS, epoch_micros, floor_micros, floor_window, time_of_micros

STREAMS = ["cdr", "seq"]


def calendar(span: DataFrame, seconds: int = 900, streams: list[str] | None = None) -> DataFrame:
    """All windows between ``first`` and ``last`` (one row of ``span``), per stream."""
    step = F.make_dt_interval(secs=F.lit(seconds))
    starts = F.sequence(floor_window("first", seconds), floor_window("last", seconds), step)
    out = span.select(F.explode(starts).alias("window_start"))
    if streams:
        out = out.select("window_start", F.explode(F.array(*[F.lit(s) for s in streams])).alias("stream"))
    return out


def calendar_between(spark: SparkSession, first: str, last: str, seconds: int = 900, streams=None) -> DataFrame:
    span = spark.range(1).select(
        F.lit(first).cast("timestamp_ntz").alias("first"), F.lit(last).cast("timestamp_ntz").alias("last")
    )
    return calendar(span, seconds, streams)


def span_of(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def ping_count(duration: Column | str) -> Column:
    duration = F.col(duration) if isinstance(duration, str) else duration
    return F.greatest(F.lit(1), F.floor(duration / PING_SECONDS).cast("int"))


def explode_pings(sessions: DataFrame) -> DataFrame:
    """A ping every ten seconds of each session, at least one.

    Times are epoch micros (``start_us``, ``time_us``): the zone-free timestamps are
    converted once per session and once per result, not once per ping.
    """
    numbered = sessions.withColumn("start_us", epoch_micros("start_ts")).withColumn(
        "ping_no", F.explode(F.sequence(F.lit(0), ping_count("duration_s") - 1))
    )
    step = int(PING_SECONDS * 1_000_000)
    return numbered.withColumn("time_us", F.col("start_us") + F.col("ping_no").cast("bigint") * step)


def clip(pings: DataFrame, low: Column, high: Column) -> DataFrame:
    """Half open: a ping at the end belongs to what follows."""
    return pings.filter((F.col("time_us") >= epoch_micros(low)) & (F.col("time_us") < epoch_micros(high)))


def assign_windows(pings: DataFrame, seconds: int = 900) -> DataFrame:
    """Each ping in exactly one window, marked when its session began in an earlier one."""
    return pings.withColumn("window_us", floor_micros("time_us", seconds)).withColumn(
        "spilled", F.col("start_us") < F.col("window_us")
    )


def window_totals(assigned: DataFrame) -> DataFrame:
    """Own and spilled-over pings of every window."""
    counts = assigned.groupBy("window_us").agg(
        F.count(F.lit(1)).alias("pings"), F.count_if("spilled").alias("spilled_pings")
    )
    return counts.select(time_of_micros("window_us").alias("window_start"), "pings", "spilled_pings")
