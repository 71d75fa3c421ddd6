"""Expected volume, period counters, latches and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingline.functions.columns import period_start, traffic_weight, weight_total

# fixed values
MIN_FILES = 4
MIN_SHARE = 0.85
HOURS_PER_DAY = 24
DAILY_TARGETS = {"cdr": 100_000_000, "seq": 500_000_000}
DAILY_OF_HOURLY = {"silver-cdr-hour": "silver-cdr-day", "silver-seq-hour": "silver-seq-day"}

_WEIGHT_TOTAL = weight_total()


def expected_in_window(target: Column | str, window_no: Column | str) -> Column:
    """Expected records of quarter-hour ``window_no`` (0..95), rounded half to even."""
    target = F.col(target) if isinstance(target, str) else target
    window_no = F.col(window_no) if isinstance(window_no, str) else window_no
    share = traffic_weight(window_no * 0.25 + 0.125)
    return F.bround(target * share / _WEIGHT_TOTAL).cast("bigint")


def expected_in_hour(target: Column | str, hour: Column | str) -> Column:
    target = F.col(target) if isinstance(target, str) else target
    hour = F.col(hour).cast("int") if isinstance(hour, str) else hour
    share = sum((traffic_weight(hour + (m + 7.5) / 60.0) for m in (0, 15, 30, 45)), F.lit(0.0))
    return F.bround(target * share / _WEIGHT_TOTAL).cast("bigint")


def window_volume(pings: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """Actual against expected records of all 96 quarter-hours of every day in ``targets``.

    ``pings`` has ``ts`` and ``by``; ``targets`` has ``by`` and ``daily_target``.
    """
    actual = pings.groupBy(*by, (F.hour("ts") * 4 + F.floor(F.minute("ts") / 15)).cast("int").alias("window_no")).agg(
        F.count(F.lit(1)).alias("actual")
    )
    grid = targets.select(*by, "daily_target", F.explode(F.sequence(F.lit(0), F.lit(95))).alias("window_no"))
    return grid.join(actual, [*by, "window_no"], "left").select(
        *by, "window_no",
        F.coalesce("actual", F.lit(0)).alias("actual"),
        expected_in_window("daily_target", "window_no").alias("expected"),
    )


def hourly_counters(files: DataFrame) -> DataFrame:
    """Records and processed files per stream and hour; a file without records is not counted."""
    return (
        files.filter(F.col("records") > 0)
        .groupBy("stream", "par_day", "par_hour")
        .agg(
            F.sum("records").alias("count"),
            F.count(F.lit(1)).alias("files_processed"),
            F.max("arrived_at").alias("updated_at"),
        )
    )


def _share(count: str, expected: str) -> Column:
    return F.when(F.col(expected) > 0, F.col(count) / F.col(expected)).otherwise(0.0)


def with_stream_targets(table: DataFrame, targets: dict[str, int] = DAILY_TARGETS) -> DataFrame:
    """Add ``daily_target`` from the fixed target of each stream."""
    by_stream = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    return table.withColumn("daily_target", F.try_element_at(by_stream, F.col("stream")))


def hourly_completeness(counters: DataFrame) -> DataFrame:
    """Counters with a ``daily_target`` against the volume expected of their hour."""
    return (
        counters.withColumn("expected_count", expected_in_hour("daily_target", "par_hour"))
        .withColumn("pct_of_expected", _share("count", "expected_count"))
        .withColumn("complete", (F.col("files_processed") >= MIN_FILES) & (F.col("pct_of_expected") >= MIN_SHARE))
        .drop("daily_target")
    )


def completeness_latch(files: DataFrame) -> DataFrame:
    """The file on whose arrival an hour first became complete. Works on one row per
    file, with a ``daily_target``."""
    hour = ["stream", "par_day", "par_hour"]
    arrivals = Window.partitionBy(*hour).orderBy("arrived_at", "file_no").rowsBetween(Window.unboundedPreceding, 0)
    running = (
        files.filter(F.col("records") > 0)
        .withColumn("expected_count", expected_in_hour("daily_target", "par_hour"))
        .withColumn("files_then", F.count(F.lit(1)).over(arrivals))
        .withColumn("records_then", F.sum("records").over(arrivals))
    )
    met = (F.col("files_then") >= MIN_FILES) & (_share("records_then", "expected_count") >= MIN_SHARE)
    return running.filter(met).groupBy(*hour).agg(
        F.min("arrived_at").alias("completed_at"),
        F.min("files_then").alias("files_then"),
        F.min("records_then").alias("records_then"),
    )


def reconcile(sensors: DataFrame, stored: DataFrame, strict: bool = False) -> DataFrame:
    """Counted against stored records per stream and hour.

    Stored at or above counted passes, so a double delivery passes too unless
    ``strict``. Without a count there is nothing to compare with.
    """
    counted, kept = F.coalesce("sensor_count", F.lit(0)), F.coalesce("stored_count", F.lit(0))
    agrees = (kept == counted) if strict else (kept >= counted)
    return (
        sensors.join(stored, ["stream", "par_day", "par_hour"], "full")
        .select("stream", "par_day", "par_hour", counted.alias("sensor_count"), kept.alias("stored_count"), agrees.alias("agrees"))
        .select(
            "stream", "par_day", "par_hour", "sensor_count", "stored_count",
            (F.col("agrees") & (F.col("sensor_count") > 0)).alias("match"),
            F.when(F.col("sensor_count") == 0, "no_sensor_data")
            .when(F.col("agrees"), "ok")
            .otherwise("count_mismatch")
            .alias("reason"),
        )
    )


def stored_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("stream", "par_day", "par_hour").agg(F.count(F.lit(1)).alias("stored_count"))


def daily_completeness(completions: DataFrame) -> DataFrame:
    """Distinct completed hours per daily job; ``completions`` has pipelineId and a
    composite ``date`` such as ``2026-03-04T23``. Rows without an hour, or of a job
    without a daily successor, are left out."""
    mapping = F.create_map(*[F.lit(x) for pair in DAILY_OF_HOURLY.items() for x in pair])
    parts = completions.select(
        F.try_element_at(mapping, F.col("pipelineId")).alias("pipelineId"),
        F.regexp_extract("date", r"^(.*)T([^T]*)$", 1).alias("par_day"),
        F.regexp_extract("date", r"^(.*)T([^T]*)$", 2).alias("par_hour"),
    ).filter(F.col("pipelineId").isNotNull() & (F.col("par_day") != ""))
    # distinct first: a busy day reaches the set as 24 rows, not as its events
    hours = parts.distinct()
    return hours.groupBy("pipelineId", "par_day").agg(
        F.array_sort(F.collect_set("par_hour")).alias("completed_hours"),
        (F.count(F.lit(1)) >= HOURS_PER_DAY).alias("all_hours_complete"),
    )


def hour_start() -> Column:
    return period_start("par_day", "par_hour")
