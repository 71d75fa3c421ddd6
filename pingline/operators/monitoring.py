"""Machine health, transaction lag and weather readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingline.functions.columns import COB_HOUR, VALID_QUALITY, epoch_micros, machine_health

# fixed values
MACHINES = [f"machine_{i:02d}" for i in range(1, 11)]
MEASURES = ["temperature", "vibration", "pressure"]
STATUSES = ["healthy", "degraded", "critical", "unknown"]
MIN_READINGS = 12
MIN_VALID_SHARE = 0.75


def machine_status(readings: DataFrame, by: list[str], digits: int = 2) -> DataFrame:
    """Mean measures and health per machine; the class uses the unrounded means."""
    means = readings.groupBy("machine_id", *by).agg(
        *[F.avg(m).alias(m) for m in MEASURES],
        F.count(F.lit(1)).alias("readings_count"),
        F.max("updated_at").alias("updated_at"),
    )
    return means.select(
        "machine_id", *by,
        machine_health(*MEASURES).alias("status"),
        *[F.round(m, digits).alias(m) for m in MEASURES],
        "readings_count", "updated_at",
    )


def latest_status(statuses: DataFrame, by: list[str]) -> DataFrame:
    """The status written last per machine. Statuses travel as their place in a fixed list:
    numbers keep the aggregate a hash aggregate."""
    names = F.array(*[F.lit(s) for s in STATUSES])
    last = statuses.groupBy("machine_id", *by).agg(
        F.max_by(F.array_position(names, F.col("status")), epoch_micros("updated_at")).alias("place"), F.max("updated_at").alias("updated_at")
    )
    return last.select("machine_id", *by, F.when(F.col("place") > 0, F.element_at(names, F.greatest("place", F.lit(1)).cast("int"))).alias("status"), "updated_at")


def factory_health(latest: DataFrame, by: list[str], roster: list[str] = MACHINES) -> DataFrame:
    """Healthy machines of the fixed roster, from one row per machine. An absent one is
    not healthy, a stray one not counted; no join with the roster is needed for either."""
    listed = F.col("machine_id").isin(roster)
    return (
        latest.groupBy(*by)
        .agg(
            F.count_if(listed & (F.col("status") == "healthy")).alias("healthy_count"),
            F.max(F.when(listed, F.col("updated_at"))).alias("updated_at"),
        )
        .withColumn("total", F.lit(len(roster)))
        .withColumn("all_healthy", F.col("healthy_count") == F.col("total"))
    )


def factory_hours(readings: DataFrame, hours: DataFrame, by: list[str], digits: int = 2) -> DataFrame:
    """Factory summary per period in ``hours``. A missing measure counts as 0.0; a period
    without readings has zeros and no extremes."""
    filled = readings.select(*by, "machine_id", *[F.coalesce(m, F.lit(0.0)).alias(m) for m in MEASURES])
    # one row per machine and period first, so the distinct count needs no second expansion
    machines = filled.groupBy(*by, "machine_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(m).alias(f"s_{m}") for m in MEASURES],
        F.max("temperature").alias("hi_t"), F.max("vibration").alias("hi_v"), F.min("pressure").alias("lo_p"),
    )
    totals = machines.groupBy(*by).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("m"),
        *[F.sum(f"s_{x}").alias(f"s_{x}") for x in MEASURES],
        F.max("hi_t").alias("hi_t"), F.max("hi_v").alias("hi_v"), F.min("lo_p").alias("lo_p"),
    )
    return hours.join(totals, by, "left").select(
        *by,
        F.coalesce("n", F.lit(0)).alias("total_readings"),
        F.coalesce("m", F.lit(0)).alias("machine_count"),
        *[F.round(F.coalesce(F.col(f"s_{x}") / F.col("n"), F.lit(0.0)), digits).alias(f"avg_{x}") for x in MEASURES],
        F.round("hi_t", digits).alias("max_temperature"),
        F.round("hi_v", digits).alias("max_vibration"),
        F.round("lo_p", digits).alias("min_pressure"),
    )


# ---- transactions -------------------------------------------------------


def cob_complete(ts: Column | str) -> Column:
    """Close of business has passed: strictly after the hour."""
    return F.hour(ts) > COB_HOUR


def batch_lag(transactions: DataFrame, by: list[str], now: Column | None = None) -> DataFrame:
    """Per micro-batch: count, oldest event and lag in whole seconds against ``now``
    (the batch's newest event when not given)."""
    batches = transactions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("transactions"), F.min("ts").alias("oldest"), F.max("ts").alias("newest")
    )
    at = now if now is not None else F.col("newest")
    lag = F.floor((epoch_micros(at) - epoch_micros("oldest")) / 1_000_000).cast("bigint")
    return batches.select(*by, "transactions", "oldest", at.alias("processed_at"), lag.alias("lag_seconds"), cob_complete(at).alias("cob_complete"))


def daily_summary(batches: DataFrame) -> DataFrame:
    """Number of batches and their transactions per day; a missing count adds nothing."""
    return batches.groupBy("date").agg(
        F.count(F.lit(1)).alias("batch_count"),
        F.sum(F.coalesce("count", F.lit(0))).alias("total_transactions"),
    )


# ---- weather ------------------------------------------------------------


def weather_batches(readings: DataFrame) -> DataFrame:
    """One row per period and ten-minute batch."""
    return readings.groupBy("period", "batch_no").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("quality") >= VALID_QUALITY).alias("valid"),
        F.max("ts").alias("arrived_at"),
    )


def ready(total: Column | str, valid: Column | str) -> Column:
    total = F.col(total) if isinstance(total, str) else total
    valid = F.col(valid) if isinstance(valid, str) else valid
    return (total >= MIN_READINGS) & (valid / total >= MIN_VALID_SHARE)


def weather_running(batches: DataFrame) -> DataFrame:
    """Totals as the batches arrive, the number breaking ties; a period has six batches, so
    its window is small."""
    arrivals = Window.partitionBy("period").orderBy("arrived_at", "batch_no").rowsBetween(Window.unboundedPreceding, 0)
    return batches.withColumn("total_then", F.sum("total").over(arrivals)).withColumn(
        "valid_then", F.sum("valid").over(arrivals)
    )


def weather_ready(batches: DataFrame) -> DataFrame:
    """Totals per period, and whether it was ready at any of its batches: readiness is
    latched, a later poor batch does not unset it."""
    return weather_running(batches).groupBy("period").agg(
        F.sum("total").alias("total_readings"),
        F.sum("valid").alias("valid_readings"),
        F.count(F.lit(1)).alias("batches_received"),
        F.max("arrived_at").alias("updated_at"),
        F.bool_or(ready("total_then", "valid_then")).alias("complete"),
    )


def weather_latch(batches: DataFrame) -> DataFrame:
    """The batch on whose arrival a period was first ready; all columns are that batch's."""
    met = weather_running(batches).filter(ready("total_then", "valid_then"))
    place = F.row_number().over(Window.partitionBy("period").orderBy("arrived_at", "batch_no"))
    return met.withColumn("__place", place).filter("__place = 1").select(
        "period", "batch_no", F.col("arrived_at").alias("latched_at"), "total_then"
    )
