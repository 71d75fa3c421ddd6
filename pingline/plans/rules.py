"""Rule checks, deadlines, dry runs and chains over control tables.

A sensor table is long: job, sensor, period, field, value (text), updated_at.
The built-in rule and deadline tables are fixed lists of a few dozen rows, hence the
broadcasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingline.functions.columns import epoch_micros, seconds_of
from pingline.operators.monitoring import ready, weather_running
from pingline.plans.definitions import DEADLINES, ML_CHAIN, deadlines_table, rules_table


def _holds(as_of: Column) -> Column:
    """One rule against the value of its sensor field; anything unreadable fails."""
    have, want = F.col("s_value"), F.col("value")
    number, limit = have.try_cast("double"), want.try_cast("double")
    comparable = number.isNotNull() & ~F.isnan(number)
    age = (epoch_micros(as_of) - epoch_micros(have.try_cast("timestamp_ntz"))) / 1_000_000
    check = F.col("check")
    passed = (
        F.when(check == "equals", F.lower(have) == want)
        .when(check == "gte", comparable & (number >= limit))
        .when(check == "lte", comparable & (number <= limit))
        .when(check == "age_lt", age < limit)
    )
    return F.coalesce(passed, F.lit(False))


def evaluate(sensors: DataFrame, phase: str, as_of: Column, rules: DataFrame | None = None) -> DataFrame:
    """All rules of a phase per job and period (``trigger: ALL``). A sensor that was
    never written fails its rules."""
    # the fixed list is a few dozen rows; a caller's own table is joined by its measured size
    small = F.broadcast if rules is None else (lambda df: df)
    wanted = (rules_table(sensors.sparkSession) if rules is None else rules).filter(F.col("phase") == phase)
    totals = wanted.groupBy("job").agg(F.count(F.lit(1)).alias("total_rules"))
    values = sensors.select("job", "period", "sensor", "field", F.col("value").alias("s_value"))
    matched = values.join(small(wanted), ["job", "sensor", "field"], "left")
    return (
        matched.withColumn("held", F.when(_holds(as_of), F.col("rule_no")))
        .groupBy("job", "period")
        .agg(F.count_distinct("held").alias("passed_rules"))
        .join(small(totals), "job")
        .withColumn("passed", F.col("passed_rules") == F.col("total_rules"))
    )


def sla_outcome(runs: DataFrame, day_shift: int = 0, deadlines: DataFrame | None = None) -> DataFrame:
    """MET, WARNING or BREACH of every run; ``runs`` has job, period_start, started_at, finished_at.

    ``:MM`` counts from the period's hour, ``HH:MM`` from its day plus ``day_shift`` days.
    """
    limits = F.broadcast(deadlines_table(runs.sparkSession)) if deadlines is None else deadlines
    base = F.when(F.col("within_hour"), F.date_trunc("hour", "period_start")).otherwise(
        F.date_trunc("day", "period_start") + F.make_dt_interval(F.lit(day_shift))
    )
    out = runs.join(limits, "job").withColumn(
        "deadline_at", (base + F.make_dt_interval(mins=F.col("deadline_minutes"))).cast("timestamp_ntz")
    )
    took = F.floor((epoch_micros("finished_at") - epoch_micros("started_at")) / 1_000_000).cast("bigint")
    out = out.withColumn("duration_s", took)
    breach = (F.col("finished_at") > F.col("deadline_at")) | (F.col("duration_s") > F.col("max_s"))
    outcome = F.when(breach, "BREACH").when(F.col("duration_s") > F.col("expected_s"), "WARNING").otherwise("MET")
    return out.withColumn("outcome", outcome).drop("within_hour", "deadline_minutes", "expected_s", "max_s")


def _deadline(job: str) -> tuple[int, int, int]:
    _, text, expected, longest = next(d for d in DEADLINES if d[0] == job)
    return int(text.lstrip(":")), seconds_of(expected), seconds_of(longest)


def dry_run_events(batches: DataFrame, job: str = "dryrun-weather") -> DataFrame:
    """What would have happened per period, from its readings in batches:
    the trigger, the projected deadline outcome, batches after the trigger, and
    a final count other than the one the trigger saw."""
    minute, expected_s, _ = _deadline(job)
    whole = Window.partitionBy("period")  # a period has six batches
    met = ready("total_then", "valid_then")
    seen = (
        weather_running(batches)
        .withColumn("fired_batch", F.min(F.when(met, F.col("batch_no"))).over(whole))
        .withColumn("final", F.max("total_then").over(whole))
        .withColumn("seen_at", F.max("arrived_at").over(whole))
        .filter(F.col("batch_no") >= F.col("fired_batch"))
    )
    fired = F.col("batch_no") == F.col("fired_batch")
    start = F.to_timestamp_ntz("period", F.lit("yyyyMMdd'T'HH"))
    projected = F.col("arrived_at") + F.make_dt_interval(secs=F.lit(expected_s))
    outcome = F.when(projected <= start + F.make_dt_interval(mins=F.lit(minute)), "MET").otherwise("BREACH")
    drift = F.col("final") - F.col("total_then")

    def event(kind: str, when: Column, at: Column, detail: Column) -> Column:
        body = F.struct(F.lit(kind).alias("event_type"), at.alias("at"), detail.cast("string").alias("detail"))
        return F.when(when, body)

    events = F.array(
        event("DRY_RUN_WOULD_TRIGGER", fired, F.col("arrived_at"), F.col("total_then")),
        event("DRY_RUN_SLA_PROJECTION", fired, projected, outcome),
        event("DRY_RUN_LATE_DATA", ~fired, F.col("arrived_at"), F.col("total")),
        event("DRY_RUN_DRIFT", fired & (drift != 0), F.col("seen_at"), drift),
    )
    return seen.select("period", F.explode(F.array_compact(events)).alias("e")).select("period", "e.*")


def cascade(ready_times: DataFrame, chain: list[str] = ML_CHAIN) -> DataFrame:
    """When each link of a chain could finish, given when its own input was ready.

    ``ready_times`` has ``period_start`` and one ready column per link. A link starts
    when its input is there and the link before has finished, so a late first link
    pushes every later one. Long form: one row per period and link.
    """
    out, finish = ready_times, None
    links = []
    for job in chain:
        minute, expected_s, _ = _deadline(job)
        own = F.col(f"`{job}`")
        start = own if finish is None else F.when(own.isNotNull() & finish.isNotNull(), F.greatest(own, finish))
        name = f"__finish_{job}"
        out = out.withColumn(name, start + F.make_dt_interval(secs=F.lit(expected_s)))
        finish = F.col(f"`{name}`")
        deadline = F.col("period_start") + F.make_dt_interval(mins=F.lit(minute))
        missed = F.coalesce(finish > deadline, F.lit(True))
        held_up = F.coalesce(start > own, start.isNull() & own.isNotNull(), F.lit(False)) if links else F.lit(False)
        links.append(
            F.struct(
                F.lit(job).alias("job"), finish.alias("finish_at"), deadline.alias("deadline_at"),
                missed.alias("missed"), held_up.alias("held_up_by_upstream"),
            )
        )
    return out.select("period_start", F.explode(F.array(*links)).alias("l")).select("period_start", "l.*")


def chain_status(completeness: DataFrame, audit: DataFrame) -> DataFrame:
    """Bronze complete, audit agreed, hourly job ready and daily job ready, per stream and hour."""
    hour = ["stream", "par_day", "par_hour"]
    hours = (
        completeness.select(*hour, F.col("complete").alias("bronze_complete"))
        .join(audit.select(*hour, "match"), hour, "left")
        .withColumn("audit_match", F.coalesce("match", F.lit(False)))
        .withColumn("hour_ready", F.col("bronze_complete") & F.col("audit_match"))
        .drop("match")
    )
    day = Window.partitionBy("stream", "par_day")  # at most 24 rows
    return hours.withColumn("day_ready", F.count_if("hour_ready").over(day) >= 24)
