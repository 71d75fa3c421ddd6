"""Rules and deadlines of the thirteen jobs. Fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pingline.functions.columns import seconds_of

# job, phase, sensor, check, field, value
RULES = [
    ("banking-streaming", "trigger", "cob_status", "equals", "complete", "true"),
    ("banking-streaming", "validation", "cob_status", "equals", "complete", "true"),
    ("banking-streaming", "validation", "consumer_lag", "lte", "lag_seconds", "300"),
    ("bronze-cdr", "trigger", "hourly-status", "equals", "complete", "true"),
    ("bronze-cdr", "validation", "hourly-status", "equals", "complete", "true"),
    ("bronze-cdr", "validation", "hourly-status", "gte", "pct_of_expected", "0.7"),
    ("bronze-cdr", "postRun", "audit-result", "equals", "match", "true"),
    ("bronze-seq", "trigger", "hourly-status", "equals", "complete", "true"),
    ("bronze-seq", "validation", "hourly-status", "equals", "complete", "true"),
    ("bronze-seq", "validation", "hourly-status", "gte", "pct_of_expected", "0.7"),
    ("bronze-seq", "postRun", "audit-result", "equals", "match", "true"),
    ("dryrun-weather", "trigger", "weather-ready", "equals", "complete", "true"),
    ("dryrun-weather", "validation", "weather-ready", "equals", "complete", "true"),
    ("dryrun-weather", "validation", "weather-ready", "gte", "total_readings", "12"),
    ("dryrun-weather", "postRun", "weather-audit", "gte", "total_readings", "1"),
    ("iot-factory", "trigger", "factory_health", "equals", "all_healthy", "true"),
    ("iot-factory", "validation", "factory_health", "equals", "all_healthy", "true"),
    ("iot-factory", "validation", "factory_health", "gte", "healthy_count", "10"),
    ("iot-factory", "validation", "factory_health", "age_lt", "updated_at", "5m"),
    ("ml-data-prep", "validation", "raw_features", "age_lt", "updated_at", "2h"),
    ("ml-data-prep", "postRun", "data_prep_status", "equals", "complete", "true"),
    ("ml-data-prep", "postRun", "data_prep_status", "gte", "row_count", "1"),
    ("ml-deployment", "trigger", "eval_status", "equals", "passed", "true"),
    ("ml-deployment", "validation", "eval_status", "equals", "passed", "true"),
    ("ml-deployment", "validation", "eval_status", "gte", "accuracy", "0.95"),
    ("ml-deployment", "validation", "eval_status", "age_lt", "updated_at", "2h"),
    ("ml-deployment", "postRun", "deployment_status", "equals", "deployed", "true"),
    ("ml-evaluation", "trigger", "training_status", "equals", "complete", "true"),
    ("ml-evaluation", "validation", "training_status", "equals", "complete", "true"),
    ("ml-evaluation", "validation", "training_status", "age_lt", "updated_at", "2h"),
    ("ml-evaluation", "postRun", "eval_status", "equals", "passed", "true"),
    ("ml-training", "trigger", "data_prep_status", "equals", "complete", "true"),
    ("ml-training", "validation", "data_prep_status", "equals", "complete", "true"),
    ("ml-training", "validation", "data_prep_status", "age_lt", "updated_at", "2h"),
    ("ml-training", "postRun", "training_status", "equals", "complete", "true"),
    ("silver-cdr-day", "trigger", "daily-status", "equals", "all_hours_complete", "true"),
    ("silver-cdr-day", "validation", "daily-status", "equals", "all_hours_complete", "true"),
    ("silver-cdr-day", "postRun", "daily-status", "equals", "all_hours_complete", "true"),
    ("silver-cdr-hour", "trigger", "audit-result", "equals", "match", "true"),
    ("silver-cdr-hour", "validation", "audit-result", "equals", "match", "true"),
    ("silver-cdr-hour", "postRun", "hourly-status", "gte", "count", "1"),
    ("silver-seq-day", "trigger", "daily-status", "equals", "all_hours_complete", "true"),
    ("silver-seq-day", "validation", "daily-status", "equals", "all_hours_complete", "true"),
    ("silver-seq-day", "postRun", "daily-status", "equals", "all_hours_complete", "true"),
    ("silver-seq-hour", "trigger", "audit-result", "equals", "match", "true"),
    ("silver-seq-hour", "validation", "audit-result", "equals", "match", "true"),
    ("silver-seq-hour", "postRun", "hourly-status", "gte", "count", "1"),
]

# job, deadline, expected duration, maximum duration
DEADLINES = [
    ("banking-streaming", "17:00", "10m", "30m"),
    ("bronze-cdr", ":15", "3m", "10m"),
    ("bronze-seq", ":15", "3m", "10m"),
    ("dryrun-weather", ":45", "5m", "15m"),
    ("iot-factory", ":15", "3m", "10m"),
    ("ml-data-prep", ":10", "2m", "8m"),
    ("ml-deployment", ":50", "1m", "5m"),
    ("ml-evaluation", ":40", "2m", "10m"),
    ("ml-training", ":30", "5m", "15m"),
    ("silver-cdr-day", "02:00", "30m", "55m"),
    ("silver-cdr-hour", ":30", "10m", "25m"),
    ("silver-seq-day", "02:00", "30m", "55m"),
    ("silver-seq-hour", ":30", "10m", "25m"),
]

ML_CHAIN = ["ml-data-prep", "ml-training", "ml-evaluation", "ml-deployment"]


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [
        (i, *r[:5], str(seconds_of(r[5])) if r[3] == "age_lt" else r[5]) for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(
        rows, "rule_no int, job string, phase string, sensor string, check string, field string, value string"
    )


def _offset_minutes(deadline: str) -> tuple[bool, int]:
    hours, minutes = deadline.split(":")
    return hours == "", int(hours or 0) * 60 + int(minutes)


def deadlines_table(spark: SparkSession, deadlines=DEADLINES) -> DataFrame:
    """Deadlines as minutes into the hour (``:MM``) or into the day (``HH:MM``)."""
    rows = []
    for job, deadline, expected, longest in deadlines:
        within_hour, minutes = _offset_minutes(deadline)
        rows.append((job, within_hour, minutes, seconds_of(expected), seconds_of(longest)))
    return spark.createDataFrame(
        rows, "job string, within_hour boolean, deadline_minutes int, expected_s int, max_s int"
    )
