"""Questions to the event log. Filters are plain predicates, so they reach the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingline.functions.columns import (
    FAILURE_TYPES, SLA_TYPES, WARNING_TYPES, hour_of_millis, severity_of_rank, severity_rank, time_of_millis,
)
from pingline.operators.ordered import newest_rows

# fixed values
TIMELINE_SOURCES = [
    "bronze-cdr", "bronze-seq", "silver-cdr-hour", "silver-seq-hour", "silver-cdr-day", "silver-seq-day",
]
ONE_DAY_MS = 86_400_000
FEED_SIZE = 50
DETAIL_SIZE = 10


def normalize(log: DataFrame) -> DataFrame:
    """Defaults for absent fields, a readable time, preferred column order first."""
    preferred = ["pipelineId", "eventType", "date", "scheduleId", "message"]
    internal = {"PK", "SK", "ttl", "timestamp", *preferred}
    return log.select(
        time_of_millis(F.coalesce("timestamp", F.lit(0))).alias("time"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in preferred],
        *[c for c in log.columns if c not in internal],
    )


def between(
    log: DataFrame, start_ms: Column | int, end_ms: Column | int, source: str | None = None, event_type: str | None = None
) -> DataFrame:
    """Events in a time range. Asked for one source the end is exclusive, because
    its key sorts after the bare timestamp; otherwise both ends are inclusive."""
    return log.filter(wanted(start_ms, end_ms, source, event_type))


def wanted(start_ms: Column | int, end_ms: Column | int, source: str | None = None, event_type: str | None = None) -> Column:
    ts = F.col("timestamp")
    test = (ts >= start_ms) & (ts <= end_ms)
    if source is not None:
        test = (F.col("pipelineId") == source) & (ts >= start_ms) & (ts < end_ms)
    return test if event_type is None else test & (F.col("eventType") == event_type)


def range_of(date: str, hour: str | None = None) -> tuple[int, int]:
    """Bounds of a ``yyyy-MM-dd`` day, or of one of its hours, in epoch millis."""
    start = dt.datetime.strptime(date, "%Y-%m-%d").replace(tzinfo=dt.timezone.utc)
    width = dt.timedelta(days=1)
    if hour is not None:
        start, width = start + dt.timedelta(hours=int(hour)), dt.timedelta(hours=1)
    low = int(start.timestamp() * 1000)
    return low, low + int(width.total_seconds() * 1000)


def overview(log: DataFrame, since_ms: Column) -> DataFrame:
    """Per source since a cut-off: number of events and the last one."""
    recent = log.filter(F.col("timestamp") >= since_ms).withColumn("pipelineId", F.coalesce("pipelineId", F.lit("unknown")))
    counts = recent.groupBy("pipelineId").agg(F.count(F.lit(1)).alias("events"))
    last = newest_rows(recent, ["pipelineId"], "timestamp", "event_id").select(
        "pipelineId", F.col("eventType").alias("last_type"), F.col("timestamp").alias("last_timestamp"),
        F.coalesce("message", F.lit("")).alias("last_message"),
    )
    return counts.join(last, "pipelineId")


def type_breakdown(log: DataFrame, since_ms: Column) -> DataFrame:
    return (
        log.filter(F.col("timestamp") >= since_ms)
        .groupBy(
            F.coalesce("pipelineId", F.lit("unknown")).alias("pipelineId"),
            F.coalesce("eventType", F.lit("UNKNOWN")).alias("eventType"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def hourly_histogram(log: DataFrame, since_ms: Column) -> DataFrame:
    """24 slots per source, zeros kept; events without a valid time fall out."""
    hour = F.when(F.col("timestamp") > 0, hour_of_millis("timestamp"))
    slots = F.array(*[F.count_if(hour == h) for h in range(24)])
    return (
        log.filter(F.col("timestamp") >= since_ms)
        .groupBy(F.coalesce("pipelineId", F.lit("unknown")).alias("pipelineId"))
        .agg(slots.alias("slots"))
        .select("pipelineId", F.posexplode("slots").alias("hour", "n"))
    )


def timeline(log: DataFrame) -> DataFrame:
    """Events of the known sources with their hour; a bad time counts as hour 0."""
    hour = F.when(F.col("timestamp") > 0, hour_of_millis("timestamp")).otherwise(0)
    return log.filter(F.col("pipelineId").isin(TIMELINE_SOURCES)).withColumn("hour", hour)


def type_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("eventType").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "eventType")


def pivot_types(log: DataFrame, by: str, types: list[str] | None = None) -> DataFrame:
    """Count per event type as columns, for every type in the log. Types a caller names come
    as they are, all others together as OTHER, so a row always adds up to its events."""
    cells = log.groupBy(by, F.coalesce("eventType", F.lit("UNKNOWN")).alias("eventType")).agg(F.count(F.lit(1)).alias("n"))
    found = types
    if found is None:  # a log has a handful of types, and every type becomes a column
        found = sorted(r[0] for r in cells.select("eventType").distinct().collect())
    of = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    columns = [of(F.col("eventType") == t).alias(t) for t in found]
    if types is not None:
        columns.append(of(~F.col("eventType").isin(types)).alias("OTHER"))
    return cells.groupBy(by).agg(*columns)


def metrics(log: DataFrame, start_ms: Column, end_ms: Column) -> DataFrame:
    """Total, by type, by source, by hour and the three SLA types (zeros kept), in long form."""
    ts = F.col("timestamp")
    cells = (
        log.filter((ts >= start_ms) & (ts <= end_ms))
        .groupBy("eventType", "pipelineId", F.date_format(time_of_millis("timestamp"), "yyyy-MM-dd'T'HH").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # the few cells are repeated per measure, so the log is read once
    entry = lambda name, item: F.struct(F.lit(name).alias("measure"), item.alias("item"))
    kind = F.col("eventType")
    entries = F.array(
        entry("total", F.lit("")), entry("type", kind), entry("source", F.col("pipelineId")), entry("hour", F.col("hour")),
        F.when(kind.isin(SLA_TYPES), entry("sla", kind)),
    )
    counted = cells.select(F.explode(F.array_compact(entries)).alias("e"), "n").select("e.measure", "e.item", "n")
    always = [("total", "", 0), *[("sla", t, 0) for t in SLA_TYPES]]
    zeros = log.sparkSession.createDataFrame(always, "measure string, item string, n bigint")
    return counted.unionByName(zeros).groupBy("measure", "item").agg(F.sum("n").alias("n"))


def worst_severity(log: DataFrame, by: list[str]) -> DataFrame:
    return (
        log.groupBy(*by)
        .agg(F.min(severity_rank("eventType")).alias("rank"), F.count(F.lit(1)).alias("events"))
        .select(*by, "events", severity_of_rank("rank").alias("severity"))
    )


def sla_status(log: DataFrame) -> DataFrame:
    seen = [F.bool_or(F.col("eventType") == t).alias(t) for t in ("SLA_BREACH", "SLA_WARNING")]
    status = F.when(F.col("SLA_BREACH"), "Breach").when(F.col("SLA_WARNING"), "Warning").otherwise("OK")
    return log.groupBy("pipelineId").agg(*seen).select("pipelineId", status.alias("sla_status"))


def feed_filter(name: str) -> Column:
    e = F.col("eventType")
    return {
        "all": F.lit(True),
        "failures": e.isin(FAILURE_TYPES),
        "sla": e.startswith("SLA_") | e.isin(WARNING_TYPES),
    }[name]


def newest(log: DataFrame, n: int = FEED_SIZE) -> DataFrame:
    return log.orderBy(F.desc("timestamp"), F.desc("event_id")).limit(n)


def feeds(log: DataFrame, names: list[str], n: int = FEED_SIZE) -> DataFrame:
    """The newest ``n`` events of several feeds in one reading; ``feed`` names the feed."""
    tags = F.array_compact(F.array(*[F.when(feed_filter(name), F.lit(name)) for name in names]))
    rank = F.row_number().over(Window.partitionBy("feed").orderBy(F.desc("timestamp"), F.desc("event_id")))
    # Spark keeps n rows per feed and task before the shuffle
    return log.withColumn("feed", F.explode(tags)).withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def oldest(log: DataFrame, n: int = DETAIL_SIZE) -> DataFrame:
    return log.orderBy("timestamp", "event_id").limit(n)


# ---- sensors ------------------------------------------------------------


def sensors_of(sensors: DataFrame, source: str) -> DataFrame:
    """The flattened sensors of one pipeline, by period."""
    return flatten_sensors(sensors.filter(F.col("pipeline_id") == source)).orderBy("period", "sensor", "field")


def flatten_sensors(sensors: DataFrame, prefix: str = "SENSOR#") -> DataFrame:
    """Sensor maps as long rows. ``sensors`` has pipeline_id, sk, ``data`` (flat fields)
    and ``nested`` (maps inside). A missing period is made from date and hour, which
    are then dropped."""
    own = F.coalesce(
        F.try_element_at("data", F.lit("period")),
        F.concat(F.try_element_at("data", F.lit("date")), F.lit("T"), F.try_element_at("data", F.lit("hour"))),
    )
    flat = F.map_entries(F.map_filter("data", lambda k, v: ~k.isin("period", "date", "hour")))
    inner = F.flatten(
        F.transform(
            F.map_entries("nested"),
            lambda outer: F.transform(
                F.map_entries(outer["value"]),
                lambda e: F.struct(F.concat(outer["key"], F.lit("."), e["key"]).alias("key"), e["value"].alias("value")),
            ),
        )
    )
    return (
        sensors.filter(F.col("sk").startswith(prefix))
        .select("pipeline_id", "sk", own.alias("period"), F.explode(F.concat(flat, inner)).alias("e"))
        .select(
            "pipeline_id",
            F.split("sk", "#")[1].alias("sensor"),
            F.to_timestamp_ntz("period", F.lit("yyyyMMdd'T'HH")).alias("period"),
            F.col("e.key").alias("field"),
            F.col("e.value").alias("value"),
        )
    )


def sensor_message(name: Column, period: Column, fields: list[str]) -> Column:
    """``name [period]: a=1, b=2`` from the fields that are present."""
    parts = F.concat_ws(", ", *[F.when(F.col(f).isNotNull(), F.concat(F.lit(f + "="), F.col(f).cast("string"))) for f in fields])
    head = F.concat(name, F.lit(" ["), F.date_format(period, "yyyy-MM-dd'T'HH"), F.lit("]"))
    return F.when(parts != "", F.concat(head, F.lit(": "), parts)).otherwise(head)


def updated_at(own: str, nested: str) -> Column:
    """A snapshot's own update time, or the first that a map inside it has."""
    inner = F.filter(
        F.transform(F.map_values(nested), lambda m: F.try_element_at(m, F.lit("updatedAt"))), lambda t: t.isNotNull()
    )
    return F.coalesce(own, F.try_element_at(inner, F.lit(1)).try_cast("timestamp_ntz"))


def merged_timeline(log: DataFrame, snapshots: DataFrame, source: str | None = None, limit: int | None = None) -> DataFrame:
    """Events and sensor snapshots in one table with their origin. With a ``source`` the
    timeline of that pipeline; ``limit`` takes its newest events only. Rows come in no order:
    a caller sorts what it shows."""
    if source is not None:
        log = log.filter(F.col("pipelineId") == source)
        snapshots = snapshots.filter(F.col("pipeline_id") == source)
    if limit is not None:
        log = newest(log, limit)
    events = log.select(
        time_of_millis("timestamp").alias("at"), F.lit("event").alias("origin"), "eventType", "message"
    )
    fields = ["total_readings", "valid_readings", "batches_received", "complete"]
    at = updated_at("updated_at", "nested") if "nested" in snapshots.columns else F.col("updated_at")
    sensors = snapshots.withColumn("__at", at).filter(F.col("__at").isNotNull()).select(
        F.col("__at").alias("at"),
        F.lit("sensor").alias("origin"),
        F.col("sensor").alias("eventType"),
        sensor_message(F.col("sensor"), F.col("period"), fields).alias("message"),
    )
    return events.unionByName(sensors)
