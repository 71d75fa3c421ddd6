"""Event-log queries. ``as_of`` is the log's newest event."""

from __future__ import annotations

from pyspark.sql import functions as F

from pingline.catalog.registry import query
from pingline.functions.columns import severity
from pingline.operators import eventlog, monitoring
from pingline.session import scratch_path
from pingline.sources import eventstore, tables

TYPES = ["JOB_COMPLETED", "JOB_FAILED", "JOB_TRIGGERED", "SLA_BREACH", "SLA_MET", "SLA_WARNING"]
_DAY_AGO = "(SELECT max(timestamp) - 86400000 FROM v_log)"
_WEEK_AGO = "(SELECT max(timestamp) - 604800000 FROM v_log)"
WEEK_MS = 7 * eventlog.ONE_DAY_MS


def log(spark, sf_dir):
    return tables.event_log(spark, sf_dir)


def newest_ms(events):
    return events.select(F.max("timestamp")).first()[0]


@query("""
    SELECT event_id, time, pipelineId, eventType, date, scheduleId,
           CASE WHEN event_id % 7 = 0 THEN '' ELSE message END AS message FROM v_log""")
def event_normalize(spark, sf_dir):
    """Some messages are absent."""
    gaps = F.when(F.col("event_id") % 7 != 0, F.col("message"))
    return eventlog.normalize(log(spark, sf_dir).withColumn("message", gaps))


@query("""
    SELECT event_id, eventType,
           CASE WHEN eventType IN ('SLA_BREACH', 'JOB_FAILED') THEN 'critical' WHEN eventType = 'SLA_WARNING' THEN 'warning'
                WHEN eventType IN ('SLA_MET', 'JOB_COMPLETED') THEN 'success' ELSE 'info' END AS severity FROM v_log""")
def event_severity(spark, sf_dir):
    return log(spark, sf_dir).select("event_id", "eventType", severity("eventType").alias("severity"))


@query("""
    , feeds AS (
        SELECT 'all' AS feed, v_log.* FROM v_log
        UNION ALL SELECT 'failures', v_log.* FROM v_log WHERE eventType IN ('SLA_BREACH', 'JOB_FAILED')
        UNION ALL SELECT 'sla', v_log.* FROM v_log WHERE starts_with(eventType, 'SLA_'))
    SELECT feed, event_id, pipelineId, eventType, timestamp FROM feeds
    QUALIFY row_number() OVER (PARTITION BY feed ORDER BY timestamp DESC, event_id DESC) <= 50""")
def event_feed_top50(spark, sf_dir):
    return eventlog.feeds(log(spark, sf_dir), ["all", "failures", "sla"]).select("feed", "event_id", "pipelineId", "eventType", "timestamp")


@query(f"""
    SELECT 'source' AS mode, event_id, timestamp FROM v_log
    WHERE pipelineId = 'bronze-cdr' AND timestamp >= {_DAY_AGO} AND timestamp < (SELECT max(timestamp) FROM v_log)
    UNION ALL
    SELECT 'type', event_id, timestamp FROM v_log WHERE eventType = 'SLA_BREACH' AND timestamp >= {_DAY_AGO}
    UNION ALL
    SELECT 'time', event_id, timestamp FROM v_log WHERE timestamp >= {_DAY_AGO}""")
def event_range(spark, sf_dir):
    """The last day, asked for one source (end exclusive), one type and neither (inclusive)."""
    events = log(spark, sf_dir)
    end = newest_ms(events)
    start = end - eventlog.ONE_DAY_MS
    # one reading serves all three: what any of them wants, then a tag for each that does
    wanted = {
        "source": eventlog.wanted(start, end, source="bronze-cdr"), "type": eventlog.wanted(start, end, event_type="SLA_BREACH"),
        "time": eventlog.wanted(start, end),
    }
    tags = F.array_compact(F.array(*[F.when(test, F.lit(mode)) for mode, test in wanted.items()]))
    return eventlog.between(events, start, end).select(F.explode(tags).alias("mode"), "event_id", "timestamp")


def event_store(spark, sf_dir):
    """The log in its store: a folder per day, sorted by source."""
    path = scratch_path(spark, "event-log")
    eventstore.write_log(log(spark, sf_dir), path)
    return path


def newest_date(events):
    return events.select(F.max("date")).first()[0]


_ROW = "event_id, pipelineId, eventType, timestamp, message"


@query(f"SELECT {_ROW} FROM v_log WHERE pipelineId = 'silver-cdr-day' AND timestamp >= {_DAY_AGO} AND timestamp < (SELECT max(timestamp) FROM v_log)")
def event_store_recent(spark, sf_dir):
    """The last 24 hours of one source, from the folders of two days."""
    end = newest_ms(log(spark, sf_dir))
    return eventstore.read_range(spark, event_store(spark, sf_dir), end - eventlog.ONE_DAY_MS, end, source="silver-cdr-day").select(*_ROW.split(", "))


@query(f"SELECT {_ROW} FROM v_log WHERE eventType = 'SLA_BREACH' AND date = (SELECT max(date) FROM v_log)")
def event_store_day(spark, sf_dir):
    """One day's events of a type, from its folder."""
    start, end = eventlog.range_of(newest_date(log(spark, sf_dir)))
    return eventstore.read_range(spark, event_store(spark, sf_dir), start, end - 1, event_type="SLA_BREACH").select(*_ROW.split(", "))


@query(f"SELECT {_ROW} FROM v_log WHERE pipelineId = 'bronze-seq' ORDER BY timestamp DESC, event_id DESC LIMIT 100")
def event_store_newest(spark, sf_dir):
    """The newest hundred of a source, from as many days as it takes."""
    return eventstore.read_newest(spark, event_store(spark, sf_dir), 100, source="bronze-seq").select(*_ROW.split(", "))


@query(f"SELECT {_ROW} FROM v_log WHERE eventType = 'SLA_WARNING'")
def event_store_type(spark, sf_dir):
    """Every event of a type, from the row groups that hold it."""
    return eventstore.read_type(spark, event_store(spark, sf_dir), "SLA_WARNING").select(*_ROW.split(", "))


@query(f"SELECT {_ROW} FROM v_log WHERE hour = 0 AND date = (SELECT max(date) FROM v_log)")
def event_store_hour(spark, sf_dir):
    """One hour of one day."""
    start, end = eventlog.range_of(newest_date(log(spark, sf_dir)), "00")
    return eventstore.read_range(spark, event_store(spark, sf_dir), start, end - 1).select(*_ROW.split(", "))


@query("""
    SELECT pipelineId, count(*) AS events, arg_max(eventType, timestamp * 1000000000 + event_id) AS last_type,
           CAST(max(timestamp) AS BIGINT) AS last_timestamp, arg_max(message, timestamp * 1000000000 + event_id) AS last_message
    FROM (SELECT pipelineId, eventType, message, CAST(timestamp AS HUGEINT) AS timestamp, event_id FROM v_log
          WHERE timestamp >= """ + _DAY_AGO + """) GROUP BY 1""")
def event_overview(spark, sf_dir):
    """The last 24 hours."""
    events = log(spark, sf_dir)
    return eventlog.overview(events, F.lit(newest_ms(events) - eventlog.ONE_DAY_MS))


@query(f"SELECT pipelineId, eventType, count(*) AS n FROM v_log WHERE timestamp >= {_WEEK_AGO} GROUP BY ALL")
def event_type_breakdown(spark, sf_dir):
    """The last week."""
    events = log(spark, sf_dir)
    return eventlog.type_breakdown(events, F.lit(newest_ms(events) - WEEK_MS))


@query(f"""
    , recent AS (SELECT * FROM v_log WHERE timestamp >= {_WEEK_AGO})
    SELECT p.pipelineId, CAST(h.range AS INT) AS hour, count(l.event_id) AS n
    FROM (SELECT DISTINCT pipelineId FROM recent) p CROSS JOIN range(24) h
    LEFT JOIN recent l ON l.pipelineId = p.pipelineId AND l.hour = h.range GROUP BY ALL""")
def event_hourly_hist(spark, sf_dir):
    """The last week."""
    events = log(spark, sf_dir)
    return eventlog.hourly_histogram(events, F.lit(newest_ms(events) - WEEK_MS))


@query("SELECT event_id, pipelineId, eventType, timestamp, message, date, scheduleId, hour FROM v_log")
def event_timeline(spark, sf_dir):
    return eventlog.timeline(log(spark, sf_dir))


@query("SELECT eventType, count(*) AS n FROM v_log GROUP BY 1")
def event_type_counts(spark, sf_dir):
    return eventlog.type_counts(log(spark, sf_dir))


def rare_types(spark, sf_dir):
    """Some events are of types that no list of this module names."""
    rare = F.when(F.col("event_id") % 11 == 0, "INFRA_FAILURE").when(F.col("event_id") % 13 == 0, "DATA_DRIFT")
    return log(spark, sf_dir).withColumn("eventType", F.coalesce(rare, "eventType"))


_RARE = """, rare AS (SELECT date, pipelineId, CASE WHEN event_id % 11 = 0 THEN 'INFRA_FAILURE' WHEN event_id % 13 = 0 THEN 'DATA_DRIFT' ELSE eventType END AS eventType FROM v_log)"""


# named types: a pivot over whatever is there cannot stand in a view
_TYPES = "('DATA_DRIFT', 'INFRA_FAILURE', 'JOB_COMPLETED', 'JOB_FAILED', 'JOB_TRIGGERED', 'SLA_BREACH', 'SLA_MET', 'SLA_WARNING')"


@query(f"{_RARE} SELECT * FROM (PIVOT rare ON eventType IN {_TYPES} USING count(*) GROUP BY date)")
def event_pivot_date(spark, sf_dir):
    """A column for every type the log holds."""
    return eventlog.pivot_types(rare_types(spark, sf_dir), "date")


@query(f"{_RARE} SELECT * FROM (PIVOT rare ON eventType IN {_TYPES} USING count(*) GROUP BY pipelineId)")
def event_pivot_source(spark, sf_dir):
    return eventlog.pivot_types(rare_types(spark, sf_dir), "pipelineId")


@query(f"""
    , week AS (SELECT * FROM v_log WHERE timestamp >= {_WEEK_AGO})
    SELECT 'total' AS measure, '' AS item, count(*) AS n FROM week
    UNION ALL SELECT 'type', eventType, count(*) FROM week GROUP BY 2
    UNION ALL SELECT 'source', pipelineId, count(*) FROM week GROUP BY 2
    UNION ALL SELECT 'hour', strftime(time, '%Y-%m-%dT%H'), count(*) FROM week GROUP BY 2
    UNION ALL SELECT 'sla', t, count_if(eventType = t) FROM week, (VALUES ('SLA_MET'), ('SLA_WARNING'), ('SLA_BREACH')) s(t) GROUP BY t""")
def event_metrics(spark, sf_dir):
    """The last week."""
    events = log(spark, sf_dir)
    end = newest_ms(events)
    return eventlog.metrics(events, F.lit(end - WEEK_MS), F.lit(end))


@query("""
    SELECT date, pipelineId, hour, count(*) AS events,
           CASE WHEN bool_or(eventType IN ('SLA_BREACH', 'JOB_FAILED')) THEN 'critical'
                WHEN bool_or(eventType = 'SLA_WARNING') THEN 'warning'
                WHEN bool_or(eventType IN ('SLA_MET', 'JOB_COMPLETED')) THEN 'success' ELSE 'info' END AS severity
    FROM v_log GROUP BY ALL""")
def event_worst_severity(spark, sf_dir):
    return eventlog.worst_severity(eventlog.timeline(log(spark, sf_dir)), ["date", "pipelineId", "hour"])


@query("""
    SELECT pipelineId, CASE WHEN bool_or(eventType = 'SLA_BREACH') THEN 'Breach'
                            WHEN bool_or(eventType = 'SLA_WARNING') THEN 'Warning' ELSE 'OK' END AS sla_status
    FROM v_log GROUP BY 1""")
def event_sla_status(spark, sf_dir):
    return eventlog.sla_status(log(spark, sf_dir))


@query("SELECT event_id, time, pipelineId, eventType, date, scheduleId, message FROM v_log WHERE pipelineId = 'silver-cdr-hour' ORDER BY timestamp DESC, event_id DESC LIMIT 100")
def event_recent_by_source(spark, sf_dir):
    mine = log(spark, sf_dir).filter(F.col("pipelineId") == "silver-cdr-hour")
    return eventlog.normalize(eventlog.newest(mine, 100))


@query("SELECT event_id, time, pipelineId, eventType, date, scheduleId, message FROM v_log WHERE eventType = 'SLA_BREACH' ORDER BY timestamp DESC, event_id DESC LIMIT 100")
def event_recent_by_type(spark, sf_dir):
    mine = log(spark, sf_dir).filter(F.col("eventType") == "SLA_BREACH")
    return eventlog.normalize(eventlog.newest(mine, 100))


@query("SELECT event_id, time, pipelineId, eventType, date, scheduleId, message FROM v_log WHERE pipelineId = 'bronze-seq' ORDER BY timestamp, event_id LIMIT 10")
def event_first10(spark, sf_dir):
    return eventlog.normalize(eventlog.oldest(log(spark, sf_dir).filter(F.col("pipelineId") == "bronze-seq")))


@query("""
    , cell AS (SELECT pipelineId, date, hour FROM v_log ORDER BY timestamp DESC, event_id DESC LIMIT 1)
    SELECT event_id, pipelineId, eventType, timestamp, message, date, scheduleId, hour
    FROM v_log JOIN cell USING (pipelineId, date, hour)""")
def event_cell_drilldown(spark, sf_dir):
    """All events of the cell the newest event lies in, newest first."""
    events = eventlog.timeline(log(spark, sf_dir))
    last = eventlog.newest(events, 1).first()
    mine = events.filter((F.col("pipelineId") == last.pipelineId) & (F.col("date") == last.date) & (F.col("hour") == last.hour))
    return mine.orderBy(F.desc("timestamp"), F.desc("event_id"))


# ---- sensors ------------------------------------------------------------


def weather_items(spark, sf_dir):
    """Control-store items: a flat map, a nested map, and no period of their own."""
    batches = monitoring.weather_batches(tables.weather(spark, sf_dir))
    totals = monitoring.weather_ready(batches)
    text = lambda c: F.col(c).cast("string")
    data = F.create_map(
        F.lit("date"), F.substring("period", 1, 8), F.lit("hour"), F.substring("period", 10, 2),
        F.lit("total_readings"), text("total_readings"), F.lit("valid_readings"), text("valid_readings"),
        F.lit("batches_received"), text("batches_received"),
    )
    nested = F.create_map(F.lit("weather-audit"), F.create_map(F.lit("total_readings"), text("total_readings")))
    return totals.select(
        F.lit("dryrun-weather").alias("pipeline_id"),
        F.concat(F.lit("SENSOR#weather-ready#"), "period").alias("sk"),
        data.alias("data"), nested.alias("nested"),
    )


@query("""
    , f AS (SELECT strptime(replace(period, 'T', ''), '%Y%m%d%H') AS period, total_readings, valid_readings, batches_received FROM v_wx_ready),
    l AS (SELECT period, 'total_readings' AS field, total_readings AS v FROM f
          UNION ALL SELECT period, 'valid_readings', valid_readings FROM f
          UNION ALL SELECT period, 'batches_received', batches_received FROM f
          UNION ALL SELECT period, 'weather-audit.total_readings', total_readings FROM f)
    SELECT 'dryrun-weather' AS pipeline_id, 'weather-ready' AS sensor, period, field, CAST(v AS VARCHAR) AS value FROM l""")
def sensor_flatten(spark, sf_dir):
    return eventlog.flatten_sensors(weather_items(spark, sf_dir))


@query("""
    SELECT time AS "at", 'event' AS origin, eventType, message FROM v_log
    UNION ALL
    SELECT updated_at, 'sensor', 'weather-ready',
           'weather-ready [' || substr(period, 1, 4) || '-' || substr(period, 5, 2) || '-' || substr(period, 7, 5)
           || ']: total_readings=' || total_readings || ', valid_readings=' || valid_readings
           || ', batches_received=' || batches_received || CASE WHEN l.period IS NULL THEN '' ELSE ', complete=true' END
    FROM v_wx_ready LEFT JOIN (SELECT period FROM v_wx_latch) l USING (period)""")
def event_sensor_timeline(spark, sf_dir):
    return eventlog.merged_timeline(log(spark, sf_dir), weather_snapshots(spark, sf_dir))


def weather_snapshots(spark, sf_dir):
    state = monitoring.weather_ready(monitoring.weather_batches(tables.weather(spark, sf_dir)))
    snapshots = state.withColumn("sensor", F.lit("weather-ready")).withColumn("complete", F.when(F.col("complete"), True))
    return snapshots.withColumn("period", F.to_timestamp_ntz("period", F.lit("yyyyMMdd'T'HH")))


@query("""
    SELECT * FROM (SELECT time AS "at", 'event' AS origin, eventType, message FROM v_log WHERE pipelineId = 'bronze-cdr'
                   ORDER BY timestamp DESC, event_id DESC LIMIT 200)
    UNION ALL
    SELECT updated_at, 'sensor', 'weather-ready',
           'weather-ready [' || substr(period, 1, 4) || '-' || substr(period, 5, 2) || '-' || substr(period, 7, 5)
           || ']: total_readings=' || total_readings || ', valid_readings=' || valid_readings
           || ', batches_received=' || batches_received || CASE WHEN l.period IS NULL THEN '' ELSE ', complete=true' END
    FROM v_wx_ready LEFT JOIN (SELECT period FROM v_wx_latch) l USING (period) WHERE CAST(substr(period, 10, 2) AS INT) % 2 = 0""")
def event_source_timeline(spark, sf_dir):
    """One pipeline's newest 200 events with its sensors; every other sensor keeps its time
    in a nested map only, and those of odd hours belong to another pipeline."""
    snapshots = weather_snapshots(spark, sf_dir)
    hour = F.hour("period")
    inner = F.create_map(F.lit("baseline"), F.create_map(F.lit("updatedAt"), F.col("updated_at").cast("string")))
    snapshots = snapshots.select(
        F.when(hour % 2 == 0, "bronze-cdr").otherwise("bronze-seq").alias("pipeline_id"), "sensor", "period", "total_readings",
        "valid_readings", "batches_received", "complete", F.when(hour % 4 != 0, F.col("updated_at")).alias("updated_at"), inner.alias("nested"),
    )
    return eventlog.merged_timeline(log(spark, sf_dir), snapshots, "bronze-cdr", 200)


@query("""
    SELECT sensor, period, field, CAST(v AS VARCHAR) AS value FROM (
        SELECT 'weather-ready' AS sensor, strptime(replace(period, 'T', ''), '%Y%m%d%H') AS period, total_readings, valid_readings, batches_received,
               total_readings AS "weather-audit.total_readings" FROM v_wx_ready WHERE CAST(substr(period, 10, 2) AS INT) % 2 = 0)
    UNPIVOT (v FOR field IN (total_readings, valid_readings, batches_received, "weather-audit.total_readings"))""")
def sensor_by_source(spark, sf_dir):
    """The sensors of one of two pipelines."""
    items = weather_items(spark, sf_dir)
    even = F.split("sk", "T")[1].cast("int") % 2 == 0
    items = items.withColumn("pipeline_id", F.when(even, "dryrun-weather").otherwise("other"))
    return eventlog.sensors_of(items, "dryrun-weather").drop("pipeline_id")
