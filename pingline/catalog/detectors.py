"""Data-quality detectors over inputs into which a share of faults is projected."""

from __future__ import annotations

from pyspark.sql import functions as F

from pingline.catalog import control
from pingline.catalog.registry import query
from pingline.functions.columns import floor_window, machine_health, period_start, time_of_millis
from pingline.operators import calendar, monitoring, quality
from pingline.operators.completeness import completeness_latch
from pingline.sources import tables


def arrivals(spark, sf_dir):
    """Every tenth value of ``k`` arrives 100 minutes after its event, the others 5."""
    delay = F.make_dt_interval(mins=F.when(F.col("k") % 10 == 0, 100).otherwise(5))
    return tables.events(spark, sf_dir).select(
        "event_id", "par_day", "par_hour", "ts", (F.col("ts") + delay).alias("arrived_at"),
        tables.stream_of().alias("stream"),
    )


def period_end():
    return period_start("par_day", "par_hour") + F.expr("INTERVAL 1 HOUR")


@query("""
    SELECT event_id, par_day, par_hour, arrived_at, (epoch_us(arrived_at) - epoch_us(period_end)) // 1000000 AS late_seconds
    FROM v_arrive WHERE arrived_at > period_end + INTERVAL 30 MINUTE""")
def dq_late(spark, sf_dir):
    found = quality.late(arrivals(spark, sf_dir), "arrived_at", period_end(), 1800)
    return found.select("event_id", "par_day", "par_hour", "arrived_at", "late_seconds")


@query("""
    , c AS (SELECT unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, (SELECT min(ts) FROM events)),
                                          (SELECT max(ts) FROM events), INTERVAL 15 MINUTE)) AS window_start)
    SELECT window_start, s.stream FROM c CROSS JOIN (VALUES ('cdr'), ('seq')) s(stream)
    ANTI JOIN (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, stream FROM v_deliv) USING (window_start, stream)""")
def dq_missing_windows(spark, sf_dir):
    rows = tables.deliveries(spark, sf_dir)
    slots = calendar.calendar(calendar.span_of(rows), streams=calendar.STREAMS)
    return quality.missing_windows(slots, rows.withColumn("window_start", floor_window("ts")), ["window_start", "stream"])


@query("""
    , m AS (SELECT DISTINCT stream, par_day, par_hour, f.range AS file_no FROM v_deliv, range(4) f)
    SELECT stream, par_day, par_hour, CAST(file_no AS INT) AS file_no FROM m ANTI JOIN v_deliv USING (stream, par_day, par_hour, file_no)""")
def dq_empty_files(spark, sf_dir):
    """Four files are announced for every hour delivered; those without rows are empty."""
    rows = tables.deliveries(spark, sf_dir)
    hours = rows.select("stream", "par_day", "par_hour").distinct()
    manifest = hours.withColumn("file_no", F.explode(F.array(*[F.lit(i) for i in range(4)])))
    return quality.empty_files(manifest, rows, ["stream", "par_day", "par_hour", "file_no"])


@query("""
    SELECT par_day, par_hour, count(*) AS total_rows, count_if(k % 20 = 0 OR k % 20 = 7) AS corrupt_rows,
           count_if(k % 20 = 0 OR k % 20 = 7) / count(*) AS corrupt_share FROM v_evt GROUP BY ALL""")
def dq_corrupt(spark, sf_dir):
    """Some towers are null and some amounts are no numbers."""
    rows = tables.events(spark, sf_dir).select(
        "par_day", "par_hour",
        F.when(F.col("k") % 20 != 0, F.col("event_type")).alias("cell_tower"),
        F.when(F.col("k") % 20 == 7, "n/a").otherwise(F.col("value").cast("string")).alias("amount"),
    )
    return quality.corruption(rows, ["par_day", "par_hour"], ["cell_tower"], {"amount": "double"})


@query("""
    SELECT sha256(text) AS content_hash, count(*) AS copies, min(doc_id) AS first_id
    FROM documents GROUP BY text HAVING count(*) > 1""")
def dq_duplicates(spark, sf_dir):
    return quality.duplicates(tables.table(spark, sf_dir, "documents"), ["text"], "doc_id")


@query("SELECT event_id, ts, user_id, event_type, value, k, par_day, par_hour FROM v_evt")
def dedup(spark, sf_dir):
    """The whole table delivered twice."""
    rows = tables.events(spark, sf_dir)
    return quality.deduplicate(rows.unionByName(rows))


@query("""
    , a AS (SELECT par_day, par_hour, ts, event_id + CASE WHEN k % 10 = 0 THEN 7 ELSE 0 END AS pos, event_id FROM v_evt),
    o AS (SELECT par_day, par_hour, ts, lag(ts) OVER (PARTITION BY par_day, par_hour ORDER BY pos * 2 + CASE WHEN pos = event_id THEN 0 ELSE 1 END) AS before FROM a)
    SELECT par_day, par_hour, count(*) AS total_rows, count_if(coalesce(before > ts, false)) AS out_of_order_rows FROM o GROUP BY ALL""")
def dq_out_of_order(spark, sf_dir):
    """Some rows arrive seven places late in their hour's file."""
    moved = F.col("k") % 10 == 0
    place = F.when(moved, (F.col("event_id") + 7) * 2 + 1).otherwise(F.col("event_id") * 2)
    rows = tables.events(spark, sf_dir).select("par_day", "par_hour", "ts", place.alias("arrival"))
    return quality.out_of_order(rows, ["par_day", "par_hour"], "arrival")


@query("""
    SELECT 'extra_field_1' AS field, 'added' AS change, count_if(k < 10) AS records FROM v_evt WHERE k NOT BETWEEN 40 AND 43
    UNION ALL SELECT 'cell_tower', 'removed', count_if(k >= 90) FROM v_evt
    UNION ALL SELECT '', 'malformed', count_if(k IN (40, 41)) FROM v_evt
    UNION ALL SELECT '', 'absent', count_if(k IN (42, 43)) FROM v_evt""")
def dq_schema_drift(spark, sf_dir):
    """Call records of which some have a field too many, some lack the tower, some are cut
    off and some are missing."""
    k = F.col("k")
    rows = tables.events(spark, sf_dir)
    body = F.struct(
        F.col("user_id").cast("string").alias("phone_out"), F.concat(F.lit("c"), k).alias("phone_in"),
        F.when(k < 90, F.col("event_type")).alias("cell_tower"), F.col("ts").cast("string").alias("time"),
        F.when(k < 10, F.lit("x")).alias("extra_field_1"),
    )
    # null fields are left out of the JSON text
    text = F.to_json(body)
    payload = F.when(k.isin(40, 41), F.substring(text, 1, 20)).when(~k.isin(42, 43), text)
    return quality.payload_drift(rows.select(payload.alias("payload")), "payload", ["phone_out", "phone_in", "cell_tower", "time"])


@query("""
    SELECT a.stream, a.par_day, a.par_hour, count(*) AS replayed_rows, min(a.arrived_at) AS first_replay
    FROM v_arrive a JOIN v_latch l USING (stream, par_day, par_hour) WHERE a.arrived_at > l.completed_at GROUP BY ALL""")
def dq_stale_replay(spark, sf_dir):
    done = completeness_latch(control.with_target(tables.files(spark, sf_dir), "records"))
    return quality.stale_replay(arrivals(spark, sf_dir), done, ["stream", "par_day", "par_hour"])


@query("""
    SELECT par_day, par_hour, count_if(arrived_at <= period_end + INTERVAL 15 MINUTE) AS baseline, count(*) AS current,
           count_if(arrived_at > period_end + INTERVAL 15 MINUTE) AS drift
    FROM v_arrive GROUP BY ALL HAVING drift <> 0""")
def dq_post_run_drift(spark, sf_dir):
    """The job ran a quarter past; rows that came later changed its count."""
    return quality.post_run_drift(arrivals(spark, sf_dir), ["par_day", "par_hour"], period_end() + F.expr("INTERVAL 15 MINUTES"))


@query("SELECT machine_id, count(*) AS records FROM v_iot ANTI JOIN v_roster USING (machine_id) GROUP BY 1")
def dq_phantom_entity(spark, sf_dir):
    return quality.phantom_entities(tables.machine_readings(spark, sf_dir), "machine_id", monitoring.MACHINES)


@query("SELECT batch_id, lag_seconds FROM v_bank_batch WHERE lag_seconds > 300 AND cob_complete")
def dq_lag_breach(spark, sf_dir):
    batches = monitoring.batch_lag(tables.transactions(spark, sf_dir), ["batch_id"])
    return batches.filter((F.col("lag_seconds") > 300) & F.col("cob_complete")).select("batch_id", "lag_seconds")


@query("""
    SELECT user_id, max(ts) AS updated_at, (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts))) // 1000000 AS age_seconds
    FROM v_evt GROUP BY user_id HAVING epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts)) >= 3600000000""")
def dq_stale(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "events")
    latest = rows.groupBy("user_id").agg(F.max("ts").alias("updated_at"))
    return quality.stale(latest, control.newest_ts(spark, sf_dir), 3600)


@query("""
    SELECT event_id, machine_id, updated_at + INTERVAL 2 HOUR AS updated_at FROM v_iot WHERE k = 7""")
def dq_future_ts(spark, sf_dir):
    """Some readings claim a time two hours ahead of their arrival."""
    rows = tables.machine_readings(spark, sf_dir)
    forged = F.col("updated_at") + F.make_dt_interval(hours=F.when(F.col("k") == 7, 2).otherwise(0))
    rows = rows.withColumn("seen_at", F.col("updated_at") + F.expr("INTERVAL 5 SECONDS")).withColumn("updated_at", forged)
    return quality.in_future(rows, "updated_at", F.col("seen_at")).select("event_id", "machine_id", "updated_at")


@query("""
    SELECT event_id, machine_id, 'critical' AS status, derived_status FROM v_iot_class WHERE k % 10 = 0 AND derived_status <> 'critical'""")
def dq_inconsistent_status(spark, sf_dir):
    """Some readings are stored as critical whatever they measured."""
    health = machine_health("temperature", "vibration", "pressure")
    rows = tables.machine_readings(spark, sf_dir).withColumn("status", F.when(F.col("k") % 10 == 0, "critical").otherwise(health))
    return quality.inconsistent_status(rows).select("event_id", "machine_id", "status", "derived_status")


@query("""
    , s AS (SELECT machine_id, event_id, updated_at, derived_status,
                   lag(derived_status) OVER (PARTITION BY machine_id ORDER BY updated_at, event_id) AS before FROM v_iot_class),
    c AS (SELECT machine_id, event_id, updated_at FROM s WHERE before <> derived_status)
    SELECT machine_id, event_id, updated_at, n AS toggles
    FROM (SELECT *, count(*) OVER (PARTITION BY machine_id ORDER BY updated_at RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW) AS n FROM c)
    WHERE n >= 3""")
def dq_flapping(spark, sf_dir):
    """Readings here are minutes apart, so the span is two hours."""
    health = machine_health("temperature", "vibration", "pressure")
    rows = tables.machine_readings(spark, sf_dir).withColumn("status", health)
    return quality.flapping(rows, "machine_id", "status", "updated_at", "event_id", span_seconds=7200, min_toggles=3)


@query("SELECT run_no, model_version, reason FROM v_gate WHERE starts_with(reason, 'NaN') AND run_no % 2 = 1")
def dq_false_success(spark, sf_dir):
    """Odd runs reported success, the others failure."""
    gated = control.gated_models(spark, sf_dir)
    runs = tables.models(spark, sf_dir).select("run_no", F.when(F.col("run_no") % 2 == 1, "SUCCEEDED").otherwise("FAILED").alias("status"))
    return quality.false_success(gated, runs).select("run_no", "model_version", "reason")


@query("""
    , a AS (SELECT s_suppkey AS run, CAST((s_acctbal + 1000) / 12000 AS DOUBLE) AS m FROM supplier),
    f AS (SELECT run, m, CASE WHEN m < lag(m) OVER (ORDER BY run) THEN 1 ELSE 0 END AS fell FROM a),
    g AS (SELECT *, sum(1 - fell) OVER (ORDER BY run) AS series FROM f)
    SELECT min(run) AS first_run, max(run) AS last_run, CAST(sum(fell) AS BIGINT) AS drops,
           arg_min(m, run) AS first_value, arg_max(m, run) AS last_value
    FROM g GROUP BY series HAVING sum(fell) >= 2 AND arg_max(m, run) < 0.95""")
def dq_rolling_degradation(spark, sf_dir):
    runs = tables.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("run"), ((F.col("s_acctbal") + 1000) / 12000).alias("m"))
    return quality.rolling_degradation(runs, "run", "m", 0.95)


@query("""
    SELECT row_id // 100 AS run, round(avg(credit_score), 6) AS credit_score_mean, round(stddev_pop(credit_score), 6) AS credit_score_std,
           round(avg(income), 6) AS income_mean, round(stddev_pop(income), 6) AS income_std,
           round(avg(debt_ratio), 6) AS debt_ratio_mean, round(stddev_pop(debt_ratio), 6) AS debt_ratio_std
    FROM v_ml GROUP BY 1""")
def dq_feature_profile(spark, sf_dir):
    names = ["credit_score", "income", "debt_ratio"]
    out = quality.feature_profile(tables.features(spark, sf_dir), F.floor(F.col("row_id") / 100).cast("bigint"), names)
    return out.select("run", *[F.round(c, 6).alias(c) for c in out.columns if c != "run"])


@query("""
    SELECT concat('v1.0.', user_id) AS model_version, count(*) AS "references" FROM v_evt
    WHERE concat('v1.0.', user_id) NOT IN (SELECT model_version FROM v_model) GROUP BY 1""")
def dq_dangling_reference(spark, sf_dir):
    """Events stand for training sensors that name a model."""
    refs = tables.table(spark, sf_dir, "events").select(F.concat(F.lit("v1.0."), "user_id").alias("model_version"))
    return quality.dangling_references(refs, tables.models(spark, sf_dir), "model_version")


@query("""
    SELECT d.event_id, d.pipelineId, d.time AS ts FROM v_log d WHERE d.eventType = 'JOB_COMPLETED' AND NOT EXISTS (
        SELECT 1 FROM v_log u WHERE u.eventType = 'JOB_TRIGGERED' AND u.pipelineId = d.pipelineId
        AND u.time > d.time AND u.time <= d.time + INTERVAL 30 MINUTE)""")
def dq_stale_trigger(spark, sf_dir):
    """Completions that no trigger of the same source follows within half an hour."""
    log = tables.event_log(spark, sf_dir).select("event_id", "pipelineId", "eventType", time_of_millis("timestamp").alias("ts"))
    done = log.filter(F.col("eventType") == "JOB_COMPLETED").drop("eventType")
    return quality.stale_triggers(done, log.filter(F.col("eventType") == "JOB_TRIGGERED"), "pipelineId")
