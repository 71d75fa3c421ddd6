"""Completeness, reconciliation, rules, deadlines and dry runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pingline.catalog.registry import query
from pingline.functions.columns import VALID_QUALITY, epoch_micros, machine_health, period_start
from pingline.operators import completeness, features, monitoring
from pingline.plans import rules
from pingline.plans.definitions import DEADLINES, seconds_of
from pingline.session import stored
from pingline.sources import tables


def with_target(table, records):
    """A day's target is what the day holds, so hours compare with the daily curve."""
    return table.withColumn("daily_target", F.sum(records).over(Window.partitionBy("stream", "par_day")))


def complete_hours(spark, sf_dir):
    counters = completeness.hourly_counters(tables.files(spark, sf_dir))
    return completeness.hourly_completeness(with_target(counters, "count"))


def audit(spark, sf_dir):
    """Counters of which some are one too high and others were lost."""
    counters = completeness.hourly_counters(tables.files(spark, sf_dir))
    return completeness.reconcile(miscounted(counters), completeness.stored_counts(tables.deliveries(spark, sf_dir)))


def miscounted(counters):
    hour = F.col("par_hour").cast("int")
    wrong = F.when(hour % 8 == 7, 0).when(hour % 6 == 5, F.col("count") + 1).otherwise(F.col("count"))
    return counters.select("stream", "par_day", "par_hour", wrong.alias("sensor_count"))


def completions(spark, sf_dir):
    event = F.col("event_type")
    job = F.when(event.isin("view", "click"), "silver-seq-hour").when(event == "error", "bronze-cdr").otherwise("silver-cdr-hour")
    date = F.when(F.col("k") == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH"))
    return tables.events(spark, sf_dir).select(job.alias("pipelineId"), date.alias("date"))


def gated_models(spark, sf_dir):
    models = tables.models(spark, sf_dir)
    # shares of whole percents; a text that is no number stays as it is
    share = lambda c: F.coalesce((F.col(c).try_cast("int") / 100).cast("string"), F.col(c))
    return features.quality_gate(
        models.select("run_no", "model_version", share("accuracy_pct").alias("accuracy"), share("loss_pct").alias("loss"), "weights_hash")
    )


def newest_ts(spark, sf_dir):
    """The log's last moment, as the constant a caller would pass for "now"."""
    text = tables.table(spark, sf_dir, "events").select(F.max("ts").cast("string")).first()[0]
    return F.lit(text).cast("timestamp_ntz")


@query("""
    SELECT t.par_day, w.window_no, coalesce(a.actual, 0) AS actual,
           CAST(round_even(t.n * w.weight / (SELECT sum(weight) FROM v_weights), 0) AS BIGINT) AS expected
    FROM (SELECT par_day, count(*) AS n FROM v_evt GROUP BY par_day) t CROSS JOIN v_weights w
    LEFT JOIN (SELECT par_day, CAST(hour(ts) * 4 + minute(ts) // 15 AS INT) AS window_no, count(*) AS actual
               FROM v_evt GROUP BY ALL) a ON a.par_day = t.par_day AND a.window_no = w.window_no""")
def expected_volume(spark, sf_dir):
    pings = tables.events(spark, sf_dir)
    days = pings.groupBy("par_day").agg(F.count(F.lit(1)).alias("daily_target"))
    return completeness.window_volume(pings, days, ["par_day"])


@query("""
    SELECT stream, par_day, par_hour, count, files_processed, expected_count,
           round(pct_of_expected, 9) AS pct_of_expected, complete, updated_at FROM v_complete""")
def hourly_completeness(spark, sf_dir):
    return complete_hours(spark, sf_dir).withColumn("pct_of_expected", F.round("pct_of_expected", 9))


@query("SELECT * FROM v_latch")
def completeness_latch(spark, sf_dir):
    return completeness.completeness_latch(with_target(tables.files(spark, sf_dir), "records"))


@query("SELECT * FROM v_audit")
def audit_reconcile(spark, sf_dir):
    return audit(spark, sf_dir)


@query("SELECT * FROM v_daily")
def daily_complete(spark, sf_dir):
    out = completeness.daily_completeness(completions(spark, sf_dir))
    return out.withColumn("completed_hours", F.array_join("completed_hours", ","))


@query("""
    , h AS (SELECT c.stream, c.par_day, c.par_hour, c.complete AS bronze_complete, coalesce(a.match, false) AS audit_match,
                      c.complete AND coalesce(a.match, false) AS hour_ready
               FROM v_complete c LEFT JOIN v_audit a USING (stream, par_day, par_hour))
    SELECT h.*, count_if(hour_ready) OVER (PARTITION BY stream, par_day) >= 24 AS day_ready FROM h""")
def chain_status(spark, sf_dir):
    return rules.chain_status(complete_hours(spark, sf_dir), audit(spark, sf_dir))


# ---- rules --------------------------------------------------------------


#: Grouping sets of one reading of the events: files, machine hours, completions, transaction
#: batches and weather batches.
FACTS = {
    "files": ["stream", "par_day", "par_hour", "file_no"],
    "machines": ["machine_id", "par_day", "par_hour"],
    "completions": ["pipelineId", "date"],
    "batches": ["batch_id"],
    "weather": ["period", "batch_no"],
}


def facts(spark, sf_dir, newest):
    """What all sensors are made of, in one reading and one shuffle of the events. On days of
    the newest day's parity all machines run calmly; transactions come in batches of two."""
    evt = tables.events(spark, sf_dir)
    keys = sorted({k for ks in FACTS.values() for k in ks})
    event = F.col("event_type")
    calm = F.dayofmonth("ts") % 2 == F.dayofmonth(newest) % 2
    m = {c: F.col(c) for c in ("temperature", "vibration", "pressure")}
    rows = tables.with_machine(evt).select(
        tables.stream_of().alias("stream"), "par_day", "par_hour", F.floor(F.minute("ts") / 15).cast("int").alias("file_no"),
        "machine_id", *[F.when(calm, F.lit(v)).otherwise(m[c]).alias(c) for c, v in (("temperature", 20.0), ("vibration", 10.0), ("pressure", 5.0))],
        F.when(event.isin("view", "click"), "silver-seq-hour").when(event == "error", "bronze-cdr").otherwise("silver-cdr-hour").alias("pipelineId"),
        F.when(F.col("k") == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH")).alias("date"),
        F.floor(F.col("event_id") / 2).cast("bigint").alias("batch_id"),
        F.concat("par_day", F.lit("T"), "par_hour").alias("period"), F.floor(F.minute("ts") / 10).cast("int").alias("batch_no"),
        (F.lit(0.6) + (F.col("k") % 41) / F.lit(100.0)).alias("quality"), "ts",
    )
    cube = rows.groupingSets([[F.col(k) for k in ks] for ks in FACTS.values()], *[F.col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("oldest"), F.max("ts").alias("newest"),
        *[F.avg(c).alias(f"{c}_mean") for c in monitoring.MEASURES],
        F.count_if(F.col("quality") >= VALID_QUALITY).alias("valid"), F.grouping_id().alias("kind"),
    )
    cube = stored(cube, "rule-facts")
    bits = {k: 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)}
    return {name: cube.filter(F.col("kind") == sum(bits[k] for k in keys if k not in ks)) for name, ks in FACTS.items()}


def run_sensors(spark, sf_dir, newest):
    """Sensors of the data prep, training, evaluation and deployment of every model run."""
    run = F.col("run_no")
    ago = lambda hours: newest - F.make_dt_interval(hours=hours.cast("int"))
    gate = gated_models(spark, sf_dir).drop("accuracy").withColumnRenamed("accuracy_value", "accuracy")
    runs = gate.select(
        run.cast("string").alias("period"), "passed", "accuracy", (run % 6 != 0).alias("prepared"), ((run % 9) * 100).alias("row_count"),
        (F.col("weights_hash") != "").alias("trained"), (F.col("passed") & (run % 2 == 1)).alias("deployed"),
        ago(run % 4).alias("written"), ago(run % 5).alias("prepared_at"), ago(run % 3).alias("trained_at"),
    )
    return sensor_rows(
        runs,
        ("ml-data-prep", "raw_features", "updated_at", "written"),
        ("ml-data-prep", "data_prep_status", "complete", "prepared"),
        ("ml-data-prep", "data_prep_status", "row_count", "row_count"),
        ("ml-training", "data_prep_status", "complete", "prepared"),
        ("ml-training", "data_prep_status", "updated_at", "prepared_at"),
        ("ml-training", "training_status", "complete", "trained"),
        ("ml-evaluation", "training_status", "complete", "trained"),
        ("ml-evaluation", "training_status", "updated_at", "trained_at"),
        ("ml-evaluation", "eval_status", "passed", "passed"),
        ("ml-deployment", "eval_status", "passed", "passed"),
        ("ml-deployment", "eval_status", "accuracy", "accuracy"),
        ("ml-deployment", "eval_status", "updated_at", "written"),
        ("ml-deployment", "deployment_status", "deployed", "deployed"),
    )


def sensor_rows(df, *fields):
    """One pass over a table for all sensors it feeds: (job, sensor, field, column[, condition])."""
    entries = []
    for job, sensor, field, column, *condition in fields:
        job = F.lit(job) if isinstance(job, str) else job
        if condition:
            job = F.when(condition[0], job)
        entries.append(
            F.struct(job.alias("job"), F.lit(sensor).alias("sensor"), F.lit(field).alias("field"),
                     F.col(column).cast("string").alias("value"))
        )
    return (
        df.select("period", F.explode(F.array(*entries)).alias("e"))
        .select("e.job", "e.sensor", "period", "e.field", "e.value")
        .filter(F.col("job").isNotNull())
    )


def control_sensors(spark, sf_dir, newest):
    """Sensors of all jobs in long form; flags are the texts true and false."""
    fact = facts(spark, sf_dir, newest)
    files = fact["files"].select(*FACTS["files"], F.col("n").alias("records"), F.col("newest").alias("arrived_at"))
    counters = completeness.hourly_counters(files)
    hour_key = ["stream", "par_day", "par_hour"]
    audited = completeness.reconcile(
        miscounted(counters), files.groupBy(*hour_key).agg(F.sum("records").alias("stored_count")))
    hours = completeness.hourly_completeness(with_target(counters, "count")).drop("updated_at")
    hours = hours.join(audited.select(*hour_key, "match"), hour_key, "full")
    hours = hours.withColumn("period", F.concat("par_day", F.lit("T"), "par_hour"))
    hourly = fact["machines"].select(
        *FACTS["machines"], machine_health(*[f"{c}_mean" for c in monitoring.MEASURES]).alias("status"), F.col("newest").alias("updated_at"))
    health = monitoring.factory_health(monitoring.latest_status(hourly, ["par_day"]), ["par_day"]).withColumn("period", F.col("par_day"))
    days = completeness.daily_completeness(fact["completions"].select("pipelineId", "date")).withColumn("period", F.col("par_day"))
    lags = fact["batches"].select(
        F.col("batch_id").cast("string").alias("period"), monitoring.cob_complete("newest").alias("cob"),
        F.floor((epoch_micros("newest") - epoch_micros("oldest")) / 1_000_000).cast("bigint").alias("lag"))
    weather = monitoring.weather_ready(fact["weather"].select(
        "period", "batch_no", F.col("n").alias("total"), "valid", F.col("newest").alias("arrived_at")))
    bronze, silver = F.concat(F.lit("bronze-"), "stream"), F.concat(F.lit("silver-"), "stream", F.lit("-hour"))
    counted, compared = F.col("complete").isNotNull(), F.col("match").isNotNull()
    parts = [
        sensor_rows(
            hours,
            (bronze, "hourly-status", "complete", "complete", counted),
            (bronze, "hourly-status", "pct_of_expected", "pct_of_expected", counted),
            (silver, "hourly-status", "count", "count", F.col("complete")),
            (bronze, "audit-result", "match", "match", compared),
            (silver, "audit-result", "match", "match", compared),
        ),
        sensor_rows(
            health, *[("iot-factory", "factory_health", f, f) for f in ("all_healthy", "healthy_count", "updated_at")]
        ),
        sensor_rows(days, (F.col("pipelineId"), "daily-status", "all_hours_complete", "all_hours_complete")),
        sensor_rows(
            lags,
            ("banking-streaming", "cob_status", "complete", "cob"),
            ("banking-streaming", "consumer_lag", "lag_seconds", "lag"),
        ),
        sensor_rows(
            weather,
            ("dryrun-weather", "weather-ready", "complete", "complete", F.col("complete")),
            ("dryrun-weather", "weather-ready", "total_readings", "total_readings"),
            ("dryrun-weather", "weather-audit", "total_readings", "total_readings"),
        ),
        run_sensors(spark, sf_dir, newest),
    ]
    return reduce(DataFrame.unionByName, parts)


#: The rules once more, as the checking engine reads them: job, phase, sensor, check, field, number.
_RULES_SQL = """
    ('banking-streaming', 'trigger', 'cob_status', 'equals', 'complete', 1),
    ('banking-streaming', 'validation', 'cob_status', 'equals', 'complete', 1),
    ('banking-streaming', 'validation', 'consumer_lag', 'lte', 'lag_seconds', 300),
    ('bronze-cdr', 'trigger', 'hourly-status', 'equals', 'complete', 1),
    ('bronze-cdr', 'validation', 'hourly-status', 'equals', 'complete', 1),
    ('bronze-cdr', 'validation', 'hourly-status', 'gte', 'pct_of_expected', 0.7),
    ('bronze-cdr', 'postRun', 'audit-result', 'equals', 'match', 1),
    ('bronze-seq', 'trigger', 'hourly-status', 'equals', 'complete', 1),
    ('bronze-seq', 'validation', 'hourly-status', 'equals', 'complete', 1),
    ('bronze-seq', 'validation', 'hourly-status', 'gte', 'pct_of_expected', 0.7),
    ('bronze-seq', 'postRun', 'audit-result', 'equals', 'match', 1),
    ('dryrun-weather', 'trigger', 'weather-ready', 'equals', 'complete', 1),
    ('dryrun-weather', 'validation', 'weather-ready', 'equals', 'complete', 1),
    ('dryrun-weather', 'validation', 'weather-ready', 'gte', 'total_readings', 12),
    ('dryrun-weather', 'postRun', 'weather-audit', 'gte', 'total_readings', 1),
    ('iot-factory', 'trigger', 'factory_health', 'equals', 'all_healthy', 1),
    ('iot-factory', 'validation', 'factory_health', 'equals', 'all_healthy', 1),
    ('iot-factory', 'validation', 'factory_health', 'gte', 'healthy_count', 10),
    ('iot-factory', 'validation', 'factory_health', 'age_lt', 'updated_at', 300),
    ('ml-data-prep', 'validation', 'raw_features', 'age_lt', 'updated_at', 7200),
    ('ml-data-prep', 'postRun', 'data_prep_status', 'equals', 'complete', 1),
    ('ml-data-prep', 'postRun', 'data_prep_status', 'gte', 'row_count', 1),
    ('ml-training', 'trigger', 'data_prep_status', 'equals', 'complete', 1),
    ('ml-training', 'validation', 'data_prep_status', 'equals', 'complete', 1),
    ('ml-training', 'validation', 'data_prep_status', 'age_lt', 'updated_at', 7200),
    ('ml-training', 'postRun', 'training_status', 'equals', 'complete', 1),
    ('ml-evaluation', 'trigger', 'training_status', 'equals', 'complete', 1),
    ('ml-evaluation', 'validation', 'training_status', 'equals', 'complete', 1),
    ('ml-evaluation', 'validation', 'training_status', 'age_lt', 'updated_at', 7200),
    ('ml-evaluation', 'postRun', 'eval_status', 'equals', 'passed', 1),
    ('ml-deployment', 'trigger', 'eval_status', 'equals', 'passed', 1),
    ('ml-deployment', 'validation', 'eval_status', 'equals', 'passed', 1),
    ('ml-deployment', 'validation', 'eval_status', 'gte', 'accuracy', 0.95),
    ('ml-deployment', 'validation', 'eval_status', 'age_lt', 'updated_at', 7200),
    ('ml-deployment', 'postRun', 'deployment_status', 'equals', 'deployed', 1),
    ('silver-cdr-hour', 'trigger', 'audit-result', 'equals', 'match', 1),
    ('silver-cdr-hour', 'validation', 'audit-result', 'equals', 'match', 1),
    ('silver-cdr-hour', 'postRun', 'hourly-status', 'gte', 'count', 1),
    ('silver-seq-hour', 'trigger', 'audit-result', 'equals', 'match', 1),
    ('silver-seq-hour', 'validation', 'audit-result', 'equals', 'match', 1),
    ('silver-seq-hour', 'postRun', 'hourly-status', 'gte', 'count', 1),
    ('silver-cdr-day', 'trigger', 'daily-status', 'equals', 'all_hours_complete', 1),
    ('silver-cdr-day', 'validation', 'daily-status', 'equals', 'all_hours_complete', 1),
    ('silver-cdr-day', 'postRun', 'daily-status', 'equals', 'all_hours_complete', 1),
    ('silver-seq-day', 'trigger', 'daily-status', 'equals', 'all_hours_complete', 1),
    ('silver-seq-day', 'validation', 'daily-status', 'equals', 'all_hours_complete', 1),
    ('silver-seq-day', 'postRun', 'daily-status', 'equals', 'all_hours_complete', 1)"""


def _rules_sql(phase: str) -> str:
    held = """chk = 'equals' AND num = val OR chk = 'gte' AND num >= val OR chk = 'lte' AND num <= val
                               OR chk = 'age_lt' AND epoch_us((SELECT max(ts) FROM events)) - epoch_us(written) < val * 1000000"""
    return f"""
    , every(job, phase, sensor, chk, field, val) AS (VALUES {_RULES_SQL}),
    r AS (SELECT *, row_number() OVER () AS rule_no FROM every WHERE phase = '{phase}')
    SELECT s.job, s.period, count(DISTINCT CASE WHEN {held} THEN rule_no END) AS passed_rules, any_value(n) AS total_rules,
           count(DISTINCT CASE WHEN {held} THEN rule_no END) = any_value(n) AS passed
    FROM v_sensors s JOIN (SELECT job, count(*) AS n FROM r GROUP BY job) t USING (job)
    LEFT JOIN r ON r.job = s.job AND r.sensor = s.sensor AND r.field = s.field
    GROUP BY s.job, s.period"""


def evaluated(spark, sf_dir, phase):
    newest = newest_ts(spark, sf_dir)
    return rules.evaluate(control_sensors(spark, sf_dir, newest), phase, newest)


@query(_rules_sql("validation"))
def rule_eval(spark, sf_dir):
    return evaluated(spark, sf_dir, "validation")


@query(_rules_sql("trigger"))
def trigger_ready(spark, sf_dir):
    return evaluated(spark, sf_dir, "trigger")


@query(_rules_sql("postRun"))
def post_run_eval(spark, sf_dir):
    return evaluated(spark, sf_dir, "postRun")


def job_runs(spark, sf_dir):
    """Bronze, hourly and daily runs that start with the period's first row and take
    a time that grows with its rows."""
    rows = tables.deliveries(spark, sf_dir)
    hours = rows.groupBy("stream", "par_day", "par_hour").agg(F.min("ts").alias("started_at"), F.count(F.lit(1)).alias("n"))
    days = rows.groupBy("stream", "par_day").agg(F.min("ts").alias("started_at"), F.count(F.lit(1)).alias("n"))

    def runs(df, job, start, seconds):
        took = F.make_dt_interval(secs=(F.col("n") * seconds).cast("decimal(18,6)"))
        return df.select(job.alias("job"), start.alias("period_start"), "started_at", (F.col("started_at") + took).alias("finished_at"))

    both = F.array(
        F.struct(F.concat(F.lit("bronze-"), "stream").alias("job"), F.lit(40).alias("seconds")),
        F.struct(F.concat(F.lit("silver-"), "stream", F.lit("-hour")).alias("job"), F.lit(120).alias("seconds")),
    )
    hourly = hours.withColumn("j", F.explode(both))
    return runs(hourly, F.col("j.job"), period_start("par_day", "par_hour"), F.col("j.seconds")).unionByName(
        runs(days, F.concat(F.lit("silver-"), "stream", F.lit("-day")), period_start("par_day"), F.lit(12))
    )


_LIMITS = ", ".join(
    f"('{job}', {text.startswith(':')}, {int(text.split(':')[0] or 0) * 60 + int(text.split(':')[1])}, "
    f"{seconds_of(expected)}, {seconds_of(longest)})"
    for job, text, expected, longest in DEADLINES
)


@query(f"""
    , hourly AS (SELECT stream, par_day, par_hour, min(ts) AS s, count(*) AS n FROM v_deliv GROUP BY ALL),
    daily AS (SELECT stream, par_day, min(ts) AS s, count(*) AS n FROM v_deliv GROUP BY ALL),
    runs AS (
        SELECT 'bronze-' || stream AS job, strptime(par_day || par_hour, '%Y%m%d%H') AS period_start, s AS started_at,
               s + to_seconds(n * 40) AS finished_at FROM hourly
        UNION ALL SELECT 'silver-' || stream || '-hour', strptime(par_day || par_hour, '%Y%m%d%H'), s, s + to_seconds(n * 120) FROM hourly
        UNION ALL SELECT 'silver-' || stream || '-day', strptime(par_day, '%Y%m%d'), s, s + to_seconds(n * 12) FROM daily),
    lim(job, within_hour, minutes, expected_s, max_s) AS (VALUES {_LIMITS}),
    o AS (SELECT runs.*, period_start + to_minutes(minutes) AS deadline_at,
                 (epoch_us(finished_at) - epoch_us(started_at)) // 1000000 AS duration_s, expected_s, max_s
          FROM runs JOIN lim USING (job))
    SELECT job, period_start, started_at, finished_at, deadline_at, duration_s,
           CASE WHEN finished_at > deadline_at OR duration_s > max_s THEN 'BREACH'
                WHEN duration_s > expected_s THEN 'WARNING' ELSE 'MET' END AS outcome FROM o""")
def sla_eval(spark, sf_dir):
    return rules.sla_outcome(job_runs(spark, sf_dir))


@query("""
    , fired AS (SELECT period, batch_no AS b0, latched_at AS t0, total_then AS baseline,
                       strptime(replace(period, 'T', ''), '%Y%m%d%H') AS start FROM v_wx_latch)
    SELECT period, 'DRY_RUN_WOULD_TRIGGER' AS event_type, t0 AS "at", CAST(baseline AS VARCHAR) AS detail FROM fired
    UNION ALL
    SELECT period, 'DRY_RUN_SLA_PROJECTION', t0 + INTERVAL 5 MINUTE,
           CASE WHEN t0 + INTERVAL 5 MINUTE <= start + INTERVAL 45 MINUTE THEN 'MET' ELSE 'BREACH' END FROM fired
    UNION ALL
    SELECT period, 'DRY_RUN_LATE_DATA', arrived_at, CAST(total AS VARCHAR) FROM v_wx_batch JOIN fired USING (period) WHERE batch_no > b0
    UNION ALL
    SELECT period, 'DRY_RUN_DRIFT', updated_at, CAST(total_readings - baseline AS VARCHAR)
    FROM v_wx_ready JOIN fired USING (period) WHERE total_readings <> baseline""")
def dry_run_events(spark, sf_dir):
    return rules.dry_run_events(monitoring.weather_batches(tables.weather(spark, sf_dir)))


@query("""
    , r AS (SELECT strptime(par_day || par_hour, '%Y%m%d%H') AS p,
                   min(ts) FILTER (event_type = 'signup') AS a, min(ts) FILTER (event_type = 'click') AS b,
                   min(ts) FILTER (event_type = 'view') AS c, min(ts) FILTER (event_type = 'purchase') AS d
            FROM v_evt GROUP BY ALL),
    f1 AS (SELECT *, a + INTERVAL 2 MINUTE AS fa FROM r),
    f2 AS (SELECT *, CASE WHEN b IS NOT NULL AND fa IS NOT NULL THEN greatest(b, fa) + INTERVAL 5 MINUTE END AS fb FROM f1),
    f3 AS (SELECT *, CASE WHEN c IS NOT NULL AND fb IS NOT NULL THEN greatest(c, fb) + INTERVAL 2 MINUTE END AS fc FROM f2),
    f4 AS (SELECT *, CASE WHEN d IS NOT NULL AND fc IS NOT NULL THEN greatest(d, fc) + INTERVAL 1 MINUTE END AS fd FROM f3),
    l AS (SELECT p, 'ml-data-prep' AS job, fa AS finish_at, 10 AS m, false AS held FROM f4
          UNION ALL SELECT p, 'ml-training', fb, 30, b IS NOT NULL AND (fa IS NULL OR fa > b) FROM f4
          UNION ALL SELECT p, 'ml-evaluation', fc, 40, c IS NOT NULL AND (fb IS NULL OR fb > c) FROM f4
          UNION ALL SELECT p, 'ml-deployment', fd, 50, d IS NOT NULL AND (fc IS NULL OR fc > d) FROM f4)
    SELECT p AS period_start, job, finish_at, p + to_minutes(m) AS deadline_at,
           coalesce(finish_at > p + to_minutes(m), true) AS missed, held AS held_up_by_upstream FROM l""")
def sla_cascade(spark, sf_dir):
    """Each link's input is the hour's first event of a type."""
    first = lambda kind, job: F.min(F.when(F.col("event_type") == kind, F.col("ts"))).alias(job)
    ready = tables.events(spark, sf_dir).groupBy(period_start("par_day", "par_hour").alias("period_start")).agg(
        first("signup", "ml-data-prep"), first("click", "ml-training"), first("view", "ml-evaluation"), first("purchase", "ml-deployment")
    )
    return rules.cascade(ready)
