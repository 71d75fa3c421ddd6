"""The streaming jobs run over what is there, then read their output."""

from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from pingline.catalog.detectors import period_end
from pingline.catalog.ingest import GLOB, SALT, raw_folder
from pingline.catalog.registry import query
from pingline.functions.columns import epoch_micros, time_of_millis
from pingline.operators import monitoring
from pingline.session import scratch_path
from pingline.sources import bronze, feeds, records, tables
from pingline.streaming import isolate, jobs, keyed
from pingline.streaming.corrections import CorrectedWindows
from pingline.streaming.seen import SeenKeys
from pingline.streaming.tiers import Tiers, tiered


def paths(spark, name):
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"


def keyed_events(spark, sf_dir):
    return tables.with_keys(jobs.event_stream(spark, sf_dir))


def in_order(spark, rows, slot, files_per_trigger):
    """A stream of ``rows`` in the order of ``slot``: one file per slot, read oldest first."""
    path = scratch_path(spark, "in-order")
    rows.withColumn("slot", slot).repartition("slot").write.partitionBy("slot").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in files.globStatus(hadoop.Path(f"{path}/*/*.parquet"))]
    for i, file in enumerate(sorted(found, key=lambda f: f.getParent().getName())):
        files.setTimes(file, 1_600_000_000_000 + i * 1000, -1)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return jobs.with_zone(stream)


@query("""
    SELECT phone_hash_out, phone_hash_in, cell_tower, date_trunc('second', time) AS time, par_day, par_hour FROM v_bcdr""")
def stream_bronze(spark, sf_dir):
    out = _ingested(spark, sf_dir, "cdr", tables.calls, 300)
    return jobs.read_batches(spark, f"{out}/bronze").drop("batch")


@query("""
    SELECT phone_hash, cell_tower, host_name, site_name, date_trunc('second', time) AS time, par_day, par_hour FROM v_bseq""")
def stream_bronze_seq(spark, sf_dir):
    out = _ingested(spark, sf_dir, "seq", tables.browses, 1000)
    return jobs.read_batches(spark, f"{out}/bronze").drop("batch")


@query("""
    SELECT phone, sha256('salt' || phone) AS hash
    FROM (SELECT phone_out AS phone FROM v_cdr UNION SELECT phone_in FROM v_cdr) ANTI JOIN v_dim USING (phone)""")
def stream_new_phones(spark, sf_dir):
    """What the ingest of calls inserts into the dimension."""
    return jobs.inserted_phones(spark, _ingested(spark, sf_dir, "cdr", tables.calls, 1000)).drop("created_at")


def _ingested(spark, sf_dir, stream, pings, files):
    folder = raw_folder(spark, pings(spark, sf_dir).drop("par_day", "par_hour"), stream)
    out, checkpoint = paths(spark, f"stream-bronze-{stream}")
    raw = jobs.raw_stream(spark, folder, stream, GLOB, files=files)
    jobs.bronze_ingest(raw, tables.phone_dimension(spark, sf_dir), SALT, out, checkpoint, stream)
    return out


def delivered(spark, sf_dir):
    """The event stream with its stream and quarter-hour file."""
    file_no = F.floor(F.minute("ts") / 15).cast("int")
    return jobs.event_stream(spark, sf_dir).select(tables.stream_of().alias("stream"), file_no.alias("file_no"), "ts")


@query("""
    SELECT stream, par_day, par_hour, CAST(sum(records) AS BIGINT) AS records, count(*) AS files, max(arrived_at) AS updated_at
    FROM v_files GROUP BY ALL""")
def stream_hourly_counts(spark, sf_dir):
    out, checkpoint = paths(spark, "stream-hours")
    parts = Tiers(spark, out, jobs.merged_hours)
    jobs.run_available(delivered(spark, sf_dir), tiered(parts, jobs.hourly_parts), checkpoint)
    return jobs.hours_of(parts.read())


@query("SELECT * FROM v_daily")
def stream_daily_hours(spark, sf_dir):
    event = F.col("event_type")
    job = F.when(event.isin("view", "click"), "silver-seq-hour").when(event == "error", "bronze-cdr").otherwise("silver-cdr-hour")
    date = F.when(F.col("k") == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH"))
    done = keyed_events(spark, sf_dir).select(job.alias("pipelineId"), date.alias("date"), "ts")
    out, checkpoint = paths(spark, "stream-days")
    parts = Tiers(spark, out, jobs.merged_days)
    jobs.run_available(done, tiered(parts, jobs.daily_parts), checkpoint)
    days = jobs.days_of(parts.read())
    return days.withColumn("completed_hours", F.array_join("completed_hours", ","))


@query("""
    SELECT par_day, count(*) AS transactions, min(ts) AS oldest, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS lag_seconds,
           hour(max(ts)) > 17 AS cob_complete FROM v_evt GROUP BY 1""")
def stream_bank_lag(spark, sf_dir):
    """JSON payloads on a stream, summed up per micro-batch; the summaries folded into days."""
    body = F.struct(F.col("event_id").alias("transaction_id"), F.col("event_type").alias("type"), F.col("value").alias("amount"),
                    F.col("ts").cast("string").alias("timestamp"))
    parsed = feeds.parse_transactions(jobs.event_stream(spark, sf_dir).select(F.to_json(body).alias("payload")))
    out, checkpoint = paths(spark, "stream-bank")
    jobs.transaction_batches(parsed, out, checkpoint)
    days = jobs.read_batches(spark, out).groupBy("par_day").agg(
        F.sum("transactions").alias("transactions"), F.min("oldest").alias("oldest"), F.max("processed_at").alias("newest")
    )
    lag = F.floor((epoch_micros("newest") - epoch_micros("oldest")) / 1_000_000).cast("bigint")
    return days.select("par_day", "transactions", "oldest", lag.alias("lag_seconds"), monitoring.cob_complete("newest").alias("cob_complete"))


@query("SELECT batch_id, transactions, oldest, lag_seconds, cob_complete FROM v_bank_batch")
def stream_inline_batches(spark, sf_dir):
    """Transactions as inline records of a log, consumed in batches of a hundred."""
    body = F.struct(F.col("event_id").alias("transaction_id"), F.col("event_type").alias("type"), F.col("value").alias("amount"),
                    F.col("ts").cast("string").alias("timestamp"))
    base = scratch_path(spark, "inline")
    records.append_records(tables.table(spark, sf_dir, "events").sort("event_id").select(F.to_json(body).alias("payload")), f"{base}/log")
    parsed = feeds.parse_transactions(records.record_stream(spark, f"{base}/log"))
    jobs.run_available(parsed, jobs.batch_writer(f"{base}/out", lambda df: monitoring.batch_lag(df, ["batch"]), "micro"), f"{base}/checkpoint")
    # a batch that two micro-batches share is one batch
    whole = jobs.read_batches(spark, f"{base}/out", "micro").groupBy(F.col("batch").alias("batch_id")).agg(
        F.sum("transactions").alias("transactions"), F.min("oldest").alias("oldest"), F.max("processed_at").alias("newest"))
    lag = F.floor((epoch_micros("newest") - epoch_micros("oldest")) / 1_000_000).cast("bigint")
    return whole.select("batch_id", "transactions", "oldest", lag.alias("lag_seconds"), monitoring.cob_complete("newest").alias("cob_complete"))


@query("SELECT * FROM v_wx_latch")
def stream_latch(spark, sf_dir):
    out, checkpoint = paths(spark, "stream-latch")
    parts = Tiers(spark, out, jobs.weather_of_parts)
    jobs.run_available(tables.weather_of(keyed_events(spark, sf_dir)), tiered(parts, jobs.weather_parts), checkpoint)
    return monitoring.weather_latch(parts.total())


@query("SELECT period, batch_no, latched_at, total_then FROM v_wx_latch")
def stream_latch_once(spark, sf_dir):
    """The latch as keyed state, over readings that arrive day by day."""
    readings = tables.weather(spark, sf_dir).select("period", "batch_no", "quality", "ts")
    out, checkpoint = paths(spark, "stream-latch-once")
    jobs.append_available(keyed.weather_latch(in_order(spark, readings, F.substring("period", 1, 8), 6)), out, checkpoint)
    return spark.read.parquet(out).select("period", "batch_no", "latched_at", "total_then")


WINDOW_KEYS = {"stream": "string"}


@query("""
    SELECT stream, window_start, records, CAST(round_even(CASE stream WHEN 'cdr' THEN 100000000 ELSE 500000000 END * weight
                                                          / (SELECT sum(weight) FROM v_weights), 0) AS BIGINT) AS expected
    FROM (SELECT stream, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, count(*) AS records FROM v_deliv GROUP BY ALL)
    JOIN v_weights ON window_no = hour(window_start) * 4 + minute(window_start) // 15
    WHERE window_start + INTERVAL 15 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_window_volume(spark, sf_dir):
    """Windows the watermark has closed, late rows folded in, beside the volume expected of them."""
    out, checkpoint = paths(spark, "stream-windows")
    windows = CorrectedWindows(spark, out, WINDOW_KEYS)
    jobs.run_available(delivered(spark, sf_dir), windows.on_batch, checkpoint)
    return jobs.with_expected(windows.current().drop("revision"))


SLOTS_PER_BATCH = 20  # of six hours


@query(f"""
    , a AS (SELECT CASE WHEN event_type IN ('view', 'click') THEN 'seq' ELSE 'cdr' END AS stream, ts,
                   epoch_us(ts + CASE WHEN k % 10 = 0 THEN INTERVAL 100 MINUTE ELSE INTERVAL 5 MINUTE END) // 21600000000 AS slot FROM v_evt),
    n AS (SELECT *, (dense_rank() OVER (ORDER BY slot) - 1) // {SLOTS_PER_BATCH} AS batch FROM a),
    m AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch) - INTERVAL 10 MINUTE AS mark FROM n GROUP BY batch),
    c AS (SELECT stream, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, batch, count(*) AS change FROM n GROUP BY ALL),
    l AS (SELECT c.*, p.mark IS NOT NULL AND window_start + INTERVAL 15 MINUTE <= p.mark AS late,
                 sum(change) OVER (PARTITION BY stream, window_start ORDER BY c.batch)::BIGINT AS records
          FROM c LEFT JOIN m p ON p.batch = c.batch - 1)
    SELECT stream, window_start, CAST(row_number() OVER (PARTITION BY stream, window_start ORDER BY batch) AS INT) AS revision,
           records, change, batch FROM l WHERE late""")
def stream_window_corrections(spark, sf_dir):
    """Every tenth value of ``k`` arrives 100 minutes late: the windows its rows change after
    they were written, with each revision."""
    delay = F.make_dt_interval(mins=F.when(F.col("k") % 10 == 0, 100).otherwise(5))
    rows = tables.events(spark, sf_dir).select(tables.stream_of().alias("stream"), "ts", (F.col("ts") + delay).alias("arrived_at"))
    arrivals = in_order(spark, rows, F.floor(epoch_micros("arrived_at") / 21_600_000_000), SLOTS_PER_BATCH)
    out, checkpoint = paths(spark, "stream-corrections")
    windows = CorrectedWindows(spark, out, WINDOW_KEYS)
    jobs.run_available(arrivals, windows.on_batch, checkpoint)
    return windows.corrections()


@query("""
    , c AS (SELECT unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, (SELECT min(ts) FROM events)),
                                          (SELECT max(ts) FROM events), INTERVAL 15 MINUTE)) AS window_start)
    SELECT s.stream, window_start FROM c CROSS JOIN (VALUES ('cdr'), ('seq')) s(stream)
    ANTI JOIN (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, stream FROM v_deliv) USING (window_start, stream)
    WHERE epoch_ms(window_start + INTERVAL 15 MINUTE) <= (SELECT epoch_ms(max(ts)) - 600000 FROM events)""")
def stream_absent_windows(spark, sf_dir):
    """Windows without a row, reported by a timer once the watermark has passed them."""
    rows = tables.deliveries(spark, sf_dir).select("stream", "ts", "par_day")
    since = rows.agg(F.min(epoch_micros("ts"))).first()[0] or 0
    out, checkpoint = paths(spark, "stream-absent")
    stream = in_order(spark, rows, F.col("par_day"), 6)
    jobs.append_available(keyed.absent_windows(stream, "stream", ["cdr", "seq"], since), out, checkpoint)
    return spark.read.parquet(out)


@query("""
    SELECT d.event_id, d.pipelineId, d.time AS ts FROM v_log d WHERE d.eventType = 'JOB_COMPLETED' AND NOT EXISTS (
        SELECT 1 FROM v_log u WHERE u.eventType = 'JOB_TRIGGERED' AND u.pipelineId = d.pipelineId
        AND u.time > d.time AND u.time <= d.time + INTERVAL 30 MINUTE)
    AND epoch_us(d.time) + 1800000000 <= (
        SELECT (epoch_ms(max(time)) - 600000) * 1000 FROM v_log WHERE eventType IN ('JOB_COMPLETED', 'JOB_TRIGGERED'))""")
def stream_stale_trigger(spark, sf_dir):
    """Completions no trigger followed, reported by a timer at their deadline."""
    log = tables.event_log(spark, sf_dir).select("event_id", "pipelineId", "eventType", time_of_millis("timestamp").alias("ts"), "date")
    out, checkpoint = paths(spark, "stream-stale")
    stream = in_order(spark, log, F.col("date"), 6)
    stale = keyed.unanswered(stream, "pipelineId", F.col("eventType") == "JOB_COMPLETED", F.col("eventType") == "JOB_TRIGGERED", 1800)
    jobs.append_available(stale, out, checkpoint)
    return spark.read.parquet(out)


@query("""
    SELECT event_id, par_day, par_hour, arrived_at, (epoch_us(arrived_at) - epoch_us(period_end)) // 1000000 AS late_seconds
    FROM v_arrive WHERE arrived_at > period_end + INTERVAL 30 MINUTE""")
def stream_late(spark, sf_dir):
    delay = F.make_dt_interval(mins=F.when(F.col("k") % 10 == 0, 100).otherwise(5))
    events = keyed_events(spark, sf_dir).select("event_id", "par_day", "par_hour", "ts", (F.col("ts") + delay).alias("arrived_at"))
    out, checkpoint = paths(spark, "stream-late")
    jobs.split_late(events, "arrived_at", period_end(), 1800, out, checkpoint)
    return jobs.read_batches(spark, f"{out}/late").drop("batch", "ts")


@query("SELECT event_id, ts, user_id, event_type FROM v_evt")
def stream_dedup(spark, sf_dir):
    """The stream delivered twice."""
    once = jobs.event_stream(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    out, checkpoint = paths(spark, "stream-dedup")
    seen = SeenKeys(spark, out, ["event_id"])
    jobs.run_available(once.unionByName(once), seen.on_batch, checkpoint)
    return seen.rows()


POISON_DAY, POISON_HOUR = "4", "13"  # the last digit of a day, and an hour


def _isolated(spark, sf_dir):
    """Calls as raw files, with a truncated file in one hour of every tenth day, ingested."""
    folder = raw_folder(spark, tables.calls(spark, sf_dir).drop("par_day", "par_hour"), "cdr")
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    whole = gzip.compress(b'{"phone_out": "1", "phone_in": "2", "cell_tower": "T", "time": "2024-01-01T00:00:00Z"}\n' * 50)
    for hour in files.globStatus(hadoop.Path(f"{folder}/par_day=*{POISON_DAY}/par_hour={POISON_HOUR}")):
        out = files.create(hadoop.Path(hour.getPath(), "truncated.json.gz"), True)
        out.write(whole[: len(whole) - 12])
        out.close()
    out, checkpoint = paths(spark, "stream-isolated")
    store, probe = jobs.ping_files(tables.phone_dimension(spark, sf_dir), SALT)
    jobs.run_available(isolate.notifications(spark, folder, GLOB, 300), isolate.isolating(out, store, probe), checkpoint)
    return out


@query("""
    SELECT phone_hash_out, phone_hash_in, cell_tower, date_trunc('second', time) AS time, par_day, par_hour FROM v_bcdr""")
def stream_bronze_isolated(spark, sf_dir):
    """Unreadable files take nobody else's rows with them."""
    return spark.read.parquet(f"{_isolated(spark, sf_dir)}/bronze").drop("batch", "piece")


@query(f"""
    SELECT par_day, par_hour, 1::BIGINT AS files, 3 AS attempts FROM v_evt WHERE par_day LIKE '%{POISON_DAY}' AND par_hour = '{POISON_HOUR}' GROUP BY ALL""")
def stream_dead_letters(spark, sf_dir):
    """The unreadable files themselves."""
    dead = isolate.dead_letters(spark, _isolated(spark, sf_dir))
    parts = [F.regexp_extract("path", bronze.PERIOD_IN_PATH, i).alias(n) for i, n in ((1, "par_day"), (2, "par_hour"))]
    return dead.groupBy(*parts, "attempts").agg(F.count(F.lit(1)).alias("files"))


@query("SELECT * FROM v_factory")
def stream_factory_health(spark, sf_dir):
    out, checkpoint = paths(spark, "stream-factory")
    readings = tables.machine_readings_of(keyed_events(spark, sf_dir))
    parts = Tiers(spark, out, jobs.merged_machines)
    jobs.run_available(readings, tiered(parts, jobs.machine_parts), checkpoint)
    hours = jobs.machines_of(parts.read())
    return monitoring.factory_health(monitoring.latest_status(hours, ["par_day"]), ["par_day"])
