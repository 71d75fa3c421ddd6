"""Machines, transactions, weather, features, places and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pingline.catalog.control import gated_models
from pingline.catalog.registry import query
from pingline.functions.columns import credit_label, floor_window, haversine_km, par_day, par_hour, time_of_micros, tower_id
from pingline.schemas import FEATURE_COLUMNS
from pingline.operators import calendar, features, lookup, monitoring, quality
from pingline.session import scratch_path
from pingline.sources import bronze, feeds, tables

# ---- machines -----------------------------------------------------------


@query("SELECT * FROM v_machine")
def iot_machine_status(spark, sf_dir):
    return monitoring.machine_status(tables.machine_readings(spark, sf_dir), ["par_day", "par_hour"], digits=9)


@query("SELECT * FROM v_factory")
def iot_factory_health(spark, sf_dir):
    hourly = monitoring.machine_status(tables.machine_readings(spark, sf_dir), ["par_day", "par_hour"])
    return monitoring.factory_health(monitoring.latest_status(hourly, ["par_day"]), ["par_day"])


@query("""
    , r AS (SELECT par_day, par_hour, machine_id, CASE WHEN k % 20 = 0 THEN 0 ELSE temperature END AS t, vibration AS v, pressure AS p FROM v_iot),
    c AS (SELECT strftime(g.h, '%Y%m%d') AS par_day, strftime(g.h, '%H') AS par_hour
          FROM (SELECT unnest(generate_series(date_trunc('hour', (SELECT min(ts) FROM events)),
                                              date_trunc('hour', (SELECT max(ts) FROM events)), INTERVAL 1 HOUR)) AS h) g)
    SELECT c.par_day, c.par_hour, count(r.machine_id) AS total_readings, count(DISTINCT r.machine_id) AS machine_count,
           round(coalesce(avg(t), 0), 9) AS avg_temperature, round(coalesce(avg(v), 0), 9) AS avg_vibration,
           round(coalesce(avg(p), 0), 9) AS avg_pressure, round(max(t), 9) AS max_temperature,
           round(max(v), 9) AS max_vibration, round(min(p), 9) AS min_pressure
    FROM c LEFT JOIN r USING (par_day, par_hour) GROUP BY ALL""")
def iot_hour_summary(spark, sf_dir):
    """Some temperatures are missing; every hour of the calendar gets a row."""
    readings = tables.machine_readings(spark, sf_dir)
    span = calendar.span_of(readings, "updated_at")
    hours = calendar.calendar(span, 3600).select(par_day("window_start").alias("par_day"), par_hour("window_start").alias("par_hour"))
    gappy = readings.withColumn("temperature", F.when(F.col("k") % 20 != 0, F.col("temperature")))
    return monitoring.factory_hours(gappy, hours, ["par_day", "par_hour"], digits=9)


@query("""
    SELECT machine_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS timestamp, temperature, vibration, pressure FROM v_iot""")
def src_machine_jsonl(spark, sf_dir):
    """Readings through JSON lines and back."""
    path = scratch_path(spark, "machine-lines")
    at = F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("timestamp")
    tables.machine_readings(spark, sf_dir).select("machine_id", at, *monitoring.MEASURES).write.json(path)
    return feeds.machine_readings(spark, path).drop("environment")


@query("""
    SELECT station_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, round(quality, 6) AS quality FROM v_wx""")
def src_weather_array(spark, sf_dir):
    """Readings through files that each hold one JSON array, as the feed delivers an hour."""
    path = scratch_path(spark, "weather-arrays")
    item = F.struct("station_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), F.round("quality", 6).alias("quality"))
    hours = tables.weather(spark, sf_dir).groupBy("period").agg(F.collect_list(item).alias("items"))
    hours.select(F.to_json("items").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return feeds.weather_arrays(spark, path).select("station_id", "timestamp", "quality")


@query("""
    SELECT model_version, CAST(s_suppkey % 20 AS VARCHAR) AS loss, coalesce(md5(s_name), '') AS weights_hash
    FROM supplier JOIN v_model ON s_suppkey = run_no""")
def src_model_artifacts(spark, sf_dir):
    """Artifacts through JSON and back; metrics stay text."""
    path = scratch_path(spark, "artifacts")
    suppliers = tables.table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    suppliers.select(F.concat(F.lit("v1.0."), key).alias("model_version"), (key % 20).alias("loss"), F.md5("s_name").alias("weights_hash")).write.json(path)
    return feeds.model_artifacts(spark, path).select("model_version", "loss", "weights_hash")


# ---- transactions -------------------------------------------------------


@query("SELECT * FROM v_bank_batch")
def bank_lag(spark, sf_dir):
    """From JSON payloads, as a stream carries them."""
    body = F.struct("transaction_id", "account_id", "type", "amount", F.col("ts").cast("string").alias("timestamp"))
    payloads = tables.transactions(spark, sf_dir).select("batch_id", F.to_json(body).alias("payload"))
    return monitoring.batch_lag(feeds.parse_transactions(payloads), ["batch_id"])


@query("""
    SELECT strftime(processed_at, '%Y-%m-%d') AS date, count(*) AS batch_count,
           CAST(sum(CASE WHEN batch_id % 9 = 0 THEN 0 ELSE transactions END) AS BIGINT) AS total_transactions
    FROM v_bank_batch GROUP BY 1""")
def bank_daily_summary(spark, sf_dir):
    """Summaries of all batches stored as JSON by day and read back; some lack the count."""
    batches = monitoring.batch_lag(tables.transactions(spark, sf_dir), ["batch_id"]).select(
        "batch_id",
        F.when(F.col("batch_id") % 9 != 0, F.col("transactions")).alias("count"),
        F.col("oldest").cast("string").alias("oldest"),
        F.date_format("processed_at", "yyyy-MM-dd").alias("date"),
    )
    path = scratch_path(spark, "bank-batches")
    feeds.write_batch_summaries(batches, path)
    return monitoring.daily_summary(feeds.batch_summaries(spark, path))


# ---- weather ------------------------------------------------------------


@query("""
    SELECT r.*, total_readings >= 12 AND valid_readings / total_readings >= 0.75 AS ready_now, l.period IS NOT NULL AS complete
    FROM v_wx_ready r LEFT JOIN v_wx_latch l USING (period)""")
def weather_ready(spark, sf_dir):
    state = monitoring.weather_ready(monitoring.weather_batches(tables.weather(spark, sf_dir)))
    return state.withColumn("ready_now", monitoring.ready("total_readings", "valid_readings"))


@query("SELECT * FROM v_wx_latch")
def weather_ready_latch(spark, sf_dir):
    return monitoring.weather_latch(monitoring.weather_batches(tables.weather(spark, sf_dir)))


@query("SELECT period, total_readings FROM v_wx_ready")
def weather_audit(spark, sf_dir):
    return tables.weather(spark, sf_dir).groupBy("period").agg(F.count(F.lit(1)).alias("total_readings"))


# ---- features -----------------------------------------------------------


def labelled(spark, sf_dir):
    label = credit_label("credit_score", "income", "debt_ratio", "employment_years")
    return tables.features(spark, sf_dir).withColumn("label", label)


@query("SELECT row_id, label FROM v_label")
def ml_label_rule(spark, sf_dir):
    return labelled(spark, sf_dir).select("row_id", "label")


@query("SELECT * FROM v_norm")
def ml_normalize(spark, sf_dir):
    return features.normalize(labelled(spark, sf_dir), ["row_id"])


_SPLIT = """SELECT row_id, CASE WHEN row_number() OVER (ORDER BY row_id) <= floor((SELECT count(*) FROM v_ml) * 0.8::DOUBLE)
                                THEN 'train' ELSE 'test' END AS split FROM v_ml"""


@query(_SPLIT)
def ml_split(spark, sf_dir):
    return features.positional_split(tables.features(spark, sf_dir), "row_id").select("row_id", "split")


@query(f"SELECT split, count(*) AS n FROM ({_SPLIT}) GROUP BY split")
def ml_prep_counts(spark, sf_dir):
    """Features through CSV and back as text, scaled, split, counted."""
    path = scratch_path(spark, "features")
    feeds.write_feature_csv(labelled(spark, sf_dir), path)
    prepared = features.normalize(feeds.feature_csv(spark, path).withColumn("row_id", F.col("row_id").cast("bigint")), ["row_id"])
    return features.positional_split(prepared, "row_id").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT count(*) AS row_count,
           CAST(sum(CAST('0x' || substr(md5(concat_ws('|', c_custkey, c_name, c_mktsegment)), 1, 8) AS BIGINT)) AS BIGINT) AS fingerprint
    FROM customer""")
def ml_fingerprint(spark, sf_dir):
    return features.fingerprint(tables.table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_mktsegment"])


@query("SELECT run_no, model_version, passed, reason, accuracy_value, loss_value FROM v_gate")
def ml_quality_gate(spark, sf_dir):
    return gated_models(spark, sf_dir).drop("accuracy", "loss", "weights_hash")


@query("""
    SELECT run_no // 24 AS par_day, arg_max(model_version, run_no) AS model_version,
           arg_max(accuracy_value, run_no) AS accuracy, max(run_no) AS run_no
    FROM v_gate WHERE passed GROUP BY 1""")
def ml_promote(spark, sf_dir):
    """A run every hour; the day's last good model goes into the stored production table."""
    path = scratch_path(spark, "production")
    stored = features.deploy(gated_models(spark, sf_dir), F.floor(F.col("run_no") / 24).cast("bigint"), path)
    return stored.withColumn("par_day", F.col("par_day").cast("bigint"))


#: What the fitted model must reach on the test rows.
LEAST_ACCURACY, MOST_LOSS = 0.9, 0.3

_WHOLE = ", ".join(f"CAST(round({c} * 1000000) AS BIGINT)" for c in FEATURE_COLUMNS)


@query(f"""
    , rows AS (SELECT split, CAST('0x' || substr(md5(concat_ws('|', {_WHOLE})), 1, 8) AS BIGINT) AS print
               FROM v_norm JOIN ({_SPLIT}) USING (row_id))
    SELECT 'v1.0' AS model_version, count_if(split = 'test') AS test_rows, count_if(split = 'train') AS training_rows,
           CAST(sum(print) FILTER (split = 'train') AS VARCHAR) AS weights_hash, true AS accurate, true AS low_loss FROM rows""")
def ml_train(spark, sf_dir):
    """Row counts and fingerprint exactly; accuracy and loss within their bounds."""
    out = _trained(spark, sf_dir)
    return out.select("model_version", "test_rows", "training_rows", "weights_hash",
                      (F.col("accuracy") >= LEAST_ACCURACY).alias("accurate"), (F.col("loss") <= MOST_LOSS).alias("low_loss"))


def _trained(spark, sf_dir):
    prepared = features.normalize(labelled(spark, sf_dir), ["row_id"])
    path = scratch_path(spark, "prepared")
    bronze.write_partitioned(features.positional_split(prepared, "row_id"), path, ["split"], "overwrite")
    return features.train(spark.read.parquet(path))


# ---- places -------------------------------------------------------------


@query("""
    SELECT tower_id, round(2 * 6371.0::DOUBLE * atan2(sqrt(a), sqrt(1 - a)), 6) AS centre_km
    FROM (SELECT tower_id, power(sin(radians(clat - lat) / 2), 2)
                 + cos(radians(lat)) * cos(radians(clat)) * power(sin(radians(clon - lon) / 2), 2) AS a
          FROM v_tower JOIN (SELECT city, avg(lat) AS clat, avg(lon) AS clon FROM v_tower GROUP BY city) USING (city))""")
def geo_haversine(spark, sf_dir):
    """Distance of every tower to the middle of its city."""
    towers = tables.towers(spark, sf_dir)
    centres = towers.groupBy("city").agg(F.avg("lat").alias("clat"), F.avg("lon").alias("clon"))
    return towers.join(centres, "city").select("tower_id", F.round(haversine_km("lat", "lon", "clat", "clon"), 6).alias("centre_km"))


@query("""
    SELECT tower_no, substr(md5(CAST(floor(lat * 10000) / 10000 AS VARCHAR) || ',' || CAST(floor(lon * 10000) / 10000 AS VARCHAR)), 1, 8) AS place_id FROM v_tower""")
def geo_tower_id(spark, sf_dir):
    four = lambda c: F.floor(F.col(c) * 10000) / 10000
    return tables.towers(spark, sf_dir).select("tower_no", tower_id(four("lat"), four("lon")).alias("place_id"))


@query("""
    , d AS (SELECT a.tower_id, b.tower_id AS neighbor_id,
                   power(sin(radians(b.lat - a.lat) / 2), 2)
                   + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin(radians(b.lon - a.lon) / 2), 2) AS x
            FROM v_tower a JOIN v_tower b ON a.tower_id <> b.tower_id),
    n AS (SELECT tower_id, neighbor_id, 2 * 6371.0::DOUBLE * atan2(sqrt(x), sqrt(1 - x)) AS km FROM d),
    o AS (SELECT *, row_number() OVER (PARTITION BY tower_id ORDER BY km, neighbor_id) AS rank FROM n)
    SELECT tower_id, CAST(rank AS INT) AS rank, neighbor_id, round(km, 6) AS distance_km
    FROM o WHERE rank <= 3 OR rank <= 5 AND km <= 10""")
def geo_knn(spark, sf_dir):
    out = lookup.nearest_neighbours(tables.towers(spark, sf_dir))
    return out.withColumn("distance_km", F.round("distance_km", 6))


@query("""
    SELECT city, tower_id, count(*) OVER (PARTITION BY city) AS towers_in_city FROM v_tower""")
def geo_city_index(spark, sf_dir):
    return lookup.city_index(tables.towers(spark, sf_dir))


@query("""
    SELECT l_orderkey, l_partkey, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def dq_unique_key(spark, sf_dir):
    return quality.repeated_keys(tables.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@query("""
    , p AS (SELECT user_id, ts, concat('T', k % 20) AS tower FROM v_evt WHERE event_type = 'signup'),
    f AS (SELECT user_id, arg_min(tower, ts) AS first_tower FROM p GROUP BY 1)
    SELECT e.event_id, coalesce(p.tower, f.first_tower) AS tower_in_force
    FROM v_evt e ASOF LEFT JOIN p ON p.user_id = e.user_id AND p.ts <= e.ts
    LEFT JOIN f ON f.user_id = e.user_id WHERE e.event_type <> 'signup'""")
def asof_tower(spark, sf_dir):
    found = lookup.as_of(tables.handoffs(spark, sf_dir), ["user_id"], ["ts", "event_id"], "tower", "tower_in_force")
    return found.filter(F.col("tower").isNull()).select("event_id", "tower_in_force")


@query("""
    , w AS (SELECT p_partkey + 1 AS rank, 'www.p' || p_partkey || '.com' AS host_name,
                   CAST(1 / power(p_partkey + 1, 0.8) AS DECIMAL(28,18)) AS w FROM part),
    s AS (SELECT rank, host_name, CASE WHEN rank = max(rank) OVER () THEN 1.0 ELSE CAST(sum(w) OVER (ORDER BY rank) AS DOUBLE) / CAST(sum(w) OVER () AS DOUBLE) END AS hi FROM w),
    i AS (SELECT rank, host_name, hi, coalesce(lag(hi) OVER (ORDER BY rank), -1) AS lo FROM s),
    e AS (SELECT event_id, ((event_id * 7919) % 10007) / 10007.0::DOUBLE AS u FROM v_evt)
    SELECT event_id, rank, host_name FROM e JOIN i ON u > lo AND u <= hi""")
def weighted_range_join(spark, sf_dir):
    """A site for every event, by a number in [0, 1) made from its id."""
    probes = tables.table(spark, sf_dir, "events").select("event_id", ((F.col("event_id") * 7919 % 10007) / F.lit(10007.0)).alias("u"))
    shares = lookup.cumulative_shares(tables.sites(spark, sf_dir))
    return lookup.weighted_pick(probes, shares).select("event_id", "rank", "host_name")


# ---- windows and sessions -----------------------------------------------


@query("SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, count(*) AS n FROM events GROUP BY 1")
def window_15min(spark, sf_dir):
    return tables.table(spark, sf_dir, "events").groupBy(floor_window("ts").alias("window_start")).agg(F.count(F.lit(1)).alias("n"))


@query("""
    , c AS (SELECT unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, (SELECT min(ts) FROM events)),
                                          (SELECT max(ts) FROM events), INTERVAL 15 MINUTE)) AS window_start)
    SELECT window_start, s.stream, coalesce(n, 0) AS n FROM c CROSS JOIN (VALUES ('cdr'), ('seq')) s(stream)
    LEFT JOIN (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, stream, count(*) AS n FROM v_deliv GROUP BY ALL)
    USING (window_start, stream)""")
def window_calendar(spark, sf_dir):
    """Windows of both streams over the whole span, with what each holds."""
    rows = tables.deliveries(spark, sf_dir)
    held = rows.groupBy(floor_window("ts").alias("window_start"), "stream").agg(F.count(F.lit(1)).alias("n"))
    slots = calendar.calendar(calendar.span_of(rows), streams=calendar.STREAMS)
    return slots.join(held, ["window_start", "stream"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("""
    SELECT session_id, count(*) AS pings, min(time) AS first_ping, max(time) AS last_ping FROM v_ping GROUP BY 1""")
def ping_explode(spark, sf_dir):
    pings = calendar.explode_pings(tables.sessions(spark, sf_dir))
    per_session = pings.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("pings"), F.min("time_us").alias("first"), F.max("time_us").alias("last")
    )
    return per_session.select("session_id", "pings", time_of_micros("first").alias("first_ping"), time_of_micros("last").alias("last_ping"))


@query("""
    SELECT time_bucket(INTERVAL 15 MINUTE, time) AS window_start, count(*) AS pings,
           count_if(time_bucket(INTERVAL 15 MINUTE, start_ts) < time_bucket(INTERVAL 15 MINUTE, time)) AS spilled_pings
    FROM v_ping GROUP BY 1""")
def ping_window_clip(spark, sf_dir):
    """Pings by the window they fall in, with those of sessions begun in an earlier one."""
    pings = calendar.explode_pings(tables.sessions(spark, sf_dir))
    return calendar.window_totals(calendar.assign_windows(pings))
