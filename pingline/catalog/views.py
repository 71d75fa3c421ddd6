"""The derived inputs once more, as SQL for the checking engine."""

from __future__ import annotations

import re

VIEWS = {
    "v_evt": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INT) AS k,
               strftime(ts, '%Y%m%d') AS par_day, strftime(ts, '%H') AS par_hour
        FROM events""",
    "v_dim": """
        SELECT CAST(c_custkey AS VARCHAR) AS phone,
               CASE WHEN c_nationkey < 8 THEN sha256('old' || CAST(c_custkey AS VARCHAR))
                    ELSE sha256('salt' || CAST(c_custkey AS VARCHAR)) END AS hash
        FROM customer""",
    "v_cdr": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS phone_out, concat('c', k) AS phone_in,
               event_type AS cell_tower, ts AS time, par_day, par_hour FROM v_evt""",
    "v_seq": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS phone_number, concat('T', k % 20) AS cell_tower,
               concat('www.', event_type, '.com') AS host_name, upper(event_type) AS site_name,
               ts AS time, par_day, par_hour FROM v_evt""",
    "v_bcdr": """
        SELECT coalesce(o.hash, sha256('salt' || phone_out)) AS phone_hash_out,
               coalesce(i.hash, sha256('salt' || phone_in)) AS phone_hash_in,
               cell_tower, time, par_day, par_hour
        FROM v_cdr LEFT JOIN v_dim o ON o.phone = phone_out LEFT JOIN v_dim i ON i.phone = phone_in""",
    "v_bseq": """
        SELECT coalesce(d.hash, sha256('salt' || phone_number)) AS phone_hash,
               cell_tower, host_name, site_name, time, par_day, par_hour
        FROM v_seq LEFT JOIN v_dim d ON d.phone = phone_number""",
    "v_deliv": """
        SELECT CASE WHEN event_type IN ('view', 'click') THEN 'seq' ELSE 'cdr' END AS stream,
               par_day, par_hour, CAST(minute(ts) // 15 AS INT) AS file_no, event_id, ts, k FROM v_evt""",
    "v_files": """
        SELECT stream, par_day, par_hour, file_no, count(*) AS records, max(ts) AS arrived_at
        FROM v_deliv GROUP BY ALL""",
    "v_targets": """
        SELECT stream, par_day, count(*) AS daily_target FROM v_deliv GROUP BY ALL""",
    "v_weights": """
        SELECT CAST(w.range AS INT) AS window_no,
               0.10::DOUBLE + 0.70::DOUBLE * exp(-power((w.range * 0.25::DOUBLE + 0.125::DOUBLE) - 10, 2) / 18)
                    + 0.50::DOUBLE * exp(-power((w.range * 0.25::DOUBLE + 0.125::DOUBLE) - 20, 2) / 12.5::DOUBLE) AS weight
        FROM range(96) w""",
    "v_hour_share": """
        SELECT window_no // 4 AS hour_no, sum(weight) / (SELECT sum(weight) FROM v_weights) AS share
        FROM v_weights GROUP BY 1""",
    "v_hourly": """
        SELECT c.*, CAST(round_even(daily_target * share, 0) AS BIGINT) AS expected_count
        FROM (SELECT stream, par_day, par_hour, CAST(sum(records) AS BIGINT) AS count,
                     count(*) AS files_processed, max(arrived_at) AS updated_at
              FROM v_files GROUP BY ALL) c
        JOIN v_targets USING (stream, par_day)
        JOIN v_hour_share ON hour_no = CAST(par_hour AS INT)""",
    "v_complete": """
        SELECT *, CASE WHEN expected_count > 0 THEN count / expected_count ELSE 0.0 END AS pct_of_expected,
               files_processed >= 4 AND CASE WHEN expected_count > 0 THEN count / expected_count ELSE 0.0 END >= 0.85
                   AS complete
        FROM v_hourly""",
    "v_latch": """
        SELECT stream, par_day, par_hour, min(arrived_at) AS completed_at,
               min(files_then) AS files_then, CAST(min(records_then) AS BIGINT) AS records_then
        FROM (SELECT f.*, expected_count,
                     count(*) OVER w AS files_then, sum(records) OVER w AS records_then
              FROM v_files f JOIN v_hourly h USING (stream, par_day, par_hour)
              WINDOW w AS (PARTITION BY stream, par_day, par_hour ORDER BY f.arrived_at, file_no
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        WHERE files_then >= 4 AND CASE WHEN expected_count > 0 THEN records_then / expected_count ELSE 0 END >= 0.85
        GROUP BY ALL""",
    # some counters over-counted by one, others lost
    "v_sensor": """
        SELECT stream, par_day, par_hour,
               CASE WHEN CAST(par_hour AS INT) % 8 = 7 THEN 0
                    WHEN CAST(par_hour AS INT) % 6 = 5 THEN count + 1 ELSE count END AS sensor_count
        FROM v_hourly""",
    "v_audit": """
        SELECT stream, par_day, par_hour, coalesce(sensor_count, 0) AS sensor_count,
               coalesce(stored_count, 0) AS stored_count,
               coalesce(sensor_count, 0) > 0 AND coalesce(stored_count, 0) >= coalesce(sensor_count, 0) AS match,
               CASE WHEN coalesce(sensor_count, 0) = 0 THEN 'no_sensor_data'
                    WHEN coalesce(stored_count, 0) >= sensor_count THEN 'ok' ELSE 'count_mismatch' END AS reason
        FROM v_sensor FULL JOIN (SELECT stream, par_day, par_hour, count(*) AS stored_count
                                 FROM v_deliv GROUP BY ALL) USING (stream, par_day, par_hour)""",
    "v_done": """
        SELECT CASE WHEN event_type IN ('view', 'click') THEN 'silver-seq-hour'
                    WHEN event_type = 'error' THEN 'bronze-cdr' ELSE 'silver-cdr-hour' END AS pipelineId,
               CASE WHEN k = 0 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%dT%H') END AS date
        FROM v_evt""",
    "v_daily": """
        SELECT CASE pipelineId WHEN 'silver-cdr-hour' THEN 'silver-cdr-day' ELSE 'silver-seq-day' END AS pipelineId,
               split_part(date, 'T', 1) AS par_day,
               string_agg(DISTINCT split_part(date, 'T', 2), ',' ORDER BY split_part(date, 'T', 2)) AS completed_hours,
               count(DISTINCT split_part(date, 'T', 2)) >= 24 AS all_hours_complete
        FROM v_done WHERE pipelineId IN ('silver-cdr-hour', 'silver-seq-hour') AND contains(date, 'T')
        GROUP BY 1, 2""",
    "v_iot": """
        SELECT concat('machine_', lpad(CAST(user_id % 11 + 1 AS VARCHAR), 2, '0')) AS machine_id,
               ts AS updated_at, 20 + value % 60 AS temperature, (value * 7) % 100 AS vibration,
               1 + (event_id % 90) / 10.0::DOUBLE AS pressure, par_day, par_hour, event_id, k FROM v_evt""",
    "v_iot_class": """
        SELECT *, CASE WHEN temperature >= 75 OR vibration >= 80 OR pressure <= 2 THEN 'critical'
                       WHEN temperature >= 60 OR vibration >= 50 OR pressure <= 3 THEN 'degraded'
                       ELSE 'healthy' END AS derived_status FROM v_iot""",
    "v_machine": """
        SELECT machine_id, par_day, par_hour,
               CASE WHEN avg(temperature) >= 75 OR avg(vibration) >= 80 OR avg(pressure) <= 2 THEN 'critical'
                    WHEN avg(temperature) >= 60 OR avg(vibration) >= 50 OR avg(pressure) <= 3 THEN 'degraded'
                    ELSE 'healthy' END AS status,
               round(avg(temperature), 9) AS temperature, round(avg(vibration), 9) AS vibration,
               round(avg(pressure), 9) AS pressure, count(*) AS readings_count, max(updated_at) AS updated_at
        FROM v_iot GROUP BY ALL""",
    "v_roster": """
        SELECT 'machine_' || lpad(CAST(r.range AS VARCHAR), 2, '0') AS machine_id FROM range(1, 11) r""",
    "v_factory": """
        SELECT par_day, count_if(coalesce(status, '') = 'healthy') AS healthy_count, 10 AS total,
               count_if(coalesce(status, '') = 'healthy') = 10 AS all_healthy, max(updated_at) AS updated_at
        FROM (SELECT DISTINCT par_day FROM v_machine) CROSS JOIN v_roster
        LEFT JOIN (SELECT machine_id, par_day, arg_max(status, updated_at) AS status, max(updated_at) AS updated_at
                   FROM v_machine GROUP BY ALL) USING (machine_id, par_day)
        GROUP BY par_day""",
    "v_bank": """
        SELECT event_id AS transaction_id, concat('ACCT-', 100000 + user_id) AS account_id, event_type AS type,
               value AS amount, ts, event_id // 100 AS batch_id, par_day, par_hour FROM v_evt""",
    "v_bank_batch": """
        SELECT batch_id, count(*) AS transactions, min(ts) AS oldest, max(ts) AS processed_at,
               (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS lag_seconds,
               hour(max(ts)) > 17 AS cob_complete
        FROM v_bank GROUP BY batch_id""",
    "v_wx": """
        SELECT concat('WX-', lpad(CAST(user_id % 10 + 1 AS VARCHAR), 3, '0')) AS station_id,
               0.6::DOUBLE + (k % 41) / 100.0::DOUBLE AS quality, ts,
               concat(par_day, 'T', par_hour) AS period, CAST(minute(ts) // 10 AS INT) AS batch_no FROM v_evt""",
    "v_wx_batch": """
        SELECT period, batch_no, count(*) AS total, count_if(quality >= 0.7) AS valid, max(ts) AS arrived_at
        FROM v_wx GROUP BY ALL""",
    "v_wx_ready": """
        SELECT period, CAST(sum(total) AS BIGINT) AS total_readings, CAST(sum(valid) AS BIGINT) AS valid_readings,
               count(*) AS batches_received, max(arrived_at) AS updated_at FROM v_wx_batch GROUP BY period""",
    "v_wx_run": """
        SELECT *, sum(total) OVER w AS total_then, sum(valid) OVER w AS valid_then FROM v_wx_batch
        WINDOW w AS (PARTITION BY period ORDER BY arrived_at, batch_no ROWS UNBOUNDED PRECEDING)""",
    "v_wx_latch": """
        SELECT period, batch_no, arrived_at AS latched_at, CAST(total_then AS BIGINT) AS total_then
        FROM v_wx_run WHERE total_then >= 12 AND valid_then / total_then >= 0.75
        QUALIFY row_number() OVER (PARTITION BY period ORDER BY arrived_at, batch_no) = 1""",
    "v_ml": """
        SELECT c_custkey AS row_id, 18 + c_custkey % 63 AS age, 15000 + abs(c_acctbal) * 14 AS income,
               300 + (c_custkey * 37) % 551 AS credit_score,
               least(c_custkey % 63, c_custkey % 46) AS employment_years,
               (c_custkey % 101) / 100.0::DOUBLE AS debt_ratio, 1 + c_custkey % 15 AS num_accounts FROM customer""",
    "v_label": """
        SELECT *, CASE WHEN 0.4::DOUBLE * (credit_score - 300) / 550 + 0.3::DOUBLE * least(income / 100000, 1.0)
                       + 0.2::DOUBLE * (1 - debt_ratio) + 0.1::DOUBLE * least(employment_years / 20, 1.0) >= 0.5
                       THEN 1 ELSE 0 END AS label FROM v_ml""",
    "v_norm": """
        SELECT row_id, round((age - 18.0::DOUBLE) / 62, 6) AS age, round((income - 15000.0::DOUBLE) / 135000, 6) AS income,
               round((credit_score - 300.0::DOUBLE) / 550, 6) AS credit_score,
               round((employment_years - 0.0::DOUBLE) / 45, 6) AS employment_years,
               round(debt_ratio, 6) AS debt_ratio, round((num_accounts - 1.0::DOUBLE) / 14, 6) AS num_accounts,
               CAST(label AS DOUBLE) AS label FROM v_label""",
    "v_model": """
        SELECT s_suppkey AS run_no, concat('v1.0.', s_suppkey) AS model_version,
               CASE WHEN s_suppkey % 7 = 0 AND s_suppkey % 23 <> 0 THEN NULL ELSE (90 + s_suppkey % 10) / 100.0::DOUBLE END AS accuracy,
               CASE WHEN s_suppkey % 11 = 0 AND s_suppkey % 19 <> 0 THEN 'NaN'::DOUBLE ELSE (s_suppkey % 20) / 100.0::DOUBLE END AS loss,
               s_suppkey % 23 = 0 AS odd_accuracy, s_suppkey % 19 = 0 AS odd_loss,
               CASE WHEN s_suppkey % 13 = 0 THEN '' ELSE md5(s_name) END AS weights_hash FROM supplier""",
    "v_gate": """
        SELECT run_no, model_version, reason = 'all checks passed' AS passed, reason,
               CASE WHEN accuracy IS NULL OR odd_accuracy THEN 0 ELSE accuracy END AS accuracy_value,
               CASE WHEN isnan(loss) OR odd_loss THEN 0 ELSE loss END AS loss_value
        FROM (SELECT *, CASE WHEN accuracy IS NULL THEN 'missing required field: accuracy'
                             WHEN isnan(loss) THEN 'NaN detected in loss'
                             WHEN odd_accuracy THEN 'accuracy is not a number'
                             WHEN odd_loss THEN 'loss is not a number'
                             WHEN accuracy < 0.95 THEN printf('accuracy %.4f below threshold 0.95', accuracy)
                             WHEN loss >= 0.1 THEN printf('loss %.4f exceeds threshold 0.1', loss)
                             WHEN weights_hash = '' THEN 'missing weights_hash'
                             ELSE 'all checks passed' END AS reason FROM v_model)""",
    "v_log": """
        SELECT event_id,
               list_extract(['bronze-cdr', 'bronze-seq', 'silver-cdr-hour', 'silver-seq-hour', 'silver-cdr-day',
                             'silver-seq-day'], CAST(user_id % 6 + 1 AS INT)) AS pipelineId,
               CASE WHEN event_type = 'error' AND value >= 50 THEN 'SLA_BREACH'
                    WHEN event_type = 'error' THEN 'JOB_FAILED' WHEN event_type = 'click' THEN 'JOB_TRIGGERED'
                    WHEN event_type = 'view' THEN 'SLA_MET' WHEN event_type = 'purchase' THEN 'JOB_COMPLETED'
                    ELSE 'SLA_WARNING' END AS eventType,
               epoch_us(ts) // 1000 AS timestamp, concat('event ', event_id) AS message,
               strftime(ts, '%Y-%m-%d') AS date, 'daily' AS scheduleId,
               make_timestamp((epoch_us(ts) // 1000) * 1000) AS time, CAST(hour(ts) AS INT) AS hour
        FROM v_evt""",
    "v_tower": """
        SELECT s_suppkey AS tower_no, substr(md5(s_name), 1, 8) AS tower_id, 35 + s_acctbal / 12000 AS lat,
               -100 + (s_suppkey % 25) * 0.05::DOUBLE AS lon, n_name AS city
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "v_sess": """
        SELECT o_orderkey AS session_id,
               o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INT)) AS start_ts,
               CAST(10 + o_orderkey % 890 AS INT) AS duration_s FROM orders""",
    "v_ping": """
        SELECT session_id, start_ts, p.range AS ping_no, start_ts + to_seconds(p.range * 10) AS time
        FROM v_sess, range(greatest(1, duration_s // 10)) p""",
    "v_arrive": """
        SELECT event_id, par_day, par_hour, ts,
               ts + to_minutes(CASE WHEN k % 10 = 0 THEN 100 ELSE 5 END) AS arrived_at,
               strptime(par_day || par_hour, '%Y%m%d%H') + INTERVAL 1 HOUR AS period_end,
               CASE WHEN event_type IN ('view', 'click') THEN 'seq' ELSE 'cdr' END AS stream FROM v_evt""",
    # rule inputs: calm machines on days of the newest day's parity, transactions in pairs, runs
    "v_calm_factory": """
        SELECT par_day, count_if(coalesce(status, '') = 'healthy') AS healthy_count, 10 AS total,
               count_if(coalesce(status, '') = 'healthy') = 10 AS all_healthy, max(updated_at) AS updated_at
        FROM (SELECT DISTINCT par_day FROM v_evt) CROSS JOIN v_roster LEFT JOIN (
            SELECT machine_id, par_day, arg_max(status, updated_at) AS status, max(updated_at) AS updated_at FROM (
                SELECT machine_id, par_day, par_hour, max(updated_at) AS updated_at,
                       CASE WHEN CAST(par_day AS INT) % 2 = any_value(parity) THEN 'healthy'
                            WHEN avg(temperature) >= 75 OR avg(vibration) >= 80 OR avg(pressure) <= 2 THEN 'critical'
                            WHEN avg(temperature) >= 60 OR avg(vibration) >= 50 OR avg(pressure) <= 3 THEN 'degraded'
                            ELSE 'healthy' END AS status
                FROM v_iot, (SELECT CAST(max(par_day) AS INT) % 2 AS parity FROM v_evt) GROUP BY machine_id, par_day, par_hour)
            GROUP BY machine_id, par_day) USING (machine_id, par_day)
        GROUP BY par_day""",
    "v_pairs": """
        SELECT event_id // 2 AS batch_id, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS lag_seconds,
               hour(max(ts)) > 17 AS cob_complete FROM v_evt GROUP BY 1""",
    "v_runs": """
        SELECT run_no, s.* FROM (
            SELECT g.*, m.weights_hash, (SELECT max(ts) FROM events) AS now FROM v_gate g JOIN v_model m USING (run_no)) g,
        LATERAL (VALUES
            ('data-prep', 'raw_features', 'updated_at', NULL::DOUBLE, now - to_hours(CAST(run_no % 4 AS INT))),
            ('data-prep', 'data_prep_status', 'complete', CAST(run_no % 6 <> 0 AS INT), NULL),
            ('data-prep', 'data_prep_status', 'row_count', run_no % 9 * 100, NULL),
            ('training', 'data_prep_status', 'complete', CAST(run_no % 6 <> 0 AS INT), NULL),
            ('training', 'data_prep_status', 'updated_at', NULL, now - to_hours(CAST(run_no % 5 AS INT))),
            ('training', 'training_status', 'complete', CAST(weights_hash <> '' AS INT), NULL),
            ('evaluation', 'training_status', 'complete', CAST(weights_hash <> '' AS INT), NULL),
            ('evaluation', 'training_status', 'updated_at', NULL, now - to_hours(CAST(run_no % 3 AS INT))),
            ('evaluation', 'eval_status', 'passed', CAST(passed AS INT), NULL),
            ('deployment', 'eval_status', 'passed', CAST(passed AS INT), NULL),
            ('deployment', 'eval_status', 'accuracy', accuracy_value, NULL),
            ('deployment', 'eval_status', 'updated_at', NULL, now - to_hours(CAST(run_no % 4 AS INT))),
            ('deployment', 'deployment_status', 'deployed', CAST(passed AND run_no % 2 = 1 AS INT), NULL)
        ) s(job, sensor, field, num, written)""",
    # rule inputs: job, sensor, period, field, number (flags as 0/1), written at
    "v_sensors": """
        SELECT 'bronze-' || stream AS job, 'hourly-status' AS sensor, par_day || 'T' || par_hour AS period,
               'complete' AS field, CAST(complete AS DOUBLE) AS num, NULL::TIMESTAMP AS written FROM v_complete
        UNION ALL
        SELECT 'bronze-' || stream, 'hourly-status', par_day || 'T' || par_hour, 'pct_of_expected', pct_of_expected, NULL FROM v_complete
        UNION ALL
        SELECT 'bronze-' || stream, 'audit-result', par_day || 'T' || par_hour, 'match', CAST(match AS INT), NULL FROM v_audit
        UNION ALL
        SELECT 'silver-' || stream || '-hour', 'audit-result', par_day || 'T' || par_hour, 'match', CAST(match AS INT), NULL FROM v_audit
        UNION ALL
        SELECT 'silver-' || stream || '-hour', 'hourly-status', par_day || 'T' || par_hour, 'count', count, NULL FROM v_complete WHERE complete
        UNION ALL
        SELECT pipelineId, 'daily-status', par_day, 'all_hours_complete', CAST(all_hours_complete AS INT), NULL FROM v_daily
        UNION ALL
        SELECT 'iot-factory', 'factory_health', par_day, 'all_healthy', CAST(all_healthy AS INT), NULL FROM v_calm_factory
        UNION ALL
        SELECT 'iot-factory', 'factory_health', par_day, 'healthy_count', healthy_count, NULL FROM v_calm_factory
        UNION ALL
        SELECT 'iot-factory', 'factory_health', par_day, 'updated_at', NULL, updated_at FROM v_calm_factory
        UNION ALL
        SELECT 'banking-streaming', 'cob_status', CAST(batch_id AS VARCHAR), 'complete', CAST(cob_complete AS INT), NULL FROM v_pairs
        UNION ALL
        SELECT 'banking-streaming', 'consumer_lag', CAST(batch_id AS VARCHAR), 'lag_seconds', lag_seconds, NULL FROM v_pairs
        UNION ALL
        SELECT 'dryrun-weather', 'weather-ready', period, 'complete', 1, NULL FROM v_wx_latch
        UNION ALL
        SELECT 'dryrun-weather', 'weather-ready', period, 'total_readings', total_readings, NULL FROM v_wx_ready
        UNION ALL
        SELECT 'dryrun-weather', 'weather-audit', period, 'total_readings', total_readings, NULL FROM v_wx_ready
        UNION ALL
        SELECT 'ml-' || job, sensor, CAST(run_no AS VARCHAR), field, num, written FROM v_runs""",
}

# name of each view another one reads
_NAME = re.compile(r"\bv_[a-z_]+\b")


def oracle(body: str) -> str:
    """``body`` behind the WITH list of the views it needs, directly or not."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(body)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed)
    body = body.strip()
    if not needed:
        return f"WITH {body[1:]}" if body.startswith(",") else body
    return f"WITH {ctes}\n{body}"
