from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pingline.operators import completeness, monitoring
from pingline.plans import rules
from pingline.plans.definitions import DEADLINES, RULES, rules_table


def volume(hour, target=1_000_000):
    import math

    w = lambda h: 0.10 + 0.70 * math.exp(-((h - 10) ** 2) / 18) + 0.50 * math.exp(-((h - 20) ** 2) / 12.5)
    total = sum(w(i * 0.25 + 0.125) for i in range(96))
    return round(target * sum(w(hour + (m + 7.5) / 60) for m in (0, 15, 30, 45)) / total)


def test_expected_volume_follows_the_curve(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    got = [r[0] for r in hours.select(completeness.expected_in_hour(F.lit(1_000_000), F.col("h"))).collect()]
    assert got == [volume(h) for h in range(24)]
    windows = spark.range(96).select(completeness.expected_in_window(F.lit(1_000_000), F.col("id"))).collect()
    assert abs(sum(r[0] for r in windows) - 1_000_000) <= 48


def files(rows, counts):
    at = datetime(2026, 3, 1, 10)
    return rows(
        [("cdr", "20260301", "10", i, n, at + timedelta(minutes=15 * i)) for i, n in enumerate(counts)],
        "stream string, par_day string, par_hour string, file_no int, records long, arrived_at timestamp_ntz",
    ).withColumn("daily_target", F.lit(1_000_000))


def share_of(hour, share, n):
    """n files that add up to just about a share of an hour's volume."""
    whole = volume(hour)
    import math

    total = math.ceil(whole * share)
    return [total // n] * (n - 1) + [total - total // n * (n - 1)]


@pytest.mark.parametrize("n,share,expected", [(3, 1.0, False), (4, 0.84, False), (4, 0.85, True), (5, 0.85, True)])
def test_complete_needs_four_files_and_most_of_the_volume(rows, n, share, expected):
    df = files(rows, share_of(10, share, n))
    counters = completeness.hourly_counters(df).withColumn("daily_target", F.lit(1_000_000))
    got = completeness.hourly_completeness(counters).first()
    assert (got.files_processed, got.complete) == (n, expected)
    assert (completeness.completeness_latch(df).count() == 1) is expected


def test_empty_files_are_not_counted(rows):
    got = completeness.hourly_counters(files(rows, [5, 0, 0, 7])).first()
    assert (got["count"], got.files_processed) == (12, 2)


def test_latch_names_the_deciding_file(rows):
    parts = share_of(10, 1.2, 6)
    got = completeness.completeness_latch(files(rows, parts)).first()
    assert got.files_then == 5 and got.completed_at == datetime(2026, 3, 1, 11)


def test_reconcile(rows):
    key = "stream string, par_day string, par_hour string"
    sensors = rows([("cdr", "d", "00", 5), ("cdr", "d", "01", 5), ("cdr", "d", "02", 0), ("cdr", "d", "04", 5)], key + ", sensor_count long")
    stored = rows([("cdr", "d", "00", 6), ("cdr", "d", "01", 4), ("cdr", "d", "02", 3), ("cdr", "d", "03", 3)], key + ", stored_count long")
    got = {r.par_hour: (r.match, r.reason) for r in completeness.reconcile(sensors, stored).collect()}
    assert got == {
        "00": (True, "ok"), "01": (False, "count_mismatch"), "02": (False, "no_sensor_data"),
        "03": (False, "no_sensor_data"), "04": (False, "count_mismatch"),
    }
    strict = {r.par_hour: r.match for r in completeness.reconcile(sensors, stored, strict=True).collect()}
    assert strict["00"] is False


@pytest.mark.parametrize("hours,expected", [(23, False), (24, True)])
def test_daily_completeness(rows, hours, expected):
    done = [("silver-cdr-hour", f"2026-03-01T{h:02d}") for h in range(hours)] + [("silver-cdr-hour", "2026-03-01T00")]
    done += [("silver-cdr-hour", "2026-03-01"), ("bronze-cdr", "2026-03-01T23")]
    got = completeness.daily_completeness(rows(done, "pipelineId string, date string")).collect()
    assert [(r.pipelineId, r.par_day, len(r.completed_hours), r.all_hours_complete) for r in got] == [
        ("silver-cdr-day", "2026-03-01", hours, expected)
    ]


# ---- rules --------------------------------------------------------------

SENSOR = "job string, sensor string, period string, field string, value string"
AS_OF = datetime(2026, 3, 1, 12)


def passed(rows, data, phase="validation"):
    out = rules.evaluate(rows(data, SENSOR), phase, F.lit(AS_OF).cast("timestamp_ntz"))
    return {(r.job, r.period): (r.passed_rules, r.total_rules, r.passed) for r in out.collect()}


def test_all_rules_must_hold(rows):
    data = [
        ("banking-streaming", "cob_status", "a", "complete", "true"), ("banking-streaming", "consumer_lag", "a", "lag_seconds", "300"),
        ("banking-streaming", "cob_status", "b", "complete", "true"), ("banking-streaming", "consumer_lag", "b", "lag_seconds", "301"),
        ("banking-streaming", "consumer_lag", "c", "lag_seconds", "1"),
        ("banking-streaming", "cob_status", "d", "complete", "true"), ("banking-streaming", "consumer_lag", "d", "lag_seconds", "NaN"),
    ]
    assert passed(rows, data) == {
        ("banking-streaming", "a"): (2, 2, True), ("banking-streaming", "b"): (1, 2, False),
        ("banking-streaming", "c"): (1, 2, False), ("banking-streaming", "d"): (1, 2, False),
    }


@pytest.mark.parametrize("age,expected", [("2026-03-01 11:55:01", True), ("2026-03-01 11:55:00", False), ("2026-03-01 11:00:00", False), ("soon", False)])
def test_age(rows, age, expected):
    data = [("iot-factory", "factory_health", "p", f, v) for f, v in [("all_healthy", "true"), ("healthy_count", "10"), ("updated_at", age)]]
    assert passed(rows, data)[("iot-factory", "p")][2] is expected


def test_triggers_and_post_run_rules(rows):
    data = [("silver-cdr-hour", "audit-result", "p", "match", "true"), ("silver-cdr-hour", "hourly-status", "p", "count", "0")]
    assert passed(rows, data, "trigger")[("silver-cdr-hour", "p")][2] is True
    assert passed(rows, data, "postRun")[("silver-cdr-hour", "p")][2] is False


def test_definitions_are_whole(spark):
    jobs = {d[0] for d in DEADLINES}
    assert len(jobs) == 13 and {r[0] for r in RULES} == jobs
    assert rules_table(spark).filter("check = 'age_lt' and value = '300'").count() == 1


def test_deadlines(rows):
    p = datetime(2026, 3, 1, 10)
    minute = lambda m: p + timedelta(minutes=m)
    day = datetime(2026, 3, 1)
    data = [
        ("silver-cdr-hour", p, minute(5), minute(15)),   # in time, as expected
        ("silver-cdr-hour", p, minute(15), minute(30)),  # on the deadline, longer than expected
        ("silver-cdr-hour", p, minute(25), minute(31)),  # past the deadline
        ("silver-cdr-hour", p, minute(1), minute(29)),   # longer than allowed
        ("silver-cdr-day", day, day + timedelta(minutes=100), day + timedelta(minutes=120)),
    ]
    runs = rows(data, "job string, period_start timestamp_ntz, started_at timestamp_ntz, finished_at timestamp_ntz")
    out = {(r.job, r.started_at): (r.outcome, r.deadline_at) for r in rules.sla_outcome(runs).collect()}
    assert [out[(d[0], d[2])][0] for d in data] == ["MET", "WARNING", "BREACH", "BREACH", "MET"]
    assert out[("silver-cdr-hour", minute(5))][1] == minute(30)
    assert out[("silver-cdr-day", day + timedelta(minutes=100))][1] == day + timedelta(hours=2)
    later = rules.sla_outcome(runs, day_shift=1).filter("job = 'silver-cdr-day'").first()
    assert later.deadline_at == day + timedelta(hours=26)


def wx(rows, valid_of):
    at = datetime(2026, 3, 1, 10)
    return rows(
        [("20260301T10", i, t, v, at + timedelta(minutes=10 * i)) for i, (t, v) in enumerate(valid_of)],
        "period string, batch_no int, total long, valid long, arrived_at timestamp_ntz",
    )


@pytest.mark.parametrize(
    "batches,fires_at",
    [([(11, 11)], None), ([(12, 8)], None), ([(12, 9)], 0), ([(6, 6), (6, 3), (6, 0)], 1), ([(6, 0), (6, 6), (12, 12)], 2)],
)
def test_weather_latch(rows, batches, fires_at):
    got = monitoring.weather_latch(wx(rows, batches)).collect()
    assert [r.batch_no for r in got] == ([] if fires_at is None else [fires_at])
    state = monitoring.weather_ready(wx(rows, batches)).first()
    assert state.complete is (fires_at is not None)


def test_latch_columns_are_of_one_batch(rows):
    at = lambda m: datetime(2026, 3, 1, 10, m)
    late = rows([("20260301T10", 0, 12, 12, at(30)), ("20260301T10", 1, 20, 20, at(15))],
                "period string, batch_no int, total long, valid long, arrived_at timestamp_ntz")
    assert [tuple(r) for r in monitoring.weather_latch(late).collect()] == [("20260301T10", 1, at(15), 20)]


def test_dry_run(rows):
    got = rules.dry_run_events(wx(rows, [(6, 6), (6, 6), (2, 2), (1, 0)])).collect()
    kinds = sorted((r.event_type, r.detail) for r in got)
    assert kinds == [
        ("DRY_RUN_DRIFT", "3"), ("DRY_RUN_LATE_DATA", "1"), ("DRY_RUN_LATE_DATA", "2"),
        ("DRY_RUN_SLA_PROJECTION", "MET"), ("DRY_RUN_WOULD_TRIGGER", "12"),
    ]


def test_cascade(rows):
    p = datetime(2026, 3, 1, 10)
    m = lambda n: p + timedelta(minutes=n)
    chain = "period_start timestamp_ntz, `ml-data-prep` timestamp_ntz, `ml-training` timestamp_ntz, `ml-evaluation` timestamp_ntz, `ml-deployment` timestamp_ntz"
    on_time = rules.cascade(rows([(p, m(1), m(2), m(3), m(4))], chain)).collect()
    assert not any(r.missed for r in on_time)
    late = rules.cascade(rows([(p, m(45), m(2), m(3), m(4))], chain)).collect()
    assert all(r.missed for r in late) and [r.held_up_by_upstream for r in late] == [False, True, True, True]
    absent = rules.cascade(rows([(p, None, m(2), m(3), m(4))], chain)).collect()
    assert all(r.missed and r.finish_at is None for r in absent)
