from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from pingline.functions.columns import severity
from pingline.operators import eventlog

NOW = int(datetime(2026, 3, 4, 12, tzinfo=timezone.utc).timestamp() * 1000)
HOUR = 3_600_000
SCHEMA = "event_id long, pipelineId string, eventType string, timestamp long, message string, date string, scheduleId string"


@pytest.fixture
def log(rows):
    data = [
        ("ingest", "JOB_TRIGGERED", 3), ("ingest", "JOB_COMPLETED", 2), ("ingest", "SLA_MET", 1),
        ("transform", "JOB_TRIGGERED", 2), ("transform", "SLA_WARNING", 1),
        ("publish", "SLA_BREACH", 2), ("publish", "JOB_FAILED", 1),
    ]
    return rows([(i, p, t, NOW - h * HOUR, f"m{i}", "2026-03-04", "daily") for i, (p, t, h) in enumerate(data)], SCHEMA)


def test_overview(log):
    got = {r.pipelineId: r for r in eventlog.overview(log, F.lit(NOW - eventlog.ONE_DAY_MS)).collect()}
    assert {k: v.events for k, v in got.items()} == {"ingest": 3, "transform": 2, "publish": 2}
    assert got["publish"].last_type == "JOB_FAILED" and got["ingest"].last_message == "m2"
    assert eventlog.overview(log, F.lit(NOW + 1)).count() == 0


def test_range_ends(log):
    start, end = F.lit(NOW - 2 * HOUR), F.lit(NOW - HOUR)
    mine = eventlog.between(log, start, end, source="ingest").collect()
    assert [r.eventType for r in mine] == ["JOB_COMPLETED"]  # start included, end not
    kind = eventlog.between(log, start, end, event_type="SLA_MET").collect()
    assert len(kind) == 1  # end included
    assert eventlog.between(log, start, end).count() == 6
    assert eventlog.between(log, start, end, source="ingest", event_type="SLA_MET").count() == 0


def test_range_of():
    low, high = eventlog.range_of("2026-03-04", "10")
    assert (low, high - low) == (NOW - 2 * HOUR, HOUR)
    with pytest.raises(ValueError):
        eventlog.range_of("2026-13-04")
    with pytest.raises(ValueError):
        eventlog.range_of("2026-03-04", "ten")


def test_bad_times(rows):
    log = rows([(1, "bronze-cdr", "X", 0, "m", "d", "s"), (2, "bronze-cdr", "X", 5 * HOUR, "m", "d", "s"), (3, "else", "X", HOUR, "m", "d", "s")], SCHEMA)
    hours = {(r.event_id, r.hour) for r in eventlog.timeline(log).collect()}
    assert hours == {(1, 0), (2, 5)}  # hour 0, and only the known sources
    hist = {r.hour: r.n for r in eventlog.hourly_histogram(log, F.lit(0)).filter("pipelineId = 'bronze-cdr'").collect()}
    assert len(hist) == 24 and hist[5] == 1 and sum(hist.values()) == 1


def test_metrics(log):
    got = {(r.measure, r.item): r.n for r in eventlog.metrics(log, F.lit(0), F.lit(NOW)).collect()}
    assert got[("total", "")] == 7 and got[("type", "JOB_TRIGGERED")] == 2 and got[("source", "ingest")] == 3
    assert [got[("sla", t)] for t in ("SLA_MET", "SLA_WARNING", "SLA_BREACH")] == [1, 1, 1]
    empty = eventlog.metrics(log, F.lit(NOW + 1), F.lit(NOW + 2)).collect()
    assert sorted((r.measure, r.item, r.n) for r in empty) == [
        ("sla", "SLA_BREACH", 0), ("sla", "SLA_MET", 0), ("sla", "SLA_WARNING", 0), ("total", "", 0)
    ]


def test_severity(rows):
    df = rows([("SLA_BREACH",), ("SLA_WARNING",), ("VALIDATION_PASSED",), ("SOMETHING_NEW",)], "e string")
    assert [r[0] for r in df.select(severity("e")).collect()] == ["critical", "warning", "success", "info"]


def test_worst_severity_and_sla_status(log):
    worst = {r.pipelineId: r.severity for r in eventlog.worst_severity(log, ["pipelineId"]).collect()}
    assert worst == {"ingest": "success", "transform": "warning", "publish": "critical"}
    status = {r.pipelineId: r.sla_status for r in eventlog.sla_status(log).collect()}
    assert status == {"ingest": "OK", "transform": "Warning", "publish": "Breach"}


def test_feeds(log):
    count = lambda name: log.filter(eventlog.feed_filter(name)).count()
    assert (count("all"), count("failures"), count("sla")) == (7, 2, 3)
    assert [r.event_id for r in eventlog.newest(log, 2).collect()] == [6, 4]
    assert [r.event_id for r in eventlog.oldest(log, 1).collect()] == [0]


def test_pivot(log):
    got = {r.pipelineId: r.asDict() for r in eventlog.pivot_types(log, "pipelineId", ["SLA_MET", "JOB_FAILED"]).collect()}
    assert (got["ingest"]["SLA_MET"], got["ingest"]["JOB_FAILED"], got["publish"]["JOB_FAILED"]) == (1, 0, 1)
    assert (got["ingest"]["OTHER"], got["publish"]["OTHER"]) == (2, 1)
    strange = log.withColumn("eventType", F.when(F.col("event_id") == 6, "DATA_DRIFT").when(F.col("event_id") != 5, F.col("eventType")))
    every = {r.pipelineId: r.asDict() for r in eventlog.pivot_types(strange, "pipelineId").collect()}
    assert every["publish"]["DATA_DRIFT"] == 1 and every["publish"]["UNKNOWN"] == 1
    assert all(sum(v for k, v in r.items() if k != "pipelineId") == log.filter(F.col("pipelineId") == p).count() for p, r in every.items())


def test_feeds_in_one_reading(log):
    got = eventlog.feeds(log, ["all", "failures", "sla"], 2)
    assert {f: sorted(r.event_id for r in got.collect() if r.feed == f) for f in ("all", "failures", "sla")} == {
        "all": [4, 6], "failures": [5, 6], "sla": [2, 4]}
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_timeline_of_one_pipeline(log, rows):
    snapshots = rows(
        [("ingest", "ready", datetime(2026, 3, 4, 10), 3, None, {"audit": {"updatedAt": "2026-03-04 11:30:00"}}),
         ("ingest", "ready", datetime(2026, 3, 4, 11), None, None, {"audit": {"n": "1"}}),
         ("publish", "ready", datetime(2026, 3, 4, 11), 3, datetime(2026, 3, 4, 11), None)],
        "pipeline_id string, sensor string, period timestamp_ntz, total_readings int, updated_at timestamp_ntz, nested map<string,map<string,string>>")
    for c in ("valid_readings", "batches_received", "complete"):
        snapshots = snapshots.withColumn(c, F.lit(None).cast("int"))
    got = sorted((r.origin, r.message, r["at"].hour) for r in eventlog.merged_timeline(log, snapshots, "ingest", 2).collect())
    assert got == [("event", "m1", 10), ("event", "m2", 11), ("sensor", "ready [2026-03-04T10]: total_readings=3", 11)]


def test_normalize_defaults(rows):
    got = eventlog.normalize(rows([(1, None, "X", None, None, None, None)], SCHEMA)).first()
    assert (got.pipelineId, got.message, got.time) == ("", "", datetime(1970, 1, 1))


def test_sensors(spark):
    items = spark.createDataFrame(
        [
            ("w", "SENSOR#ready#x", {"date": "20260301", "hour": "04", "total": "3"}, {"audit": {"n": "1"}}),
            ("w", "SENSOR#ready#y", {"period": "20260301T05", "total": "4"}, {}),
            ("w", "RUN#1", {"total": "9"}, {}),
        ],
        "pipeline_id string, sk string, data map<string,string>, nested map<string,map<string,string>>",
    )
    got = sorted((r.period.hour, r.sensor, r.field, r.value) for r in eventlog.flatten_sensors(items).collect())
    assert got == [(4, "ready", "audit.n", "1"), (4, "ready", "total", "3"), (5, "ready", "total", "4")]


def test_store_prunes_and_pushes_down(spark, log, tmp_path):
    from pingline.sources import eventstore

    path = str(tmp_path / "log")
    eventstore.write_log(log, path)
    eventstore.write_log(log.withColumn("date", F.lit("2026-03-01")), path)
    got = eventstore.read_range(spark, path, NOW - 2 * HOUR, NOW, source="ingest")
    assert sorted(r.event_id for r in got.collect()) == [1, 2]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(pipelineId,ingest), GreaterThanOrEqual(time" in plan.split("PushedFilters: [")[1]
