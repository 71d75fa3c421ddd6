"""Each streaming job over several micro-batches gives what the batch query gives."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pingline.catalog.ingest import GLOB
from pingline.operators import monitoring, quality
from pingline.functions.columns import par_day, par_hour
from pingline.operators.completeness import daily_completeness, stored_counts
from pingline.session import scratch_path
from pingline.sources import bronze, tables
from pingline.streaming import jobs

SMALL = "/root/testdata/sf0.001"
T0 = datetime(2026, 3, 1)


@pytest.fixture(scope="module")
def parts(spark):
    """The events table as six files in time order."""
    path = scratch_path(spark, "parts")
    events = tables.table(spark, SMALL, "events")
    for i in range(6):
        low, high = i * 200, i * 200 + 200
        events.filter((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.mode("append").parquet(path)
    return path


def source(spark, path, per_trigger=2):
    schema = spark.read.parquet(path).schema
    return jobs.with_zone(spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path))


def batch(spark):
    return tables.with_keys(tables.table(spark, SMALL, "events"))


def where(spark):
    base = scratch_path(spark, "stream")
    return f"{base}/out", f"{base}/checkpoint"


def same(a, b):
    a, b = bronze.as_ntz(a), bronze.as_ntz(b)
    assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))


def delivered(events):
    file_no = F.floor(F.minute("ts") / 15).cast("int").alias("file_no")
    return events.select(tables.stream_of().alias("stream"), file_no, "ts", par_day("ts").alias("par_day"), par_hour("ts").alias("par_hour"))


def test_hourly_counts(spark, parts):
    out, checkpoint = where(spark)
    jobs.run_available(jobs.hourly_counts(delivered(source(spark, parts))), jobs.batch_writer(out), checkpoint, "update")
    changes = jobs.read_batches(spark, out)
    assert changes.select("batch").distinct().count() >= 3
    want = delivered(batch(spark)).groupBy("stream", "par_day", "par_hour").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("file_no").alias("files"), F.max("ts").alias("updated_at"))
    same(jobs.latest_per_key(changes, ["stream", "par_day", "par_hour"]), want)


def test_daily_hours(spark, parts):
    out, checkpoint = where(spark)
    shape = lambda df: df.select(
        F.when(F.col("event_type") == "click", "silver-cdr-hour").when(F.col("event_type") == "view", "other").otherwise("silver-seq-hour").alias("pipelineId"),
        F.when(F.col("event_id") % 5 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH")).alias("date"), "ts")
    jobs.run_available(jobs.daily_hours(shape(source(spark, parts))), jobs.batch_writer(out), checkpoint, "update")
    want = daily_completeness(shape(batch(spark)))
    same(jobs.latest_per_key(jobs.read_batches(spark, out), ["pipelineId", "par_day"]), want)


def test_window_volume_emits_closed_windows_once(spark, parts):
    out, checkpoint = where(spark)
    jobs.append_available(jobs.window_volume(delivered(source(spark, parts))), out, checkpoint)
    got = {(r.stream, r.window_start): r.records for r in bronze.as_ntz(spark.read.parquet(out)).collect()}
    counts = delivered(batch(spark)).groupBy("stream", F.window("ts", "15 minutes")["start"].alias("w")).count().collect()
    newest = batch(spark).agg(F.max("ts")).first()[0]
    want = {(r.stream, r.w): r["count"] for r in counts if r.w + timedelta(minutes=25) <= newest}
    assert got == want
    expected = jobs.with_expected(spark.read.parquet(out), {"cdr": 960, "seq": 96_000}).collect()
    assert all(r.expected > 0 for r in expected) and max(r.expected for r in expected if r.stream == "cdr") < 40


def test_duplicates_are_suppressed(spark, parts):
    out, checkpoint = where(spark)
    once = source(spark, parts).select("event_id", "ts")
    jobs.append_available(jobs.suppress_duplicates(once.unionByName(once), ["event_id"]), out, checkpoint)
    same(spark.read.parquet(out), batch(spark).select("event_id", "ts"))


def test_latch_is_set_once(spark, parts):
    out, checkpoint = where(spark)
    readings = tables.weather_of(tables.with_keys(source(spark, parts)))
    jobs.run_available(jobs.weather_counts(readings), jobs.batch_writer(out), checkpoint, "update")
    got = monitoring.weather_latch(jobs.latest_per_key(jobs.read_batches(spark, out), ["period", "batch_no"]))
    assert got.count() == got.select("period").distinct().count()
    want = monitoring.weather_latch(monitoring.weather_batches(tables.weather_of(batch(spark))))
    same(got, want)


def test_latch_survives_poor_batches(spark, rows):
    path = scratch_path(spark, "poor")
    at = lambda m: T0 + timedelta(minutes=m)
    good = [("20260301T00", 0, 0.9, at(m % 10)) for m in range(12)]
    poor = [("20260301T00", 1, 0.1, at(10)) for _ in range(50)]
    schema = "period string, batch_no int, quality double, ts timestamp_ntz"
    for data in (good, poor):
        rows(data, schema).coalesce(1).write.mode("append").parquet(path)
    out, checkpoint = where(spark)
    jobs.run_available(jobs.weather_counts(source(spark, path, 1)), jobs.batch_writer(out), checkpoint, "update")
    got = monitoring.weather_latch(jobs.latest_per_key(jobs.read_batches(spark, out), ["period", "batch_no"])).collect()
    assert [(r.period, r.batch_no, r.total_then) for r in got] == [("20260301T00", 0, 12)]


def test_transaction_batches(spark, parts):
    out, checkpoint = where(spark)
    jobs.transaction_batches(source(spark, parts), out, checkpoint)
    got = jobs.read_batches(spark, out).groupBy("par_day").agg(F.sum("transactions").alias("n"), F.min("oldest").alias("oldest"))
    same(got, batch(spark).groupBy("par_day").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("oldest")))


def test_lag_against_now(spark, parts):
    out, checkpoint = where(spark)
    newest = batch(spark).agg(F.max("ts")).first()[0]
    now = newest.replace(hour=18, minute=0, second=0, microsecond=0) + timedelta(days=1)
    jobs.transaction_batches(source(spark, parts), out, checkpoint, F.lit(now).cast("timestamp_ntz"))
    got = jobs.read_batches(spark, out).collect()
    assert all(r.cob_complete for r in got)
    assert min(r.lag_seconds for r in got) >= int((now - newest).total_seconds())


def test_late_rows_are_kept_apart(spark, parts):
    out, checkpoint = where(spark)
    delay = F.make_dt_interval(mins=F.when(F.col("event_id") % 7 == 0, 200).otherwise(1))
    shape = lambda df: df.select("event_id", "ts", (F.col("ts") + delay).alias("arrived_at"), F.col("ts").alias("end"))
    jobs.split_late(shape(source(spark, parts)), "arrived_at", F.col("end"), 1800, out, checkpoint)
    late, on_time = jobs.read_batches(spark, f"{out}/late"), jobs.read_batches(spark, f"{out}/on_time")
    want = quality.late(shape(batch(spark)), "arrived_at", F.col("end"), 1800)
    same(late.drop("batch"), want)
    assert late.count() + on_time.count() == batch(spark).count()


def test_factory_health(spark, parts):
    out, checkpoint = where(spark)
    jobs.run_available(jobs.machine_hours(tables.machine_readings_of(tables.with_keys(source(spark, parts)))), jobs.batch_writer(out), checkpoint, "update")
    hours = jobs.latest_per_key(jobs.read_batches(spark, out), ["machine_id", "par_day", "par_hour"])
    want = monitoring.machine_status(tables.machine_readings_of(batch(spark)), ["par_day", "par_hour"])
    same(hours, want.select("machine_id", "par_day", "par_hour", "status", "readings_count", "updated_at"))


def test_bronze_rows_and_counters_agree(spark, tmp_path):
    path = f"{scratch_path(spark, 'raw')}/cdr"
    pings = tables.calls(spark, SMALL).limit(300).drop("par_day", "par_hour")
    bronze.write_raw(pings, path)
    bad = tmp_path / "cdr" / "par_day=20240101" / "par_hour=00"
    bad.mkdir(parents=True)
    (bad / "x.json").write_text('{"phone_out": "1"\n')
    raw = jobs.raw_stream(spark, path, "cdr", GLOB, files=7)
    out, checkpoint = where(spark)
    dimension = tables.phone_dimension(spark, SMALL)
    jobs.bronze_ingest(raw, dimension, "salt", out, checkpoint)
    stored = jobs.read_batches(spark, f"{out}/bronze")
    one_day = bronze.read_partition(spark, f"{out}/bronze", stored.first().par_day)
    assert "par_day" in one_day._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    want = bronze.bronze_calls(bronze.good_rows(bronze.read_raw(spark, path, "cdr", GLOB)), dimension, "salt")
    same(stored.drop("batch"), want)
    counters = jobs.read_batches(spark, f"{out}/counters").groupBy("par_day", "par_hour").agg(F.sum("records").alias("stored_count"))
    same(counters, stored_counts(stored.withColumn("stream", F.lit("cdr"))).drop("stream"))
    # the checkpoint remembers: nothing is read twice
    before = stored.count()
    jobs.bronze_ingest(jobs.raw_stream(spark, path, "cdr", GLOB, files=7), dimension, "salt", out, checkpoint)
    assert jobs.read_batches(spark, f"{out}/bronze").count() == before
    # a batch that runs again leaves one copy
    jobs.batch_writer(f"{out}/again")(want, 3)
    jobs.batch_writer(f"{out}/again")(want, 3)
    assert jobs.read_batches(spark, f"{out}/again").count() == want.count()


def test_new_phones_are_inserted_once(spark):
    path = f"{scratch_path(spark, 'raw')}/seq"
    pings = tables.browses(spark, SMALL).limit(400).drop("par_day", "par_hour")
    bronze.write_raw(pings, path)
    out, checkpoint = where(spark)
    dimension = tables.phone_dimension(spark, SMALL)
    jobs.bronze_ingest(jobs.raw_stream(spark, path, "seq", GLOB, files=9), dimension, "salt", out, checkpoint, "seq")
    got = jobs.inserted_phones(spark, out)
    want = pings.select(F.col("phone_number").alias("phone")).distinct().join(dimension, "phone", "left_anti")
    assert {r.phone for r in got.collect()} == {r.phone for r in want.collect()}
    same(jobs.read_batches(spark, f"{out}/bronze").drop("batch"),
         bronze.bronze_browses(bronze.good_rows(bronze.read_raw(spark, path, "seq", GLOB)), dimension, "salt"))


def test_malformed_lines_go_to_quarantine(spark):
    import gzip
    import os

    path = f"{scratch_path(spark, 'raw')}/cdr"
    folder = f"{path}/par_day=20260301/par_hour=04"
    os.makedirs(folder)
    with gzip.open(f"{folder}/a.jsonl.gz", "wt") as f:
        f.write('{"phone_out":"1","phone_in":"2","cell_tower":"t","time":"2026-03-01T04:00:00Z"}\n{oops\n')
    out, checkpoint = where(spark)
    jobs.bronze_ingest(jobs.raw_stream(spark, path, "cdr"), tables.phone_dimension(spark, SMALL), "salt", out, checkpoint)
    assert [r._corrupt_record for r in jobs.read_batches(spark, f"{out}/quarantine").collect()] == ["{oops"]
    assert jobs.read_batches(spark, f"{out}/bronze").count() == 1
