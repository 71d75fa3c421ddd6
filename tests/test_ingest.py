import gzip
import hashlib
import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from pingline.operators import phones, silver
from pingline.session import stored
from pingline.sources import bronze, feeds
from pingline.streaming import jobs

PING = {"phone_out": "1", "phone_in": "2", "cell_tower": "t", "time": "2026-03-01T14:30:00Z"}


def lay_out(folder, lines, name="cdr_20260301_1430_0001.jsonl.gz", period="par_day=20260301/par_hour=04"):
    path = os.path.join(folder, "cdr", period)
    os.makedirs(path, exist_ok=True)
    with gzip.open(os.path.join(path, name), "wt") as f:
        f.write("\n".join(lines))
    return os.path.join(folder, "cdr")


def test_blank_lines_are_skipped_and_bad_ones_quarantined(spark, tmp_path):
    path = lay_out(tmp_path, [json.dumps(PING), "", "   ", "{broken", json.dumps(PING)])
    raw = bronze.read_raw(spark, path, "cdr").cache()
    assert bronze.good_rows(raw).count() == 2
    assert [r[0] for r in bronze.quarantined(raw).collect()] == ["{broken"]
    with pytest.raises(Exception):
        bronze.read_raw(spark, path, "cdr", fail_fast=True).collect()


def test_period_comes_from_the_path(spark, tmp_path):
    path = lay_out(tmp_path, [json.dumps(PING)], period="par_day=20260302/par_hour=09")
    row = bronze.read_raw(spark, path, "cdr").first()
    assert (row.par_day, row.par_hour) == ("20260302", "09")
    assert row.time == datetime(2026, 3, 1, 14, 30)


def test_only_raw_files_are_read(spark, tmp_path):
    path = lay_out(tmp_path, [json.dumps(PING)])
    lay_out(tmp_path, [json.dumps(PING)], name="notes.txt.gz")
    assert bronze.read_raw(spark, path, "cdr").count() == 1


@pytest.mark.parametrize(
    "path,expected",
    [
        ("cdr/par_day=20260301/par_hour=04/cdr_1.jsonl.gz", ("cdr", "20260301", "04")),
        ("seq/par_day=20260301/par_hour=23/x.jsonl.gz", ("seq", "20260301", "23")),
        ("other/par_day=20260301/par_hour=04/x.jsonl.gz", None),
        ("x/cdr/par_day=20260301/par_hour=04/x.jsonl.gz", None),
        ("cdr/par_day=20260301/par_hour=04/x.csv", None),
        ("cdr/2026/x.jsonl.gz", None),
        ("cdr/par_day=2026031/par_hour=04/x.jsonl.gz", None),
    ],
)
def test_route(spark, path, expected):
    got = spark.createDataFrame([(path,)], "path string").select(bronze.route("path")).first()[0]
    assert (tuple(got) if got else None) == expected


def test_files_hold_at_most_the_allowed_records(spark, tmp_path):
    pings = spark.range(25).select(F.lit("1").alias("phone_out"), F.lit("2026-03-01 10:00:00").cast("timestamp_ntz").alias("time"))
    out = str(tmp_path / "raw")
    bronze.write_raw(pings, out, max_records=10)
    folder = os.path.join(out, "par_day=20260301", "par_hour=10")
    sizes = sorted(sum(1 for _ in gzip.open(os.path.join(folder, f))) for f in os.listdir(folder) if f.endswith(".gz"))
    assert sizes == [5, 10, 10]


def test_stored_hash_wins_and_new_phones_are_inserted(spark, rows):
    dimension = rows([("1", "kept")], "phone string, hash string")
    pings = rows([("1", "2"), ("2", "1"), ("3", "1")], "phone_out string, phone_in string")
    found = phones.distinct_phones(pings, ["phone_out", "phone_in"])
    got = {r.phone: (r.hash, r.is_new) for r in phones.hash_phones(found, dimension, "s").collect()}
    import hashlib

    sha = lambda p: hashlib.sha256(("s" + p).encode()).hexdigest()
    assert got == {"1": ("kept", False), "2": (sha("2"), True), "3": (sha("3"), True)}
    new = phones.new_rows(found, dimension, "s", F.lit("2026-01-01").cast("timestamp_ntz"))
    assert sorted(r.phone for r in new.collect()) == ["2", "3"]
    hidden = phones.pseudonymise(pings, {"phone_out": "a", "phone_in": "b"}, dimension, "s")
    assert sorted(map(tuple, hidden.select("a", "b").collect())) == sorted([("kept", sha("2")), (sha("2"), "kept"), (sha("3"), "kept")])


def shuffles(df):
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_phones_of_all_columns_take_one_shuffle(spark, rows):
    pings = rows([("1", "2"), ("2", "1"), (None, "1"), ("3", None), ("", "3")], "phone_out string, phone_in string")
    found = phones.distinct_phones(pings, ["phone_out", "phone_in"])
    assert sorted(map(str, found.collect())) == sorted(map(str, rows([("1",), ("2",), ("3",), ("",), (None,)], "phone string").collect()))
    assert shuffles(found) == 1


def test_a_batch_of_pings_meets_only_its_own_phones(spark, rows, tmp_path):
    """Phones known, rekeyed, twice in the dimension, without a hash, null or new: as the whole dimension gives them."""
    now, today = datetime(2026, 1, 1), hashlib.sha256(b"s2").hexdigest()
    dimension = stored(rows([("1", "old", now), ("2", today, now), ("4", "a", now), ("4", "b", now), ("5", None, now), (None, "none", now)]
                            + [(f"other{i}", "old", now) for i in range(50)], "phone string, hash string, created_at timestamp_ntz"), "dimension")
    data = [(o, i, "T", now, "20260301", f"{h:02d}") for h in range(3) for o, i in (("1", "2"), ("2", "4"), ("5", None), (None, "1"), ("new", "1"))]
    batch = rows(data, "phone_out string, phone_in string, cell_tower string, time timestamp_ntz, par_day string, par_hour string").withColumn(
        "_corrupt_record", F.lit(None).cast("string"))
    read = {}

    def put(df, name, *keys):
        read[name] = df.inputFiles()
        df.write.partitionBy(*keys).parquet(path := str(tmp_path / name))
        return path

    jobs.store_pings(batch, dimension, "s", "cdr", put)
    good, got = bronze.good_rows(batch), spark.read.parquet(str(tmp_path / "bronze"))
    want = bronze.bronze_calls(good, dimension, "s")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and got.count() == 18
    assert sorted(r.phone or "" for r in spark.read.parquet(str(tmp_path / "phones")).collect()) == ["", "new"]
    assert not any("/dimension-" in file for file in read["bronze"] + read["phones"])
    assert phones.known_phones(phones.distinct_phones(good, ["phone_out", "phone_in"]), dimension).count() == 5


def call(spark, n=50):
    return spark.range(n).select(
        (F.col("id") % 3).cast("string").alias("phone_hash_out"), (F.col("id") % 7).cast("string").alias("phone_hash_in"),
        (F.col("id") % 5).cast("string").alias("cell_tower"), F.lit("20260301").alias("par_day"),
        F.lpad((F.col("id") % 4).cast("string"), 2, "0").alias("par_hour"),
    )


def test_daily_counts_are_the_sum_of_hours_and_towers_their_union(spark):
    hours = silver.aggregate_calls(call(spark), silver.HOURLY)
    days = {r.phone_hash_out: r for r in silver.aggregate_calls(call(spark), silver.DAILY).collect()}
    up = hours.groupBy("phone_hash_out").agg(
        F.sum("total_calls").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("unique_towers")))).alias("t")
    )
    for r in up.collect():
        assert days[r.phone_hash_out].total_calls == r.n
        assert days[r.phone_hash_out].unique_towers == r.t
        assert days[r.phone_hash_out].avg_call_duration_s == 10.0
        assert days[r.phone_hash_out].total_duration_s == 10.0 * r.n


def test_order_of_rows_does_not_matter(spark):
    a = sorted(map(str, silver.aggregate_calls(call(spark)).collect()))
    b = sorted(map(str, silver.aggregate_calls(call(spark).orderBy(F.rand(3))).collect()))
    assert a == b


def test_browsing(spark, rows):
    data = [("p", "h", "H", "t1"), ("p", "h", "H", "t2"), ("p", "h", "H", "t1"), ("q", "h", "H", "t1")]
    df = rows([(*d, "20260301", "04") for d in data], "phone_hash string, host_name string, site_name string, cell_tower string, par_day string, par_hour string")
    got = {r.phone_hash: r for r in silver.aggregate_browsing(df).collect()}
    assert (got["p"].site_name, got["p"].total_pings, got["p"].unique_towers, got["p"].total_session_duration_s) == ("H", 3, ["t1", "t2"], 30.0)


def test_append_doubles_and_overwrite_replaces_one_period(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    df = rows([("a", 1)], "k string, v int")
    bronze.write_silver(df, path, "20260301", "04")
    bronze.write_silver(df, path, "20260301", "05")
    bronze.write_silver(df, path, "20260301", "04")
    assert bronze.read_partition(spark, path, "20260301", "04").count() == 2
    bronze.write_silver(df, path, "20260301", "04", mode="overwrite")
    assert bronze.read_partition(spark, path, "20260301", "04").count() == 1
    assert bronze.read_partition(spark, path, "20260301").count() == 2
    # the zero padded hour is text
    assert {r.par_hour for r in spark.read.parquet(path).collect()} == {"04", "05"}


def test_partition_filters_prune(spark, rows, tmp_path):
    path = str(tmp_path / "pruned")
    bronze.write_silver(rows([("a", 1)], "k string, v int"), path, "20260301", "04")
    bronze.read_partition(spark, path, "20260301", view="silver")
    assert spark.sql("SELECT k FROM silver").count() == 1
    plan = bronze.read_partition(spark, path, "20260301", "04")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(par_day" in plan


def test_job_period():
    now = datetime(2026, 3, 1, 0, 20, tzinfo=timezone.utc)
    assert bronze.job_period({"bucket": "b"}, now, True) == {"bucket": "b", "par_day": "20260228", "par_hour": "23"}
    assert bronze.job_period({"bucket": "b"}, now, False) == {"bucket": "b", "par_day": "20260228"}
    assert bronze.job_period({"bucket": "b", "par_day": "20250101", "par_hour": "07"}, now, True)["par_hour"] == "07"
    with pytest.raises(ValueError):
        bronze.job_period({}, now, True)


def test_other_feeds(spark, tmp_path):
    arrays = tmp_path / "wx.json"
    reading = {"station_id": "WX-001", "temperature_c": 5.0, "humidity_pct": 20.0, "quality": 0.7, "timestamp": "t"}
    arrays.write_text(json.dumps([reading, reading]))
    assert feeds.weather_arrays(spark, str(arrays)).count() == 2
    lines = tmp_path / "m.jsonl"
    lines.write_text('{"machine_id": "machine_01", "temperature": 1.5}\n\n{"machine_id": "machine_02"}\n')
    assert [r.temperature for r in feeds.machine_readings(spark, str(lines)).orderBy("machine_id").collect()] == [1.5, None]
    model = tmp_path / "model.json"
    model.write_text('{"model_version": "v", "accuracy": 0.97, "loss": "NaN"}')
    got = feeds.model_artifacts(spark, str(model)).first()
    assert (got.accuracy, got.loss, got.weights_hash) == ("0.97", "NaN", None)


def test_transactions_are_parsed(spark, rows):
    body = json.dumps({"transaction_id": 1, "account_id": "A", "type": "x", "amount": 1.25, "timestamp": "2026-03-01T10:00:00.5"})
    got = feeds.parse_transactions(rows([(7, body)], "batch_id int, payload string")).first()
    assert (got.batch_id, got.amount, got.ts) == (7, 1.25, datetime(2026, 3, 1, 10, 0, 0, 500000))
