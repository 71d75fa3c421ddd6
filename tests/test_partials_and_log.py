"""Days from hourly partials, and log reads that leave most of the log alone."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pingline.operators import silver
from pingline.session import stored
from pingline.sources import eventstore

RNG = random.Random(3)


def pings(rows):
    data = [("20260301" if RNG.random() < 0.8 else "20260302", f"{RNG.randrange(24):02d}", f"p{RNG.choice([0, 0, 0, RNG.randrange(40)])}",
             RNG.choice([None, *(f"q{i}" for i in range(90))]), RNG.choice([None, "a", "b", "c"])) for _ in range(3000)]
    return rows(data, "par_day string, par_hour string, phone_hash_out string, phone_hash_in string, cell_tower string")


def test_the_day_from_partials_is_the_day(spark, rows):
    bronze = stored(pings(rows), "pings")
    numbers = stored(silver.number_contacts(bronze), "numbers")
    got = silver.calls_of_partials(stored(silver.call_partials(bronze, numbers), "partials"))
    want = bronze.transform(silver.aggregate_calls, silver.DAILY)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_partial_holds_no_more_than_a_long_of_contacts(spark, rows):
    """Every number of a bucket, the sign bit's too, in wide ranges of numbers; without a contact, repeated, without a caller."""
    numbers = rows([(f"q{i}", i + (i % 3 << 33)) for i in range(300)], "phone_hash_in string, number bigint")
    data = [("d", h, "busy", f"q{i}", "a") for i in range(300) for h in ("01", "01", "02")]
    data += [("d", "01", "alone", None, None), ("d", "02", "alone", None, "b"), ("d", "01", "last", "q63", "a"), ("d", "02", None, "q1", "a"), (None, None, "busy", "q2", "c")]
    bronze = rows(data, "par_day string, par_hour string, phone_hash_out string, phone_hash_in string, cell_tower string")
    partials = stored(silver.call_partials(bronze, numbers), "partials")
    assert partials.schema["contacts"].dataType.simpleString() == "bigint" and partials.count() <= bronze.count()
    days = silver.calls_of_partials(partials)
    want = bronze.transform(silver.aggregate_calls, silver.DAILY)
    assert sorted(map(str, days.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert {r.phone_hash_out: r.unique_contacts for r in days.where("par_day = 'd'").collect()} == {"busy": 300, "alone": 0, "last": 1, None: 1}


def test_numbers_are_given_once(spark, rows):
    first = stored(silver.number_contacts(rows([("a",), ("b",), (None,), ("a",)], "phone_hash_in string")), "numbers")
    later = stored(silver.number_contacts(rows([("b",), ("c",), ("d",)], "phone_hash_in string"), first), "numbers")
    both = first.union(later).collect()
    assert sorted(r.phone_hash_in for r in both) == ["a", "b", "c", "d"] and len({r.number for r in both}) == 4
    assert silver.number_contacts(rows([], "phone_hash_in string")).count() == 0


DAY = 86_400_000
SCHEMA = "event_id long, pipelineId string, eventType string, timestamp long, message string, scheduleId string, date string"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """Forty days; `rare` speaks on two of them only."""
    days = spark.range(40 * 500).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 500 != 7, F.concat(F.lit("s"), F.col("id") % 5)).when(F.col("id").isin(507, 15_007), "rare").otherwise("s0").alias("pipelineId"),
        F.when(F.col("id") == 9_999, "ODD").otherwise(F.concat(F.lit("T"), F.col("id") % 7)).alias("eventType"),
        (F.lit(20_000 * DAY) + F.floor(F.col("id") / 500) * DAY + (F.col("id") % 500) * 1000).alias("timestamp"),
        F.concat(F.lit("m" * 40), F.col("id")).alias("message"), F.lit("daily").alias("scheduleId"))
    days = days.withColumn("date", F.date_format(F.timestamp_millis("timestamp"), "yyyy-MM-dd"))
    path = str(tmp_path_factory.mktemp("log") / "events")
    eventstore.write_log(days, path, row_group_bytes=4096)
    return path, days


def newest(days, n, **only):
    for column, value in only.items():
        days = days.filter(F.col(column) == value)
    return [r.event_id for r in days.orderBy(F.desc("timestamp"), F.desc("event_id")).limit(n).collect()]


@pytest.mark.parametrize("n, source, kind", [(3, None, None), (700, None, None), (120, "s1", None), (2, "rare", None), (5, "rare", None), (10, None, "ODD"), (4, "s2", "T3"), (3, "none", None)])
def test_newest_first(spark, log, n, source, kind):
    path, days = log
    only = {k: v for k, v in (("pipelineId", source), ("eventType", kind)) if v}
    assert [r.event_id for r in eventstore.read_newest(spark, path, n, source, kind).collect()] == newest(days, n, **only)


def test_newest_reads_no_older_days(spark, log):
    path, _ = log
    few = eventstore.read_newest(spark, path, 50, "s1")
    assert len(few.inputFiles()) <= 2 * len(eventstore.read_days(spark, path, eventstore.days(spark, path)[:1]).inputFiles())
    with pytest.raises(FileNotFoundError):
        eventstore.read_newest(spark, path.removesuffix("events"), 1)


def scanned(spark, df):
    """Rows the scan handed on, after row groups were skipped."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("event_id", "message")._jdf.queryExecution()
        plan.toRdd().count()
        leaf = plan.executedPlan().collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_rare_type_skips_row_groups(spark, log):
    path, days = log
    assert [r.event_id for r in eventstore.read_type(spark, path, "ODD").collect()] == [9_999]
    assert scanned(spark, eventstore.read_type(spark, path, "ODD")) < days.count() / 10


def test_bloom_filters_answer_where_dictionaries_do_not(spark, tmp_path, rows):
    """Many sources: no dictionary holds them, and an unknown one lies inside every range."""
    path = str(tmp_path / "many")
    many = spark.range(30_000).select(
        F.col("id").alias("event_id"), F.sha2(F.col("id").cast("string"), 256).alias("pipelineId"), F.lit("T").alias("eventType"),
        F.col("id").alias("timestamp"), F.lit("m").alias("message"), F.lit("d").alias("scheduleId"), F.lit("2026-03-01").alias("date"))
    eventstore.write_log(many, path)
    asked = lambda name: spark.read.parquet(path).filter(F.col("pipelineId") == name)
    known = many.filter("event_id = 77").first().pipelineId
    assert asked(known).count() == 1
    # inside the range of values, but in no row group; a filter may err now and then
    skipped = [scanned(spark, asked(hashlib.sha256(b"absent %d" % i).hexdigest())) == 0 for i in range(12)]
    assert sum(skipped) >= 11
