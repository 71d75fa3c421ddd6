from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pingline.functions import columns as C
from pingline.operators import features, monitoring
from pingline.schemas import FEATURE_COLUMNS

T0 = datetime(2026, 3, 1, 10)


@pytest.mark.parametrize(
    "t,v,p,expected",
    [(75.0, 0.0, 9.0, "critical"), (74.9, 80.0, 9.0, "critical"), (0.0, 0.0, 2.0, "critical"),
     (60.0, 0.0, 9.0, "degraded"), (0.0, 50.0, 9.0, "degraded"), (0.0, 0.0, 3.0, "degraded"), (59.9, 49.9, 3.1, "healthy")],
)
def test_health(rows, t, v, p, expected):
    assert rows([(t, v, p)], "t double, v double, p double").select(C.machine_health("t", "v", "p")).first()[0] == expected


def readings(rows, data):
    return rows(data, "machine_id string, updated_at timestamp_ntz, temperature double, vibration double, pressure double, par_day string")


def test_status_uses_unrounded_means(rows):
    df = readings(rows, [("machine_01", T0, 59.999, 0.0, 9.0, "d"), ("machine_01", T0, 59.999, 0.0, 9.0, "d")])
    got = monitoring.machine_status(df, ["par_day"]).first()
    assert (got.status, got.temperature, got.readings_count) == ("healthy", 60.0, 2)


def test_factory_health_keeps_to_the_roster(rows):
    nine = [(f"machine_{i:02d}", T0, "healthy", "d") for i in range(1, 10)]
    schema = "machine_id string, updated_at timestamp_ntz, status string, par_day string"
    stray = [("machine_11", T0, "healthy", "d")]
    got = monitoring.factory_health(rows(nine + stray, schema), ["par_day"]).first()
    assert (got.healthy_count, got.total, got.all_healthy) == (9, 10, False)
    all_ten = monitoring.factory_health(rows(nine + [("machine_10", T0, "healthy", "d")], schema), ["par_day"]).first()
    assert all_ten.all_healthy is True


def test_latest_status_wins(rows):
    schema = "machine_id string, updated_at timestamp_ntz, status string, par_day string"
    df = rows([("m", T0 + timedelta(hours=1), "healthy", "d"), ("m", T0, "critical", "d")], schema)
    assert monitoring.latest_status(df, ["par_day"]).first().status == "healthy"
    assert "SortAggregate" not in monitoring.latest_status(df, ["par_day"])._jdf.queryExecution().executedPlan().toString()


def test_hour_summary(rows):
    df = readings(rows, [("machine_01", T0, None, 1.0, 4.0, "a"), ("machine_01", T0, 10.0, 3.0, 6.0, "a"), ("machine_02", T0, 5.0, 2.0, 5.0, "a")])
    days = rows([("a",), ("b",)], "par_day string")
    got = {r.par_day: r for r in monitoring.factory_hours(df, days, ["par_day"]).collect()}
    a, b = got["a"], got["b"]
    assert (a.total_readings, a.machine_count, a.avg_temperature, a.max_temperature, a.min_pressure) == (3, 2, 5.0, 10.0, 4.0)
    assert (b.total_readings, b.machine_count, b.avg_temperature, b.max_temperature, b.min_pressure) == (0, 0, 0.0, None, None)


@pytest.mark.parametrize("hour,expected", [(17, False), (18, True)])
def test_close_of_business(rows, hour, expected):
    df = rows([(1, datetime(2026, 3, 1, hour, 59))], "id int, ts timestamp_ntz")
    assert monitoring.batch_lag(df, ["id"]).first().cob_complete is expected


def test_lag_is_cut_to_whole_seconds(rows):
    df = rows([(1, T0), (1, T0 + timedelta(seconds=9))], "id int, ts timestamp_ntz")
    got = monitoring.batch_lag(df, ["id"], F.lit(T0 + timedelta(seconds=301, milliseconds=900)).cast("timestamp_ntz")).first()
    assert (got.transactions, got.oldest, got.lag_seconds) == (2, T0, 301)


def test_daily_summary(rows):
    got = monitoring.daily_summary(rows([("d", 5), ("d", None)], "date string, count long")).first()
    assert (got.batch_count, got.total_transactions) == (2, 5)


# ---- features -----------------------------------------------------------


def feature_rows(rows, n=5, income="200000"):
    data = [(i, "30", income, "600", "5", "0.25", "3", "1", "x") for i in range(n)]
    return rows(data, "row_id long, " + ", ".join(f"{c} string" for c in FEATURE_COLUMNS) + ", extra string")


def test_scaling_does_not_clip_and_drops_extras(rows):
    got = features.normalize(feature_rows(rows, 1)).first()
    assert got.income == round(185000 / 135000, 6) and got.income > 1
    assert (got.label, got.debt_ratio) == (1.0, 0.25) and "extra" not in got.asDict()


def test_missing_column_is_named(rows):
    with pytest.raises(ValueError, match=r"Missing expected columns: \['credit_score'\]"):
        features.normalize(feature_rows(rows).drop("credit_score"))


@pytest.mark.parametrize("n,train", [(1, 0), (4, 3), (5, 4), (300, 240)])
def test_split(spark, n, train):
    keys = spark.range(n).select((F.col("id") * 17 + 3).alias("k"))
    got = features.positional_split(keys, "k").orderBy("k").collect()
    assert [r.split for r in got] == ["train"] * train + ["test"] * (n - train)


def test_split_across_chunks(spark):
    keys = spark.range(1000).select((F.col("id") * 1000).alias("k"))
    assert features.cut_key(keys, "k", 0.8, chunk_size=7000) == 799_000


GATES = [
    ((None, "0.05", "h"), "missing required field: accuracy"),
    (("NaN", "0.05", "h"), "NaN detected in accuracy"),
    (("0.97", None, "h"), "missing required field: loss"),
    (("0.97", "nan", "h"), "NaN detected in loss"),
    (("abc", "x", "h"), "accuracy is not a number"),
    (("0.97", "x", "h"), "loss is not a number"),
    (("0.9499", "0.5", "h"), "accuracy 0.9499 below threshold 0.95"),
    (("0.95", "0.1", ""), "loss 0.1000 exceeds threshold 0.1"),
    (("0.95", "0.05", ""), "missing weights_hash"),
    (("0.95", "0.0999", "h"), "all checks passed"),
]


def test_gate_reports_the_first_failure(rows):
    df = rows([(i, *g) for i, (g, _) in enumerate(GATES)], "i int, accuracy string, loss string, weights_hash string")
    got = features.quality_gate(df).orderBy("i").collect()
    assert [r.reason for r in got] == [reason for _, reason in GATES]
    assert [r.passed for r in got] == [False] * 9 + [True]
    assert (got[1].accuracy_value, got[2].loss_value) == (0.0, 0.0)


def test_fingerprint_ignores_order(spark):
    df = spark.range(100).select("id", (F.col("id") * 2).alias("v"))
    a = features.fingerprint(df, ["id", "v"]).first()
    assert a == features.fingerprint(df.orderBy(F.desc("id")), ["id", "v"]).first()
    assert a != features.fingerprint(df.withColumn("v", F.col("v") + (F.col("id") == 5).cast("int")), ["id", "v"]).first()


def test_training_learns(spark):
    rows_ = spark.range(2000).select("id", *[F.rand(i).alias(c) for i, c in enumerate(C.FEATURE_RANGES)])
    rows_ = rows_.withColumn("label", (F.col("income") > 0.5).cast("double")).withColumn("split", F.when(F.col("id") < 1600, "train").otherwise("test"))
    got = features.train(rows_.cache()).first()
    assert got.accuracy > 0.95 and got.training_rows == 1600 and got.test_rows == 400


def test_promotion_takes_the_last_that_passed(rows):
    df = rows([(1, "v1", True, 0.96), (2, "v2", True, 0.97), (3, "v3", False, 0.0)], "run_no long, model_version string, passed boolean, accuracy_value double")
    assert [(r.model_version, r.accuracy) for r in features.promote(df, F.lit("d")).collect()] == [("v2", 0.97)]


def test_production_is_replaced_by_day(rows, tmp_path):
    schema = "run_no long, model_version string, passed boolean, accuracy_value double"
    day = F.floor(F.col("run_no") / 10).cast("string")
    path = str(tmp_path / "production")
    features.deploy(rows([(1, "v1", True, 0.96), (11, "v11", True, 0.97)], schema), day, path)
    table = features.deploy(rows([(12, "v12", True, 0.98), (13, "v13", False, 0.0)], schema), day, path)
    assert sorted((r.par_day, r.model_version) for r in table.collect()) == [("0", "v1"), ("1", "v12")]


# ---- scalars ------------------------------------------------------------


def test_period_keys(rows):
    df = rows([(datetime(2026, 3, 1, 4, 5),)], "t timestamp_ntz")
    got = df.select(C.par_day("t"), C.par_hour("t"), C.floor_window("t"), C.iso_seconds("t")).first()
    assert tuple(got) == ("20260301", "04", datetime(2026, 3, 1, 4), "2026-03-01T04:05:00Z")
    back = rows([("20260301", "04", "20260301T04")], "d string, h string, p string").select(C.period_start("d", "h"), C.parse_period("p")).first()
    assert back[0] == back[1] == datetime(2026, 3, 1, 4)


def test_tower_id_and_distance(rows):
    import hashlib

    df = rows([(29.95, -90.0715)], "lat double, lon double")
    assert df.select(C.tower_id("lat", "lon")).first()[0] == hashlib.md5(b"29.95,-90.0715").hexdigest()[:8]
    d = df.select(C.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()[0]
    assert abs(d - 111.19492664) < 1e-6
