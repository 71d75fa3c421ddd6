"""The domain inputs, derived from the given tables. Every function keeps all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingline.functions.columns import epoch_micros, par_day, par_hour

SOURCES = ["bronze-cdr", "bronze-seq", "silver-cdr-hour", "silver-seq-hour", "silver-cdr-day", "silver-seq-day"]


#: Schemas by path and modification time: a footer is read once, and again when the table changes.
_SCHEMAS: dict[tuple[str, int], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with the schema it has now."""
    path = f"{sf_dir}/{name}.parquet"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    changed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(folder).getModificationTime()
    if (path, changed) not in _SCHEMAS:
        _SCHEMAS[path, changed] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path, changed]).parquet(path)


def with_keys(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        par_day("ts").alias("par_day"),
        par_hour("ts").alias("par_hour"),
    )


def events(spark, sf_dir) -> DataFrame:
    return with_keys(table(spark, sf_dir, "events"))


def calls_of(evt: DataFrame) -> DataFrame:
    return evt.select(
        F.col("user_id").cast("string").alias("phone_out"),
        F.concat(F.lit("c"), F.col("k")).alias("phone_in"),
        F.col("event_type").alias("cell_tower"),
        F.col("ts").alias("time"),
        "par_day", "par_hour",
    )


def calls(spark, sf_dir) -> DataFrame:
    return calls_of(events(spark, sf_dir))


def browses(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("phone_number"),
        F.concat(F.lit("T"), F.col("k") % 20).alias("cell_tower"),
        F.concat(F.lit("www."), "event_type", F.lit(".com")).alias("host_name"),
        F.upper("event_type").alias("site_name"),
        F.col("ts").alias("time"),
        "par_day", "par_hour",
    )


def phone_dimension(spark, sf_dir) -> DataFrame:
    """Every customer number is already known, some under the hash of an older salt."""
    phone = F.col("c_custkey").cast("string")
    old = F.sha2(F.concat(F.lit("old"), phone), 256)
    new = F.sha2(F.concat(F.lit("salt"), phone), 256)
    return table(spark, sf_dir, "customer").select(
        phone.alias("phone"),
        F.when(F.col("c_nationkey") < 8, old).otherwise(new).alias("hash"),
        F.lit("2023-12-31 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )


def stream_of(event_type: str = "event_type"):
    return F.when(F.col(event_type).isin("view", "click"), "seq").otherwise("cdr")


def deliveries(spark, sf_dir) -> DataFrame:
    """One row per ping with its stream and quarter-hour file."""
    return events(spark, sf_dir).select(
        stream_of().alias("stream"), "par_day", "par_hour",
        F.floor(F.minute("ts") / 15).cast("int").alias("file_no"),
        "event_id", "ts", "k",
    )


def files(spark, sf_dir) -> DataFrame:
    return (
        deliveries(spark, sf_dir)
        .groupBy("stream", "par_day", "par_hour", "file_no")
        .agg(F.count(F.lit(1)).alias("records"), F.max("ts").alias("arrived_at"))
    )


def with_machine(evt: DataFrame) -> DataFrame:
    """Events, each also a reading of one of eleven machines."""
    return evt.select(
        *evt.columns,
        F.concat(F.lit("machine_"), F.lpad((F.col("user_id") % 11 + 1).cast("string"), 2, "0")).alias("machine_id"),
        (20 + F.col("value") % 60).alias("temperature"),
        ((F.col("value") * 7) % 100).alias("vibration"),
        (1 + (F.col("event_id") % 90) / F.lit(10.0)).alias("pressure"),
    )


def machine_readings_of(evt: DataFrame) -> DataFrame:
    return with_machine(evt).select(
        "machine_id", F.col("ts").alias("updated_at"), "temperature", "vibration", "pressure", "par_day", "par_hour", "event_id", "k"
    )


def machine_readings(spark, sf_dir) -> DataFrame:
    return machine_readings_of(events(spark, sf_dir))


def transactions(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("transaction_id"),
        F.concat(F.lit("ACCT-"), 100000 + F.col("user_id")).alias("account_id"),
        F.col("event_type").alias("type"),
        F.col("value").alias("amount"),
        "ts",
        F.floor(F.col("event_id") / 100).cast("bigint").alias("batch_id"),
        "par_day", "par_hour",
    )


def weather(spark, sf_dir) -> DataFrame:
    return weather_of(events(spark, sf_dir))


def weather_of(evt: DataFrame) -> DataFrame:
    return evt.select(
        F.concat(F.lit("WX-"), F.lpad((F.col("user_id") % 10 + 1).cast("string"), 3, "0")).alias("station_id"),
        (5 + F.col("value") % 35).alias("temperature_c"),
        (20 + (F.col("value") * 3) % 75).alias("humidity_pct"),
        (F.lit(0.6) + (F.col("k") % 41) / F.lit(100.0)).alias("quality"),
        "ts",
        F.concat("par_day", F.lit("T"), "par_hour").alias("period"),
        F.floor(F.minute("ts") / 10).cast("int").alias("batch_no"),
    )


def features(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("row_id"),
        (18 + key % 63).alias("age"),
        (15000 + F.abs("c_acctbal") * 14).alias("income"),
        (300 + (key * 37) % 551).alias("credit_score"),
        F.least(key % 63, key % 46).alias("employment_years"),
        ((key % 101) / F.lit(100.0)).alias("debt_ratio"),
        (1 + key % 15).alias("num_accounts"),
    )


def models(spark, sf_dir) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("run_no"),
        F.concat(F.lit("v1.0."), key).alias("model_version"),
        F.when(key % 23 == 0, "abc").when(key % 7 != 0, (90 + key % 10).cast("string")).alias("accuracy_pct"),
        F.when(key % 19 == 0, "x").when(key % 11 == 0, "NaN").otherwise((key % 20).cast("string")).alias("loss_pct"),
        F.when(key % 13 == 0, "").otherwise(F.md5("s_name")).alias("weights_hash"),
    )


def event_log_of(evt: DataFrame) -> DataFrame:
    e, v = F.col("event_type"), F.col("value")
    names = F.array(*[F.lit(s) for s in SOURCES])
    return evt.select(
        "event_id",
        F.element_at(names, (F.col("user_id") % 6 + 1).cast("int")).alias("pipelineId"),
        F.when((e == "error") & (v >= 50), "SLA_BREACH")
        .when(e == "error", "JOB_FAILED")
        .when(e == "click", "JOB_TRIGGERED")
        .when(e == "view", "SLA_MET")
        .when(e == "purchase", "JOB_COMPLETED")
        .otherwise("SLA_WARNING")
        .alias("eventType"),
        F.floor(epoch_micros("ts") / 1000).cast("bigint").alias("timestamp"),
        F.concat(F.lit("event "), F.col("event_id")).alias("message"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.lit("daily").alias("scheduleId"),
    )


def event_log(spark, sf_dir) -> DataFrame:
    return event_log_of(events(spark, sf_dir))


def towers(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    key = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("tower_no"),
            F.substring(F.md5("s_name"), 1, 8).alias("tower_id"),
            (35 + F.col("s_acctbal") / 12000).alias("lat"),
            (-100 + (key % 25) * F.lit(0.05)).alias("lon"),
            "city",
        )
    )


def handoffs(spark, sf_dir) -> DataFrame:
    """Tower changes of a phone; the other events are the probes."""
    return events(spark, sf_dir).select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "signup", F.concat(F.lit("T"), F.col("k") % 20)).alias("tower")
    )


def sessions(spark, sf_dir) -> DataFrame:
    """One session per order; the key spreads the starts over the day."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("session_id"),
        F.expr("o_orderdate + make_dt_interval(0, 0, CAST(o_orderkey % 1440 AS INT), 0)").alias("start_ts"),
        (10 + key % 890).cast("int").alias("duration_s"),
    )


def sites(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("rank"),
        F.concat(F.lit("www.p"), "p_partkey", F.lit(".com")).alias("host_name"),
        F.col("p_brand").alias("site_name"),
    )
