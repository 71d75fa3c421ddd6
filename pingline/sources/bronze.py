"""Raw JSON lines in, partitioned bronze and silver tables in and out."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingline import schemas
from pingline.functions.columns import iso_seconds, ntz, par_day, par_hour
from pingline.operators.phones import pseudonymise

# fixed values: the raw key layout
PERIOD_IN_PATH = r"par_day=(\d{8})/par_hour=(\d{2})"
RAW_FILE = r"\.jsonl\.gz$"
SPARK_RAW_FILE = r"\.json(l)?\.gz$"
MAX_RECORDS_PER_FILE = 100_000


def route(path: Column | str, root: str = "", file_pattern: str = RAW_FILE) -> Column:
    """Stream and period named by a raw file's path, null when the file is to be skipped."""
    p = F.col(path) if isinstance(path, str) else path
    stream = F.regexp_extract(p, f"{re.escape(root)}/?(cdr|seq)/" if root else r"^/?(cdr|seq)/", 1)
    day, hour = F.regexp_extract(p, PERIOD_IN_PATH, 1), F.regexp_extract(p, PERIOD_IN_PATH, 2)
    keep = (stream != "") & (day != "") & p.rlike(file_pattern)
    return F.when(keep, F.struct(stream.alias("stream"), day.alias("par_day"), hour.alias("par_hour")))


def read_raw(
    spark: SparkSession, path: str, stream: str, glob: str = "*.jsonl.gz", fail_fast: bool = False
) -> DataFrame:
    """Raw pings of one stream with the period taken from the path, not from the event.

    A malformed line either fails the read or is kept in ``_corrupt_record``.
    """
    schema = schemas.RAW[stream]
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if fail_fast:
        reader = reader.schema(schema).option("mode", "FAILFAST")
    else:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())]))
    return with_period(reader.json(path))


def with_period(raw: DataFrame) -> DataFrame:
    source = F.col("_metadata.file_path")
    return raw.select(
        *raw.columns,
        F.regexp_extract(source, PERIOD_IN_PATH, 1).alias("par_day"),
        F.regexp_extract(source, PERIOD_IN_PATH, 2).alias("par_hour"),
    ).filter(F.col("par_day") != "")


def good_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def quarantined(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("_corrupt_record").isNotNull()).select("_corrupt_record", "par_day", "par_hour")


def write_raw(pings: DataFrame, path: str, max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Raw gzip JSON lines in folders of the event's own hour.

    Rebalancing gives a small hour one file and splits an hour that holds a large
    share of the rows over several tasks.
    """
    text = pings.withColumn("par_day", par_day("time")).withColumn("par_hour", par_hour("time"))
    text = text.withColumn("time", iso_seconds("time"))
    (
        text.hint("rebalance", "par_day", "par_hour")
        .write.mode("overwrite")
        .partitionBy("par_day", "par_hour")
        .option("maxRecordsPerFile", max_records)
        .option("compression", "gzip")
        .json(path)
    )


def bronze_calls(raw: DataFrame, dimension: DataFrame, salt: str) -> DataFrame:
    hashed = pseudonymise(raw, {"phone_out": "phone_hash_out", "phone_in": "phone_hash_in"}, dimension, salt)
    return hashed.withColumn("time", F.col("time").cast("timestamp")).select(*schemas.BRONZE_CALL_COLUMNS)


def bronze_browses(raw: DataFrame, dimension: DataFrame, salt: str) -> DataFrame:
    hashed = pseudonymise(raw, {"phone_number": "phone_hash"}, dimension, salt)
    return hashed.withColumn("time", F.col("time").cast("timestamp")).select(*schemas.BRONZE_BROWSE_COLUMNS)


def write_partitioned(df: DataFrame, path: str, keys: list[str], mode: str = "append") -> None:
    """Append, or with ``mode="overwrite"`` replace just the periods present in ``df``."""
    df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)


def read_partition(
    spark: SparkSession,
    path: str,
    day: Column | str | None = None,
    hour: Column | str | None = None,
    view: str | None = None,
) -> DataFrame:
    """A partitioned table, or one day or hour of it; the filters stay on the raw
    partition columns so that whole folders are pruned. ``view`` names it for SQL."""
    df = spark.read.parquet(path)
    if day is not None:
        df = df.filter(F.col("par_day") == day)
    if hour is not None:
        df = df.filter(F.col("par_hour") == hour)
    if view is not None:
        df.createOrReplaceTempView(view)
    return df


def write_silver(df: DataFrame, path: str, day: str, hour: str | None = None, mode: str = "append") -> None:
    """Stamp one job's period on its result and store it."""
    keys = ["par_day"] if hour is None else ["par_day", "par_hour"]
    out = df.withColumn("par_day", F.lit(day))
    if hour is not None:
        out = out.withColumn("par_hour", F.lit(hour))
    write_partitioned(out, path, keys, mode)


def job_period(args: dict[str, str], now: datetime, hourly: bool) -> dict[str, str]:
    """Arguments of a scheduled job; an absent period is the previous hour or day."""
    if not args.get("bucket"):
        raise ValueError("bucket is required")
    before = now - (timedelta(hours=1) if hourly else timedelta(days=1))
    period = {"par_day": f"{before:%Y%m%d}"}
    if hourly:
        period["par_hour"] = f"{before:%H}"
    return {**period, **args}


def as_ntz(df: DataFrame) -> DataFrame:
    """Timestamps as zone-free UTC values, for results that leave the cluster."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    for name in zoned:
        df = df.withColumn(name, ntz(name))
    return df
