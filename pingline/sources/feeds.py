"""Readers and writers of the smaller feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingline import schemas


def machine_readings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MACHINE_READING).json(path)


def weather_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array."""
    return spark.read.schema(schemas.WEATHER_READING).option("multiLine", "true").json(path)


def feature_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, whatever the header names; the contract is checked later."""
    return spark.read.option("header", "true").csv(path)


def write_feature_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def model_artifacts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MODEL_ARTIFACT).json(path)


def parse_transactions(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Inline JSON transactions; the event time arrives as ISO text."""
    body = F.from_json(column, schemas.TRANSACTION)
    others = [c for c in payloads.columns if c != column]
    return (
        payloads.select(*others, body.alias("__body"))
        .select(*others, "__body.*")
        .withColumn("ts", F.to_timestamp_ntz("timestamp"))
        .drop("timestamp")
    )


def write_batch_summaries(summaries: DataFrame, path: str) -> None:
    summaries.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").json(path)


def batch_summaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("batch_id bigint, count bigint, oldest string, date string").json(path)
