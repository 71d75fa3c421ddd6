"""The event log as a table that answers range questions without reading all of it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingline.operators.eventlog import between


#: Columns that are asked for by value. Their row groups carry a Bloom filter; where a group holds
#: so few values that they fit a dictionary, the dictionary answers the same question instead.
BY_VALUE = ("pipelineId", "eventType")
#: Distinct values a row group's Bloom filter is sized for.
BLOOM_VALUES = 100_000


def write_log(log: DataFrame, path: str, mode: str = "append", row_group_bytes: int | None = None) -> None:
    """One folder per day, rows sorted by source, type and time: the row groups of a file then
    hold few sources and types each, and are skipped by their statistics and filters."""
    writer = log.hint("rebalance", "date").sortWithinPartitions("date", *BY_VALUE, "timestamp").write.mode(mode).partitionBy("date")
    for column in BY_VALUE:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", BLOOM_VALUES)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.block.size.row.check.min", 10)
    writer.parquet(path)


def _day(ms: int) -> str:
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).strftime("%Y-%m-%d")


def read_range(
    spark: SparkSession, path: str, start_ms: int, end_ms: int, source: str | None = None, event_type: str | None = None
) -> DataFrame:
    """A time range, of one source or type if asked; only the folders of its days are listed."""
    days = F.col("date").between(_day(start_ms), _day(end_ms))
    return between(spark.read.parquet(path).filter(days), start_ms, end_ms, source, event_type)


def read_type(spark: SparkSession, path: str, event_type: str) -> DataFrame:
    """All events of one type. The filter stays on the stored column, so row groups without
    the type are not read."""
    return spark.read.parquet(path).filter(F.col("eventType") == event_type)


def days(spark: SparkSession, path: str) -> list[str]:
    """Days the store has a folder for, newest first. Only the first level is listed."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    names = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted((n.split("=", 1)[1] for n in names if n.startswith("date=")), reverse=True)


def read_days(spark: SparkSession, path: str, some: list[str]) -> DataFrame:
    return spark.read.option("basePath", path).parquet(*(f"{path}/date={d}" for d in some))


def read_newest(spark: SparkSession, path: str, n: int, source: str | None = None, event_type: str | None = None) -> DataFrame:
    """The newest ``n`` events, of one source or type if asked. Day folders are read from the
    newest backwards, twice as many at each step, until they hold n; what is older is neither
    listed nor opened. A source with few events costs log2(days) steps."""
    mine = F.lit(True)
    if source is not None:
        mine = mine & (F.col("pipelineId") == source)
    if event_type is not None:
        mine = mine & (F.col("eventType") == event_type)
    every = days(spark, path)
    if not every:
        raise FileNotFoundError(f"{path} holds no day")
    used, step, found = 0, 1, 0
    while used < len(every) and found < n:
        some = every[used:used + step]
        found += read_days(spark, path, some).filter(mine).limit(n).count()
        used, step = used + len(some), 2 * step
    return read_days(spark, path, every[:used]).filter(mine).orderBy(F.desc("timestamp"), F.desc("event_id")).limit(n)
