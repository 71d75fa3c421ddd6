"""Structured Streaming jobs.

Every ``foreachBatch`` writes to a folder of its own batch number and overwrites
it, so a batch that is run again after a failure leaves one copy. Results are
read back from those folders; nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingline import schemas
from pingline.functions.columns import VALID_QUALITY, epoch_micros, machine_health, par_day, par_hour
from pingline.operators import monitoring, phones
from pingline.operators.completeness import DAILY_OF_HOURLY, DAILY_TARGETS, HOURS_PER_DAY, expected_in_window, with_stream_targets
from pingline.operators.quality import late
from pingline.session import stored
from pingline.sources import bronze
from pingline.sources.tables import table

FILES_PER_TRIGGER = 5


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 64) -> DataFrame:
    """The events table as a stream. ``ts`` becomes zoned, as watermarks require."""
    schema = table(spark, sf_dir, "events").schema
    # a one-character class makes the path a glob, which takes a file as well as a folder
    raw = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(f"{sf_dir}/events.parque[t]")
    )
    return with_zone(raw)


def with_zone(raw: DataFrame) -> DataFrame:
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def run_available(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """The same into Spark's own exactly-once file sink."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_writer(path: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df, name: str = "batch") -> Callable[[DataFrame, int], None]:
    """A folder per micro-batch, ``name`` being the column its number is read back as."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path}/{name}={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, name: str = "batch") -> DataFrame:
    return spark.read.parquet(path).withColumn(name, F.col(name).cast("bigint"))


def latest_per_key(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last row written per key of a change table."""
    last = changes.groupBy(*keys).agg(F.max("batch").alias("batch"))
    return changes.join(last, [*keys, "batch"], "left_semi").drop("batch")


# ---- ingest -------------------------------------------------------------


def raw_schema(stream: str) -> T.StructType:
    return T.StructType([*schemas.RAW[stream].fields, T.StructField("_corrupt_record", T.StringType())])


def raw_stream(spark: SparkSession, path: str, stream: str, glob: str = "*.jsonl.gz", files: int = FILES_PER_TRIGGER) -> DataFrame:
    raw = (
        spark.readStream.schema(raw_schema(stream))
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files)
        .json(path)
    )
    return bronze.with_period(raw)


SHAPES = {"cdr": bronze.bronze_calls, "seq": bronze.bronze_browses}
PHONES = {"cdr": ["phone_out", "phone_in"], "seq": ["phone_number"]}


def store_pings(batch: DataFrame, dimension: DataFrame, salt: str, stream: str, put: Callable[..., str]) -> None:
    """What a micro-batch of raw pings adds to bronze, quarantine, phones and counters.
    ``put`` writes a table by name, foldered by keys, and returns where.

    The batch's phones come first: they choose the few rows of the dimension that the rest is
    joined with, and a file that cannot be read fails before any ping is shuffled.

    The period counters are not written beside the rows: they are counted from what was
    stored, so the two cannot disagree.
    """
    batch.persist()  # parsed once
    try:
        good = bronze.good_rows(batch)
        found = stored(phones.distinct_phones(good, PHONES[stream]), "batch-phones")
        known = phones.known_phones(found, dimension)
        path = put(SHAPES[stream](good, known, salt).hint("rebalance", "par_day", "par_hour"), "bronze", "par_day", "par_hour")
        put(bronze.quarantined(batch), "quarantine")
        put(phones.new_rows(found, known, salt, F.current_timestamp().cast("timestamp_ntz")), "phones")
        counts = batch.sparkSession.read.schema("par_day string, par_hour string").parquet(path).groupBy("par_day", "par_hour")
        put(counts.agg(F.count(F.lit(1)).alias("records")), "counters")
    finally:
        batch.unpersist()


def bronze_ingest(raw: DataFrame, dimension: DataFrame, salt: str, out: str, checkpoint: str, stream: str = "cdr") -> None:
    """Raw pings of a stream to bronze, malformed rows to quarantine, unknown phones to the
    dimension's inserts.

    Bronze has period folders inside the batch's own folder, which a rerun replaces, so
    ``read_partition`` prunes it like the batch table.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        def put(df: DataFrame, name: str, *keys: str) -> str:
            path = f"{out}/{name}/batch={batch_id}"
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(path)
            return path

        store_pings(batch, dimension, salt, stream, put)

    run_available(raw, on_batch, checkpoint)


def ping_files(dimension: DataFrame, salt: str, stream: str = "cdr") -> tuple[Callable, Callable]:
    """The same for a list of raw files: what ``isolate.isolating`` stores and probes with."""

    def read(spark: SparkSession, paths: list[str]) -> DataFrame:
        return bronze.with_period(spark.read.schema(raw_schema(stream)).json(paths))

    def store(spark: SparkSession, paths: list[str], folder: Callable[[str], str]) -> None:
        def put(df: DataFrame, name: str, *keys: str) -> str:
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(folder(name))
            return folder(name)

        store_pings(read(spark, paths), dimension, salt, stream, put)

    def probe(spark: SparkSession, paths: list[str]) -> None:
        read(spark, paths).write.mode("overwrite").format("noop").save()

    return store, probe


def inserted_phones(spark: SparkSession, out: str) -> DataFrame:
    """Phones the ingest found; one that several batches met is one row."""
    return spark.read.parquet(f"{out}/phones").groupBy("phone", "hash").agg(F.min("created_at").alias("created_at"))


# ---- counters and sets --------------------------------------------------


def hourly_counts(events: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Rows and files per stream and hour. The window in the key lets finished hours leave
    the state; an hour's files are a handful of numbers."""
    return (
        events.withWatermark("ts", delay)
        .groupBy("stream", F.window("ts", "1 hour").alias("hour"))
        .agg(F.count(F.lit(1)).alias("records"), F.size(F.collect_set("file_no")).cast("bigint").alias("files"), F.max("ts").alias("updated_at"))
        .select("stream", par_day("hour.start").alias("par_day"), par_hour("hour.start").alias("par_hour"), "records", "files", "updated_at")
    )


def daily_hours(completions: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Completed hours per daily job and day, from the completions of its hourly job
    (pipelineId, date, ts); the flag is set when all 24 are there."""
    daily = F.create_map(*[F.lit(x) for pair in DAILY_OF_HOURLY.items() for x in pair])
    hour = F.regexp_extract("date", r"^.*T([^T]*)$", 1)
    return (
        completions.withColumn("pipelineId", F.try_element_at(daily, F.col("pipelineId"))).withColumn("hour", hour)
        .filter("pipelineId IS NOT NULL AND hour <> ''")
        .withWatermark("ts", delay)
        .groupBy("pipelineId", F.window("ts", "1 day").alias("day"))
        .agg(F.array_sort(F.collect_set("hour")).alias("completed_hours"))
        .select("pipelineId", F.date_format("day.start", "yyyy-MM-dd").alias("par_day"), "completed_hours",
                (F.size("completed_hours") >= HOURS_PER_DAY).alias("all_hours_complete"))
    )


# Rows behind the watermark never reach a batch of the four views above and below. The
# parts are summed up per micro-batch ahead of any state and put together when read back, so
# the order in which files arrive does not matter and nothing has to expire.


def hourly_parts(events: DataFrame) -> DataFrame:
    """What a micro-batch holds of every stream and hour."""
    return events.groupBy("stream", par_day("ts").alias("par_day"), par_hour("ts").alias("par_hour")).agg(
        F.count(F.lit(1)).alias("records"), F.collect_set("file_no").alias("files"), F.max("ts").alias("updated_at"))


def hours_of(parts: DataFrame) -> DataFrame:
    files = F.array_distinct(F.flatten(F.collect_set("files")))
    return parts.groupBy("stream", "par_day", "par_hour").agg(
        F.sum("records").alias("records"), F.size(files).cast("bigint").alias("files"), F.max("updated_at").alias("updated_at"))


def merged_hours(parts: DataFrame) -> DataFrame:
    """Parts of several micro-batches as one."""
    return parts.groupBy("stream", "par_day", "par_hour").agg(
        F.sum("records").alias("records"), F.array_distinct(F.flatten(F.collect_set("files"))).alias("files"), F.max("updated_at").alias("updated_at"))


def daily_parts(completions: DataFrame) -> DataFrame:
    """What a micro-batch holds of every daily job and day."""
    daily = F.create_map(*[F.lit(x) for pair in DAILY_OF_HOURLY.items() for x in pair])
    hour = F.regexp_extract("date", r"^.*T([^T]*)$", 1)
    return (
        completions.withColumn("pipelineId", F.try_element_at(daily, F.col("pipelineId"))).withColumn("hour", hour)
        .filter("pipelineId IS NOT NULL AND hour <> ''")
        .groupBy("pipelineId", F.date_format("ts", "yyyy-MM-dd").alias("par_day"))
        .agg(F.collect_set("hour").alias("completed_hours"))
    )


def merged_days(parts: DataFrame) -> DataFrame:
    return parts.groupBy("pipelineId", "par_day").agg(F.array_distinct(F.flatten(F.collect_set("completed_hours"))).alias("completed_hours"))


def days_of(parts: DataFrame) -> DataFrame:
    hours = F.array_sort(F.array_distinct(F.flatten(F.collect_set("completed_hours"))))
    return parts.groupBy("pipelineId", "par_day").agg(hours.alias("completed_hours")).withColumn(
        "all_hours_complete", F.size("completed_hours") >= HOURS_PER_DAY)


def window_volume(events: DataFrame, delay: str = "10 minutes", width: str = "15 minutes") -> DataFrame:
    """Rows per stream and window, emitted once when the watermark has passed its end."""
    return (
        events.withWatermark("ts", delay)
        .groupBy("stream", F.window("ts", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("records"))
        .select("stream", F.col("w.start").alias("window_start"), "records")
    )


def with_expected(volumes: DataFrame, targets: dict[str, int] = DAILY_TARGETS) -> DataFrame:
    """Window counts beside what the stream's fixed daily target expects of the window."""
    slot = F.hour("window_start") * 4 + F.floor(F.minute("window_start") / 15)
    out = with_stream_targets(volumes, targets)
    return out.withColumn("expected", expected_in_window("daily_target", slot.cast("int"))).drop("daily_target")


def suppress_duplicates(events: DataFrame, key: list[str], delay: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(key)


# ---- micro-batch jobs ---------------------------------------------------


def transaction_batches(events: DataFrame, path: str, checkpoint: str, now: Column | None = None) -> None:
    """Count, oldest event, lag and close of business of every micro-batch per day, against
    ``now`` (the batch's newest event when not given)."""

    def shape(batch: DataFrame) -> DataFrame:
        return monitoring.batch_lag(batch.withColumn("par_day", par_day("ts")), ["par_day"], now)

    run_available(events, batch_writer(path, shape), checkpoint)


def split_late(events: DataFrame, arrived: str, period_end, allowed_seconds: int, path: str, checkpoint: str) -> None:
    """Late rows go to a table of their own ahead of any watermark, which would drop them unseen."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        late(batch, arrived, period_end, allowed_seconds).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        on_time = batch.filter(epoch_micros(arrived) - epoch_micros(period_end) <= allowed_seconds * 1_000_000)
        on_time.write.mode("overwrite").parquet(f"{path}/on_time/batch={batch_id}")

    run_available(events, on_batch, checkpoint)


def weather_counts(readings: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Ten-minute counts of readings as they change. Spark holds the open batches only; the
    latch of a period follows from its latest counts."""
    return (
        readings.withWatermark("ts", delay)
        .groupBy(F.window("ts", "10 minutes").alias("w"), "period", "batch_no")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("quality") >= VALID_QUALITY).alias("valid"), F.max("ts").alias("arrived_at"))
        .drop("w")
    )


def machine_hours(readings: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Status of every machine and hour by the means of its readings, as they change."""
    return (
        readings.withWatermark("updated_at", delay)
        .groupBy("machine_id", F.window("updated_at", "1 hour").alias("w"))
        .agg(*[F.avg(m).alias(m) for m in monitoring.MEASURES], F.count(F.lit(1)).alias("readings_count"), F.max("updated_at").alias("updated_at"))
        .select("machine_id", par_day("w.start").alias("par_day"), par_hour("w.start").alias("par_hour"),
                machine_health(*monitoring.MEASURES).alias("status"), "readings_count", "updated_at")
    )


def weather_parts(readings: DataFrame) -> DataFrame:
    """What a micro-batch holds of every weather batch."""
    return readings.groupBy("period", "batch_no").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("quality") >= VALID_QUALITY).alias("valid"), F.max("ts").alias("arrived_at"))


def weather_of_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("period", "batch_no").agg(
        F.sum("total").alias("total"), F.sum("valid").alias("valid"), F.max("arrived_at").alias("arrived_at"))


def machine_parts(readings: DataFrame) -> DataFrame:
    """Sums a micro-batch holds of every machine and hour."""
    sums = [f(m).alias(f"{name}_{m}") for m in monitoring.MEASURES for name, f in (("sum", F.sum), ("count", F.count))]
    return readings.groupBy("machine_id", par_day("updated_at").alias("par_day"), par_hour("updated_at").alias("par_hour")).agg(
        *sums, F.count(F.lit(1)).alias("readings_count"), F.max("updated_at").alias("updated_at"))


def merged_machines(parts: DataFrame) -> DataFrame:
    sums = [F.sum(f"{name}_{m}").alias(f"{name}_{m}") for m in monitoring.MEASURES for name in ("sum", "count")]
    return parts.groupBy("machine_id", "par_day", "par_hour").agg(
        *sums, F.sum("readings_count").alias("readings_count"), F.max("updated_at").alias("updated_at"))


def machines_of(parts: DataFrame) -> DataFrame:
    means = [F.try_divide(F.sum(f"sum_{m}"), F.sum(f"count_{m}")).alias(m) for m in monitoring.MEASURES]
    return (
        parts.groupBy("machine_id", "par_day", "par_hour")
        .agg(*means, F.sum("readings_count").alias("readings_count"), F.max("updated_at").alias("updated_at"))
        .select("machine_id", "par_day", "par_hour", machine_health(*monitoring.MEASURES).alias("status"), "readings_count", "updated_at")
    )
