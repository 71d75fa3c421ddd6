"""A log of inline records, and a streaming source that reads it by offset.

The log is a folder of segments, text files named ``<first record>-<records>.jsonl``, one record
a line. Record numbers are the stream's offsets, so Spark's checkpoint says where a query stands:
a restart repeats no record, and a batch that is planned again reads the same ones. The driver
sees segment names only; the lines are read by tasks, one per segment and micro-batch.

Consumers take records in batches of a fixed size, 100 for inline transactions and 5 for file
notifications. Which batch a record falls into is its number divided by that size, so it does
not depend on how many micro-batches the records came in.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

INLINE_BATCH, NOTIFICATION_BATCH = 100, 5
SCHEMA = "record long, batch long, payload string"


def append_records(payloads: DataFrame, path: str, records_per_segment: int = 100_000) -> int:
    """Add the rows of a one-column frame to the log, in their order; the log's length."""
    spark = payloads.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    at = max((sum(map(int, f.getPath().getName().split(".")[0].split("-"))) for f in files.listStatus(folder) if f.getPath().getName().endswith(".jsonl")), default=0)
    aside = f"{path}/_new"
    payloads.write.mode("overwrite").option("maxRecordsPerFile", records_per_segment).text(aside)
    counted = spark.read.text(aside).groupBy(F.col("_metadata.file_name").alias("name")).count().collect()  # a row per file
    for name, n in sorted(counted):
        files.rename(hadoop.Path(f"{aside}/{name}"), hadoop.Path(f"{path}/{at:020d}-{n}.jsonl"))
        at += n
    files.delete(hadoop.Path(aside), True)
    return at


class Segment(InputPartition):
    def __init__(self, path: str, first: int, low: int, high: int):
        self.path, self.first, self.low, self.high = path, first, low, high


class RecordReader(DataSourceStreamReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def _segments(self) -> list[tuple[str, int, int]]:
        """(path, first record, end), in order."""
        store, root = _store(self.path)
        out = []
        for info in store.get_file_info(pyarrow.fs.FileSelector(root)):
            if info.is_file and info.base_name.endswith(".jsonl"):
                first, n = map(int, info.base_name.split(".")[0].split("-"))
                out.append((info.path, first, first + n))
        return sorted(out, key=lambda s: s[1])

    def initialOffset(self) -> dict:
        return {"record": 0}

    def latestOffset(self) -> dict:
        end = 0
        for _, first, after in self._segments():
            if first != end:
                break  # a segment that is not yet there: what lies behind it waits
            end = after
        return {"record": end}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        low, high = start["record"], end["record"]
        return [Segment(path, first, max(low, first), min(high, after)) for path, first, after in self._segments() if first < high and after > low]

    def read(self, partition: Segment) -> Iterator[tuple]:
        store, _ = _store(self.path)
        with store.open_input_stream(partition.path) as raw:
            for number, line in enumerate(_lines(raw), partition.first):
                if number >= partition.high:
                    return
                if number >= partition.low:
                    yield number, number // self.size, line


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def _lines(raw, size: int = 1 << 20) -> Iterator[str]:
    rest = b""
    while chunk := raw.read(size):
        *lines, rest = (rest + chunk).split(b"\n")
        for line in lines:
            yield line.decode("utf-8", "replace")
    if rest:
        yield rest.decode("utf-8", "replace")


class RecordLog(DataSource):
    """Format ``record_log``; options ``path`` and ``batch``."""

    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> RecordReader:
        return RecordReader(self.options["path"], int(self.options.get("batch", INLINE_BATCH)))


def record_stream(spark: SparkSession, path: str, batch: int = INLINE_BATCH) -> DataFrame:
    """The log as a stream of (record, batch, payload)."""
    spark.dataSource.register(RecordLog)
    return spark.readStream.format("record_log").option("path", path).option("batch", batch).load()
