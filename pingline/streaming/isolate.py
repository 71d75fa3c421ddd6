"""Ingest that one unreadable file cannot stop.

The stream is one of file notifications: paths, sizes and times, without contents, a handful
per micro-batch. The files of a micro-batch are read and stored together. If that fails, they
are halved by a ``probe`` that reads and keeps nothing, until each file that cannot be read is
alone; after as many attempts as are allowed it goes to a dead-letter table with its error, and
the rest is stored together. n files with b bad ones take about 2 * b * log2(n) probes. Where
every file can be read but storing still fails, the storing itself is halved.

All that a micro-batch stores lies in ``<table>/batch=<n>/piece=<p>``. What failed is removed
before anything else is tried, and a micro-batch that is run again starts by removing what its
first attempt left, so no row is stored twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FILES, ATTEMPTS = 5, 3
DEAD = "path string, error string, attempts int"
#: Of an error's text this much is kept.
ERROR_CHARS = 2000

Probe = Callable[[SparkSession, list[str]], None]
Store = Callable[[SparkSession, list[str], Callable[[str], str]], None]


def notifications(spark: SparkSession, path: str, glob: str, files: int = FILES) -> DataFrame:
    """A stream of (path, length, modificationTime) of the files below ``path``. The contents
    are a column nobody asks for, so they are not read."""
    raw = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files)
        .load(path)
    )
    return raw.select("path", "length", "modificationTime")


def remove(spark: SparkSession, pattern: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(pattern).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(hadoop.Path(pattern)) or []:
        files.delete(found.getPath(), True)


def failing(spark: SparkSession, paths: list[str], probe: Probe, attempts: int = ATTEMPTS) -> dict[str, str]:
    """The files that cannot be read, and why."""
    error = ""
    for _ in range(attempts if len(paths) == 1 else 1):
        try:
            probe(spark, paths)
            return {}
        except Exception as e:  # whatever a file does to the reader
            error = f"{type(e).__name__}: {e}"[:ERROR_CHARS]
    if len(paths) == 1:
        return {paths[0]: error}
    half = len(paths) // 2
    return failing(spark, paths[:half], probe, attempts) | failing(spark, paths[half:], probe, attempts)


def isolating(out: str, store: Store, probe: Probe, attempts: int = ATTEMPTS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` over notifications. ``store`` reads the given files and writes tables
    to the folders it is given by name; ``probe`` only reads them."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        paths = sorted(r["path"] for r in batch.select("path").collect())  # as many as a trigger takes
        remove(spark, f"{out}/*/batch={batch_id}")

        def stored(some: list[str], piece: str) -> str | None:
            """The error, if storing failed."""
            try:
                store(spark, some, lambda table: f"{out}/{table}/batch={batch_id}/piece={piece}")
                return None
            except Exception as e:
                remove(spark, f"{out}/*/batch={batch_id}/piece={piece}")
                return f"{type(e).__name__}: {e}"[:ERROR_CHARS]

        def halved(some: list[str], piece: str) -> dict[str, str]:
            error = stored(some, piece)
            if error is None:
                return {}
            if len(some) == 1:
                return {some[0]: error}
            half = len(some) // 2
            return halved(some[:half], piece + "l") | halved(some[half:], piece + "r")

        dead: dict[str, str] = {}
        if paths and stored(paths, "all") is not None:
            dead = failing(spark, paths, probe, attempts)
            rest = [p for p in paths if p not in dead]
            if rest:
                dead |= halved(rest, "rest")
        rows = [(path, error, attempts) for path, error in dead.items()]
        spark.createDataFrame(rows, DEAD).write.mode("overwrite").parquet(f"{out}/dead/batch={batch_id}")

    return on_batch


def dead_letters(spark: SparkSession, out: str) -> DataFrame:
    """Files no attempt could read: path, error, attempts, batch."""
    return spark.read.schema(f"{DEAD}, batch long").parquet(f"{out}/dead")
