"""Tumbling-window counts that late rows correct instead of vanishing.

The watermark is kept with the stream's own output: after a micro-batch it is the newest event
time so far less the allowed delay. A window that it passes is written once, as revision 0.
Rows of a window that is already written come ahead of any stateful operator, so none is
dropped: they are counted, added to the window they belong to, and written as its next revision
beside the change they make. A reader takes the highest revision of a window; the corrections
are the rows above revision 0.

Open windows travel from batch to batch as a table of their running counts (``open``), so a
batch reads the windows that are open and the days its late rows belong to, never the history.
All a micro-batch writes lies in folders of its own number, which a rerun overwrites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pingline.functions.columns import epoch_micros, floor_window, par_day

#: Before the first row.
NEVER = -(1 << 62)


class CorrectedWindows:
    """Counts per key and window of ``seconds``, below ``path``. ``keys`` are names and types."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], ts: str = "ts", seconds: int = 900, delay_seconds: int = 600):
        self.spark, self.path, self.ts, self.seconds = spark, path.rstrip("/"), ts, seconds
        self.width, self.delay = seconds * 1_000_000, delay_seconds * 1_000_000
        self.key = [*keys, "window_start"]
        typed = ", ".join(f"{k} {t}" for k, t in keys.items())
        self._open = f"{typed}, window_start timestamp_ntz, records long"
        self._written = f"{typed}, window_start timestamp_ntz, revision int, records long, change long, par_day string, batch long, by string"

    def _there(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def _watermark(self, batch_id: int) -> int:
        """The newest event time of all batches before this one, in microseconds."""
        before = f"{self.path}/progress/batch={batch_id - 1}"
        return self.spark.read.schema("newest long").parquet(before).first()[0] if self._there(before) else NEVER

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        counts = batch.where(F.col(self.ts).isNotNull()).withColumn("window_start", floor_window(self.ts, self.seconds)).groupBy(*self.key).agg(
            F.count(F.lit(1)).alias("records"), F.max(epoch_micros(self.ts)).alias("newest")).persist()
        before = self._watermark(batch_id)
        after = max(before, counts.agg(F.coalesce(F.max("newest"), F.lit(NEVER))).first()[0])
        end = epoch_micros("window_start") + self.width
        passed = end <= before - self.delay
        self._write(self._revised(counts.where(passed), batch_id), batch_id, "late")

        here = counts.where(~passed).select(*self.key, "records")
        kept = f"{self.path}/open/batch={batch_id - 1}"
        if self._there(kept):
            here = here.unionByName(self.spark.read.schema(self._open).parquet(kept))
        running = here.groupBy(*self.key).agg(F.sum("records").alias("records")).persist()
        done = running.where(end <= after - self.delay)
        self._write(done.withColumns({"revision": F.lit(0), "change": F.col("records")}), batch_id, "watermark")
        running.where(end > after - self.delay).write.mode("overwrite").parquet(f"{self.path}/open/batch={batch_id}")
        self.spark.range(1).select(F.lit(after).alias("newest")).write.mode("overwrite").parquet(f"{self.path}/progress/batch={batch_id}")
        running.unpersist()
        counts.unpersist()

    def _revised(self, late: DataFrame, batch_id: int) -> DataFrame:
        """The next revision of every window that late rows belong to. A window that was empty
        when the watermark passed it has no revision 0; its first row is a correction too."""
        changes = late.select(*self.key, F.col("records").alias("change"))
        days = [r[0] for r in late.select(par_day("window_start")).distinct().collect()]  # of this batch's late rows
        known = [p for p in (f"{self.path}/windows/par_day={d}" for d in days) if self._there(p)]
        if not known:
            return changes.withColumns({"records": F.col("change"), "revision": F.lit(1)})
        rows = self.spark.read.schema(self._written).option("basePath", f"{self.path}/windows").parquet(*known)
        last = rows.where(F.col("batch") < batch_id).groupBy(*self.key).agg(F.max("revision").alias("was"), F.sum("change").alias("so_far"))
        return changes.join(last, self.key, "left").select(
            *self.key, "change", (F.coalesce("so_far", F.lit(0)) + F.col("change")).alias("records"), (F.coalesce("was", F.lit(0)) + 1).alias("revision"))

    def _write(self, rows: DataFrame, batch_id: int, by: str) -> None:
        out = rows.select(*self.key, F.col("revision").cast("int").alias("revision"), "records", "change",
                          par_day("window_start").alias("par_day"), F.lit(batch_id).cast("long").alias("batch"), F.lit(by).alias("by"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("par_day", "batch", "by").parquet(f"{self.path}/windows")

    def changes(self) -> DataFrame:
        """Every revision of every window, and the batch that wrote it. ``change`` is what the
        revision adds, all of it for revision 0."""
        return self.spark.read.schema(self._written).parquet(f"{self.path}/windows").select(*self.key, "revision", "records", "change", "batch")

    def corrections(self) -> DataFrame:
        return self.changes().where(F.col("revision") > 0)

    def current(self) -> DataFrame:
        """The last revision of every window the watermark has passed."""
        last = Window.partitionBy(*self.key).orderBy(F.col("revision").desc())
        return self.changes().withColumn("place", F.row_number().over(last)).where("place = 1").select(*self.key, "records", "revision")
