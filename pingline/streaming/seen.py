"""Duplicate suppression against a stored index of every key ever met.

No watermark bounds what is recognised: a key delivered again after a year is still known. The
index is a table of keys, foldered by a hash of the key. A micro-batch reads only the folders
its own keys fall into, and within each only the files whose key range meets the batch, as keys
are sorted inside a folder. New keys and new rows are written to folders of the batch's number,
so a batch that is run again forgets what its first attempt wrote and finds the same rows new.

Folders grow by one file per micro-batch that touches them. ``compact`` merges the files of
finished batches into one per folder; readers of the index are the batches themselves, so it
runs between two of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of the index. Fixed for the life of a stream: it decides where a key is looked for.
BUCKETS = 64


class SeenKeys:
    """Rows of a stream without those whose ``key`` columns came before, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = BUCKETS, compact_every: int = 16):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.buckets, self.compact_every = buckets, compact_every

    def _folder(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _index(self, schema: str, buckets: list[int], batch_id: int) -> DataFrame | None:
        """Keys of these buckets that earlier batches met."""
        there = []
        for b in buckets:
            path, files = self._folder(f"index/bucket={b}")
            if files.exists(path):
                there.append(f"{self.path}/index/bucket={b}")
        if not there:
            return None
        rows = self.spark.read.schema(f"{schema}, bucket int, batch long").option("basePath", f"{self.path}/index").parquet(*there)
        return rows.where(F.col("batch") < batch_id)

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        fields = {f.name: f.dataType.simpleString() for f in batch.schema.fields}
        schema = ", ".join(f"`{k}` {fields[k]}" for k in self.key)
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        # of equal keys inside the batch one row stays; it is then known whether it is new
        once = batch.dropDuplicates(self.key).withColumn("bucket", bucket).persist()
        touched = [r[0] for r in once.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        known = self._index(schema, touched, batch_id)
        fresh = once
        if known is not None:
            names = [f"known_{k}" for k in (*self.key, "bucket")]
            known = known.select(*self.key, "bucket").toDF(*names)
            # null keys are equal to one another, as they are to dropDuplicates
            same = F.lit(True)
            for k, n in zip((*self.key, "bucket"), names):
                same = same & F.col(k).eqNullSafe(F.col(n))
            fresh = once.join(known, same, "left_anti")
        fresh = fresh.persist()
        fresh.drop("bucket").write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")
        keys = fresh.select(*self.key, "bucket", F.lit(batch_id).cast("long").alias("batch"))
        keys.repartition("bucket").sortWithinPartitions("bucket", *self.key).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{self.path}/index")
        fresh.unpersist()
        once.unpersist()
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            self.compact(schema, batch_id)

    def compact(self, schema: str, before: int) -> None:
        """One file per folder for all batches before ``before``, under the number of the last of
        them. The merged copy is written first; keys that stand twice for a while do no harm."""
        path, files = self._folder("index")
        for status in files.listStatus(path):
            name = status.getPath().getName()
            if not name.startswith("bucket="):
                continue
            old = sorted(int(s.getPath().getName().split("=")[1]) for s in files.listStatus(status.getPath()) if s.getPath().getName().startswith("batch="))
            old = [b for b in old if b < before]
            if len(old) < 2:
                continue
            folders = [f"{self.path}/index/{name}/batch={b}" for b in old]
            merged = f"{self.path}/merging/{name}"
            self.spark.read.schema(schema).parquet(*folders).sort(*self.key).write.mode("overwrite").parquet(merged)
            # older files go only when the merged one stands beside them
            target, _ = self._folder(f"index/{name}/batch={old[-1]}")
            for part in files.listStatus(self._folder(f"merging/{name}")[0]):
                if part.getPath().getName().endswith(".parquet"):
                    files.rename(part.getPath(), self.spark._jvm.org.apache.hadoop.fs.Path(target, f"merged-{part.getPath().getName()}"))
            for s in files.listStatus(target):
                if not s.getPath().getName().startswith("merged-"):
                    files.delete(s.getPath(), False)
            for b in old[:-1]:
                files.delete(self._folder(f"index/{name}/batch={b}")[0], True)

    def rows(self) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows").drop("batch")
