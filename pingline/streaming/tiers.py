"""What micro-batches leave behind, merged in tiers.

Every micro-batch adds a part to level 0. As soon as a level holds ``fan`` parts, they are
merged into one part of the next level, so after n batches at most ``fan - 1`` parts stand on
each of log(n) levels, and reading everything back opens that many folders however long the
stream has run. A merge adds up what the parts hold per key; each row is rewritten once a level.

A manifest names the parts that count, and the batches each one covers. It is written under a
new number when a batch is done, and readers follow the highest number, so a reader never sees
a part twice or half merged. A batch that is run again after a failure finds itself covered and
adds nothing, or replaces the part that no manifest names yet.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FAN = 8
#: Manifests kept for readers that started from an older one.
KEEP = 3


class Tiers:
    """Parts below ``path``. ``merge`` adds up the rows of several parts into rows of one."""

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], fan: int = FAN):
        self.spark, self.path, self.merge, self.fan = spark, path.rstrip("/"), merge, fan
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def _versions(self) -> list[int]:
        folder = self._at("manifests")
        if not self._files.exists(folder):
            return []
        return sorted(int(f.getPath().getName()) for f in self._files.listStatus(folder) if f.getPath().getName().isdigit())

    def parts(self) -> list[dict]:
        """Live parts: level, first and last batch, folder."""
        versions = self._versions()
        if not versions:
            return []
        stream = self._files.open(self._at(f"manifests/{versions[-1]}"))
        try:
            reader = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return json.loads(reader.readLine())
        finally:
            stream.close()

    def _publish(self, parts: list[dict]) -> None:
        versions = self._versions()
        number = versions[-1] + 1 if versions else 0
        # a file is written aside and renamed: it is there whole or not at all
        aside = self._at(f"manifests/_{number}")
        out = self._files.create(aside, True)
        out.write(json.dumps(parts).encode())
        out.close()
        if not self._files.rename(aside, self._at(f"manifests/{number}")):
            raise RuntimeError(f"another writer has published manifest {number} of {self.path}")
        for old in versions[:-KEEP]:
            self._files.delete(self._at(f"manifests/{old}"), False)

    def add(self, rows: DataFrame, batch: int) -> None:
        """The part of one micro-batch, and the merges that become due."""
        parts = self.parts()
        if any(p["first"] <= batch <= p["last"] for p in parts):
            return
        folder = f"level0/batch={batch}"
        rows.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        parts.append({"level": 0, "first": batch, "last": batch, "folder": folder})
        merged, level = [], 0
        while True:
            due = [p for p in parts if p["level"] == level]
            if len(due) < self.fan:
                break
            first, last = min(p["first"] for p in due), max(p["last"] for p in due)
            folder = f"level{level + 1}/batch={first}-{last}"
            self.merge(self._read(due)).write.mode("overwrite").parquet(f"{self.path}/{folder}")
            parts = [p for p in parts if p["level"] != level]
            parts.append({"level": level + 1, "first": first, "last": last, "folder": folder})
            merged.extend(due)
            level += 1
        self._publish(parts)
        self._forget(merged)

    def _forget(self, merged: list[dict]) -> None:
        """Delete the parts that merges replaced ``KEEP`` manifests ago."""
        if merged:
            out = self._files.create(self._at(f"merged/{merged[-1]['last']}-{len(merged)}"), True)
            out.write(json.dumps(merged).encode())
            out.close()
        if not self._files.exists(self._at("merged")):
            return
        lists = sorted(self._files.listStatus(self._at("merged")), key=lambda f: int(f.getPath().getName().split("-")[0]))
        for old in lists[:-KEEP]:
            stream = self._files.open(old.getPath())
            reader = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            for part in json.loads(reader.readLine()):
                self._files.delete(self._at(part["folder"]), True)
            stream.close()
            self._files.delete(old.getPath(), False)

    def _read(self, parts: list[dict]) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.path}/{p['folder']}" for p in parts))

    def read(self) -> DataFrame | None:
        """The rows of all live parts, not yet added up across them; None before the first batch."""
        parts = self.parts()
        return self._read(parts) if parts else None

    def total(self) -> DataFrame | None:
        rows = self.read()
        return None if rows is None else self.merge(rows)


def tiered(tiers: Tiers, shape: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` that adds ``shape`` of every micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tiers.add(shape(batch), batch_id)

    return write
