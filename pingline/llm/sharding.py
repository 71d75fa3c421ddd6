"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``nodes`` points of a ring, every row a position: the hash of its group key,
so rows of one group stand together. A row belongs to the next point clockwise. A shard takes
at most its bound, here the rows shared out evenly (counts differ by at most one); rows beyond
it continue clockwise to the next point whose shard has room. Shards first take what is their
own, so only the overflow moves.

The ring is settled from the number of rows per arc (nodes * shards numbers). A row's place in
its arc is its place in a cell (position and salt of the id) plus the cells before it, so a
group of any size is counted and numbered in many tasks.

* null text: no bytes, size 1; rows without group key form one group
* null id: an id like any other; repeated rows get places of their own
* an empty table gives an empty result; other columns are ignored
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pingline.llm.common import stored, whole

SHARDS, NODES = 8, 64
#: Salts of a position's rows, and stretches of an arc whose sums are chained.
SALTS, STRETCHES = 64, 1024


def ring(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted points and the shard of each."""
    points = sorted((xxhash.xxh64_intdigest(f"{s}/{v}".encode()) - (1 << 63), s) for s in range(shards) for v in range(nodes))
    return np.array([p for p, _ in points], np.int64), np.array([s for _, s in points], np.int64)


def settle(counts: list[int], owners: list[int], bounds: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) of the rows of every arc, clockwise."""
    left, slots = list(bounds), [0] * len(bounds)
    parts: list[tuple[int, int, int, int]] = []
    over: list[tuple[int, int, int]] = []
    for arc, (n, shard) in enumerate(zip(counts, owners)):
        own = min(n, left[shard])
        left[shard] -= own
        if own:
            parts.append((arc, 0, own, shard))
        if n > own:
            over.append((arc, own, n))
    for arc, at, end in over:
        walk = arc
        while at < end:
            walk += 1
            shard = owners[walk % len(owners)]
            some = min(end - at, left[shard])
            if some:
                parts.append((arc, at, at + some, shard))
                left[shard] -= some
                at += some
    out = []
    for arc, a, b, shard in sorted(parts):
        out.append((arc, a, b, shard, slots[shard]))
        slots[shard] += b - a
    return out


def sharded(docs: DataFrame, id_col: str = "doc_id", group: Column | None = None, shards: int = SHARDS,
            nodes: int = NODES, keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, the columns of ``keep``, shard and slot (gapless from 0 in each shard)."""
    points, owners = ring(shards, nodes)

    @F.pandas_udf("int")
    def arc_of(position: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(points, position.to_numpy(), "left") % len(points)).astype(np.int32))

    position = F.xxhash64(group if group is not None else F.col(id_col))
    kept = keep or {}
    slim = docs.select(F.col(id_col).alias("doc_id"), *(c.alias(n) for n, c in kept.items()), position.alias("position"))
    slim = stored(slim.withColumn("arc", arc_of("position")).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), "ring")
    cells = slim.groupBy("arc", "position", "salt").agg(F.count("*").alias("n"))
    # stretches cut the positions evenly, whatever arc they lie in
    cells = stored(cells.withColumn("stretch", F.expr(f"(position >> 1) div {(1 << 62) // STRETCHES * 2}")), "ring-cells")
    sums = cells.groupBy("arc", "stretch").agg(F.sum("n").alias("n"))
    # the arc that spans the ring's ends begins behind the last point
    turned = F.col("stretch") < F.lit(0)
    before = W.partitionBy("arc").orderBy("far", "stretch").rowsBetween(W.unboundedPreceding, -1)
    far = F.when((F.col("arc") == 0) & turned, 1).otherwise(0)
    sums = sums.withColumn("far", far).select("arc", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = W.partitionBy("arc", "stretch").orderBy("position", "salt").rowsBetween(W.unboundedPreceding, -1)
    starts = (cells.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sums, ["arc", "stretch"])
              .select("position", "salt", (F.col("inside") + F.col("ahead")).alias("start")))
    arcs = {r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}  # a row per point
    counts = [arcs.get(i, 0) for i in range(len(points))]
    even, more = divmod(sum(counts), shards)
    parts = settle(counts, owners.tolist(), [even + (s < more) for s in range(shards)])
    plan = docs.sparkSession.createDataFrame(
        pd.DataFrame(parts, columns=["arc", "low", "high", "shard", "first"]).astype({"arc": "int32", "shard": "int32"})
        if parts else [], "arc int, low long, high long, shard int, first long")
    order = W.partitionBy("position", "salt").orderBy("doc_id", *kept)
    ranked = (slim.withColumn("place", F.row_number().over(order)).join(starts, ["position", "salt"])
              .withColumn("rank", F.col("start") + F.col("place") - 1))
    # at most a row per point and shard
    spot = F.broadcast(plan.withColumnRenamed("arc", "of"))
    both = ranked.join(spot, (F.col("arc") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    return both.select("doc_id", *kept, "shard", (F.col("first") + F.col("rank") - F.col("low")).alias("slot"))


def by_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """Rows shared out evenly, equal texts together where the bound lets them."""
    text = whole(F.col(text_col).cast("string"))
    keep = {"size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text)}
    return sharded(docs, id_col, text, shards, nodes, keep)
