"""A join for many rows that may share one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows a task should get of one key, and the most tasks a key is dealt over.
ROWS_PER_TASK, MOST = 4_000_000, 4096


def fan_of(rows: int) -> int:
    """Tasks to deal a key over that may hold a third of ``rows`` rows."""
    return max(1, min(MOST, -(-rows // (3 * ROWS_PER_TASK))))


def spread_join(rows: DataFrame, side: DataFrame, keys: list[str], how: str = "inner", fan: int = 16) -> DataFrame:
    """Join with a ``side`` of one row per key. The rows of every key are dealt over
    ``fan`` tasks by a hash of the whole row, and the side is repeated for each, so a key
    with a third of all rows does not end up in one task. ``fan_of`` gives a number for the
    volume of the rows; with 1 it is a plain join."""
    if fan == 1:
        return rows.join(side, keys, how)
    dealt = rows.withColumn("__deal", F.pmod(F.xxhash64(*rows.columns), F.lit(fan)).cast("int"))
    copies = side.withColumn("__deal", F.explode(F.sequence(F.lit(0), F.lit(fan - 1))))
    return dealt.join(copies, [*keys, "__deal"], how).drop("__deal")
