"""Running totals, carried values and neighbours in an order, without one task per key.

A plain window gives a key's whole history to one task. Here the history is cut
into chunks of the order column. Each chunk is summarised first (with map-side
combine), the summaries are chained over the few chunks of a key, and the row
work runs per (key, chunk). A key with a third of all rows is spread over as
many tasks as it has chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingline.functions.columns import epoch_micros

_CHUNK = "__chunk"


def time_chunk(ts: str, seconds: int = 3600) -> Column:
    width, us = F.lit(seconds * 1_000_000), epoch_micros(ts)
    return ((us - F.pmod(us, width)) / width).cast("bigint")


def id_chunk(key: str, size: int = 65536) -> Column:
    """At most ``size`` rows share a chunk when ``key`` is a unique integer."""
    return F.floor(F.col(key) / size).cast("bigint")


def _at(order: list[str]) -> Column:
    """What a latest-by aggregate orders on. A single number keeps it a hash aggregate."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def order_number(first: Column | str, second: Column | str) -> Column:
    """Two integers as one number in their joint order. Unlike a struct it keeps a latest-by
    aggregate a hash aggregate."""
    wide = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")
    return (wide(first) * F.lit(10**18).cast("decimal(19,0)")).cast("decimal(38,0)") + wide(second)


def newest_rows(df: DataFrame, by: list[str], first: Column | str, second: Column | str) -> DataFrame:
    """The last row per key in the order of two integers, ``second`` being unique. Only the
    key and the order are aggregated; the few winners then pick their rows."""
    at = df.withColumn("__at", order_number(first, second))
    last = at.groupBy(*by).agg(F.max("__at").alias("__at"))
    return at.join(last, [*by, "__at"], "left_semi").drop("__at")


def running_total(
    df: DataFrame, by: list[str], order: list[str], values: dict[str, Column | str], chunk: Column, fan: int = 4096
) -> DataFrame:
    """Add inclusive running totals, ``{new column: value}``, per ``by`` in ``order``.

    Chunk sums are themselves chained in two levels, so the last single window
    holds one row for every ``fan`` chunks.
    """
    # a plain column name keeps its type; an expression is computed once here
    staged = df.withColumn(_CHUNK, chunk)
    value_names = []
    for i, expr in enumerate(values.values()):
        staged = staged.withColumn(f"__v{i}", F.col(expr) if isinstance(expr, str) else expr)
        value_names.append(f"__v{i}")

    chunks = staged.groupBy(*by, _CHUNK).agg(*[F.sum(v).alias(f"{v}_sum") for v in value_names])
    chunks = chunks.withColumn("__group", F.floor(F.col(_CHUNK) / fan))
    groups = chunks.groupBy(*by, "__group").agg(*[F.sum(f"{v}_sum").alias(f"{v}_gsum") for v in value_names])
    before = Window.partitionBy(*by).orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        *by, "__group", *[F.coalesce(F.sum(f"{v}_gsum").over(before), F.lit(0)).alias(f"{v}_goff") for v in value_names]
    )
    inside = Window.partitionBy(*by, "__group").orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(
        *by, "__group", _CHUNK,
        *[F.coalesce(F.sum(f"{v}_sum").over(inside), F.lit(0)).alias(f"{v}_coff") for v in value_names],
    )
    offsets = offsets.join(groups, [*by, "__group"]).select(
        *by, _CHUNK, *[(F.col(f"{v}_goff") + F.col(f"{v}_coff")).alias(f"{v}_off") for v in value_names]
    )
    rows = Window.partitionBy(*by, _CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = staged.join(offsets, [*by, _CHUNK])
    for name, v in zip(values, value_names):
        out = out.withColumn(name, F.col(f"{v}_off") + F.sum(v).over(rows))
    return out.select(*df.columns, *values)


def carry_last(
    df: DataFrame, by: list[str], order: list[str], value: str, out: str, chunk: Column, default_first: bool = False,
    fan: int = 4096,
) -> DataFrame:
    """Latest non-null ``value`` at or before each row; before the first one the
    result is null, or the key's first value when ``default_first``."""
    staged = df.withColumn(_CHUNK, chunk)
    known = staged.filter(F.col(value).isNotNull())
    at = _at(order)
    last = known.groupBy(*by, _CHUNK).agg(
        F.max_by(value, at).alias("__last"), F.min_by(value, at).alias("__first"), F.lit(True).alias("__known")
    )
    spine = staged.select(*by, _CHUNK).distinct().join(last, [*by, _CHUNK], "left")
    # chunks are chained in two levels, as the running totals are
    spine = spine.withColumn("__group", F.floor(F.col(_CHUNK) / fan))
    summary = spine.filter("__known").groupBy(*by, "__group").agg(
        F.max_by("__last", F.col(_CHUNK)).alias("__glast"), F.min_by("__first", F.col(_CHUNK)).alias("__gfirst")
    )
    groups = spine.select(*by, "__group").distinct().join(summary, [*by, "__group"], "left")
    over = Window.partitionBy(*by).orderBy("__group")
    groups = groups.select(
        *by, "__group",
        F.last("__glast", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("__gcarry"),
        F.first("__gfirst", ignorenulls=True)
        .over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("__origin"),
    )
    inside = Window.partitionBy(*by, "__group").orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = spine.withColumn("__icarry", F.last("__last", ignorenulls=True).over(inside)).join(groups, [*by, "__group"])
    carried = carried.select(*by, _CHUNK, F.coalesce("__icarry", "__gcarry").alias("__carry"), "__origin")
    rows = Window.partitionBy(*by, _CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = staged.join(carried, [*by, _CHUNK])
    found = [F.last(value, ignorenulls=True).over(rows), F.col("__carry")]
    if default_first:
        found.append(F.col("__origin"))
    return joined.withColumn(out, F.coalesce(*found)).select(*df.columns, out)


def previous(
    df: DataFrame, by: list[str], order: list[str], values: dict[str, str], chunk: Column, fan: int = 4096
) -> DataFrame:
    """Value of the row before, ``{new column: column}``, per ``by`` in ``order``."""
    staged = df.withColumn(_CHUNK, chunk)
    at = _at(order)
    tails = staged.groupBy(*by, _CHUNK).agg(*[F.max_by(v, at).alias(f"__{n}") for n, v in values.items()])
    # the chunk before is in the same group, or the last of the group before
    tails = tails.withColumn("__group", F.floor(F.col(_CHUNK) / fan))
    inside = Window.partitionBy(*by, "__group").orderBy(_CHUNK)
    over = Window.partitionBy(*by).orderBy("__group")
    groups = tails.groupBy(*by, "__group").agg(*[F.max_by(f"__{n}", F.col(_CHUNK)).alias(f"__g{n}") for n in values])
    groups = groups.select(*by, "__group", *[F.lag(f"__g{n}").over(over).alias(f"__g{n}") for n in values])
    heads = tails.select(
        *by, "__group", _CHUNK, F.row_number().over(inside).alias("__place"), *[F.lag(f"__{n}").over(inside).alias(f"__{n}") for n in values]
    ).join(groups, [*by, "__group"])
    heads = heads.select(*by, _CHUNK, *[F.when(F.col("__place") == 1, F.col(f"__g{n}")).otherwise(F.col(f"__{n}")).alias(f"__{n}") for n in values])
    rows = Window.partitionBy(*by, _CHUNK).orderBy(*order)
    joined = staged.join(heads, [*by, _CHUNK]).withColumn("__row", F.row_number().over(rows))
    for name, v in values.items():
        joined = joined.withColumn(
            name, F.when(F.col("__row") == 1, F.col(f"__{name}")).otherwise(F.lag(v).over(rows))
        )
    return joined.select(*df.columns, *values)
