"""Pseudonymised phone numbers backed by a stored dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingline.functions.columns import pseudonym
from pingline.operators.joins import spread_join
from pingline.session import stored

#: Rekeyed phones that a plain join takes, which Spark broadcasts if their size allows.
SMALL = 100_000


def distinct_phones(pings: DataFrame, columns: list[str]) -> DataFrame:
    """Phones of all columns; every task drops its own repeats before the one shuffle."""
    sides = [pings.select(F.col(c).alias("phone")) for c in columns]
    return reduce(DataFrame.unionByName, sides).distinct()


def known_phones(phones: DataFrame, dimension: DataFrame) -> DataFrame:
    """What the dimension has of these phones, in the dimension's own rows. Stored, so that
    Spark knows the size of what the pings are joined with: that of their own phones."""
    return stored(dimension.select("phone", "hash").join(phones, "phone", "left_semi"), "known-phones")


def hash_phones(phones: DataFrame, dimension: DataFrame, salt: str) -> DataFrame:
    """Hash of every phone: the stored one wins, also over a changed salt."""
    stored = dimension.select("phone", F.col("hash").alias("__stored"))
    return phones.join(stored, "phone", "left").select(
        "phone",
        F.coalesce("__stored", pseudonym("phone", salt)).alias("hash"),
        F.col("__stored").isNull().alias("is_new"),
    )


def new_rows(phones: DataFrame, dimension: DataFrame, salt: str, created_at: Column) -> DataFrame:
    """Rows to insert into the dimension."""
    return phones.join(dimension, "phone", "left_anti").select(
        "phone", pseudonym("phone", salt).alias("hash"), created_at.alias("created_at")
    )


def pseudonymise(pings: DataFrame, columns: dict[str, str], dimension: DataFrame, salt: str) -> DataFrame:
    """Replace phone columns, ``{phone column: hash column}``.

    Only phones stored under a hash other than today's need the lookup. They are stored
    first, so that Spark knows their size: none of them means no lookup at all, and the pings
    are only a projection; a small table is broadcast and the pings stay where they are.
    Beyond that a busy phone's rows are spread over several tasks.
    """
    rekeyed = stored(dimension.filter(F.col("hash") != pseudonym("phone", salt)).select("phone", "hash"), "rekeyed")
    count = rekeyed.count()
    out = pings
    for phone, hashed in columns.items():
        if count == 0:
            out = out.withColumn(hashed, pseudonym(phone, salt)).drop(phone)
            continue
        side = rekeyed.select(F.col("phone").alias(phone), F.col("hash").alias(f"__{hashed}"))
        out = (
            spread_join(out, side, [phone], "left", 1 if count <= SMALL else 64)
            .withColumn(hashed, F.coalesce(F.col(f"__{hashed}"), pseudonym(phone, salt)))
            .drop(f"__{hashed}", phone)
        )
    return out
