"""Hourly and daily silver aggregates. A day re-reads bronze, as distinct counts do not add up,
or comes from hourly partials that hold the contacts themselves, as bitmaps, which do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingline.functions.columns import PING_SECONDS

HOURLY = ("par_day", "par_hour")
DAILY = ("par_day",)
#: Contacts to a bitmap: a long. ``bitmap_construct_agg`` has 4 KB for every group, and most
#: callers have a few contacts in an hour.
BITS = 64


def aggregate_calls(bronze: DataFrame, period: tuple[str, ...] = HOURLY) -> DataFrame:
    """Per caller: pings, duration, distinct contacts, towers.

    Two shuffles: by caller and contact, which shrinks the data map-side and spreads a busy
    caller over its contacts, then by caller. A contact's pings are counted at its first
    tower only, so neither step needs a distinct expansion, and a task holds no more than
    the towers of its groups.
    """
    caller = [*period, "phone_hash_out"]
    pairs = bronze.groupBy(*caller, "phone_hash_in").agg(F.count(F.lit(1)).alias("n"), F.collect_set("cell_tower").alias("towers"))
    towers = pairs.select(*caller, "phone_hash_in", "n", F.posexplode_outer("towers").alias("pos", "cell_tower"))
    first = F.coalesce("pos", F.lit(0)) == 0
    return (
        towers.groupBy(*caller)
        .agg(
            F.sum(F.when(first, F.col("n"))).alias("total_calls"),
            (F.sum(F.when(first, F.col("n"))) * PING_SECONDS).alias("total_duration_s"),
            F.count_if(first & F.col("phone_hash_in").isNotNull()).alias("unique_contacts"),
            F.array_sort(F.collect_set("cell_tower")).alias("unique_towers"),
        )
        .withColumn("avg_call_duration_s", F.col("total_duration_s") / F.col("total_calls"))
    )


def number_contacts(bronze: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(phone_hash_in, number) for contacts without one in ``known``. Numbers are dense within
    the partitions that hand them out, so a bitmap's bits are shared by neighbours, and
    no number is given twice. Store the result before use: it then stays as it is."""
    new = bronze.select("phone_hash_in").where("phone_hash_in IS NOT NULL").distinct()
    start = 0
    if known is not None:
        new = new.join(known, "phone_hash_in", "left_anti")
        # above every number in use, at the next multiple of a partition's span
        start = ((known.agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0] >> 33) + 1) << 33
    return new.select("phone_hash_in", (F.monotonically_increasing_id() + F.lit(start)).alias("number"))


def call_partials(bronze: DataFrame, numbers: DataFrame, period: tuple[str, ...] = HOURLY) -> DataFrame:
    """What of an hour adds up to a day: per caller and bucket of contact numbers the pings, the
    towers and a bitmap of the contacts. A busy caller is spread over its buckets; there are
    never more rows than pings."""
    numbered = bronze.join(numbers, "phone_hash_in", "left")
    bits = F.expr(f"bit_or(shiftleft(1L, int(number % {BITS})))")
    return numbered.groupBy(*period, "phone_hash_out", F.expr(f"number div {BITS}").alias("bucket")).agg(
        F.coalesce(bits, F.lit(0)).cast("bigint").alias("contacts"),  # none where no contact is known
        F.count(F.lit(1)).alias("n"), F.collect_set("cell_tower").alias("towers"))


def calls_of_partials(partials: DataFrame, period: tuple[str, ...] = DAILY) -> DataFrame:
    """The aggregate of calls from stored partials: bitmaps of one bucket are united, their
    bits counted, so bronze is not read again."""
    caller = [*period, "phone_hash_out"]
    buckets = partials.groupBy(*caller, "bucket").agg(
        F.bit_count(F.bit_or("contacts")).alias("contacts"), F.sum("n").alias("n"),
        F.array_distinct(F.flatten(F.collect_set("towers"))).alias("towers"))
    return (
        buckets.groupBy(*caller)
        .agg(
            F.sum("n").alias("total_calls"), (F.sum("n") * PING_SECONDS).alias("total_duration_s"),
            F.sum("contacts").alias("unique_contacts"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("towers")))).alias("unique_towers"),
        )
        .withColumn("avg_call_duration_s", F.col("total_duration_s") / F.col("total_calls"))
    )


def aggregate_browsing(bronze: DataFrame, period: tuple[str, ...] = HOURLY) -> DataFrame:
    """Per phone and host: pings, towers, duration. A host has one site name, so the
    first step may group by it too, which keeps it a hash aggregate."""
    visitor = [*period, "phone_hash", "host_name"]
    cells = bronze.groupBy(*visitor, "site_name", "cell_tower").agg(F.count(F.lit(1)).alias("n"))
    return cells.groupBy(*visitor).agg(
        F.min("site_name").alias("site_name"),
        F.sum("n").alias("total_pings"),
        F.array_sort(F.collect_set("cell_tower")).alias("unique_towers"),
        (F.sum("n") * PING_SECONDS).alias("total_session_duration_s"),
    )
