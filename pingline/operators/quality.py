"""Detectors: each returns the offending rows, keys or periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingline.functions.columns import epoch_micros, machine_health
from pingline.operators.joins import spread_join
from pingline.operators.ordered import id_chunk, previous, running_total, time_chunk


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds, rounded down."""
    return F.floor((epoch_micros(later) - epoch_micros(earlier)) / 1_000_000).cast("bigint")


def late(rows: DataFrame, arrived: str, period_end: Column, allowed_seconds: int) -> DataFrame:
    """Rows that arrived after their period's evaluation window had closed."""
    late_micros = epoch_micros(arrived) - epoch_micros(period_end)
    return rows.filter(late_micros > allowed_seconds * 1_000_000).withColumn(
        "late_seconds", F.floor(late_micros / 1_000_000).cast("bigint")
    )


def missing_windows(calendar: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return calendar.join(present.select(*keys).distinct(), keys, "left_anti")


def empty_files(manifest: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Delivered files without a single record."""
    return manifest.join(rows.select(*keys).distinct(), keys, "left_anti")


def corruption(rows: DataFrame, by: list[str], required: list[str], typed: dict[str, str]) -> DataFrame:
    """Per partition: rows with a null or a value that does not cast, and their share."""
    bad = F.lit(False)
    for name in required:
        bad = bad | F.col(name).isNull()
    for name, kind in typed.items():
        bad = bad | (F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull())
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(bad).alias("corrupt_rows"))
    return counts.withColumn("corrupt_share", F.col("corrupt_rows") / F.col("total_rows"))


def duplicates(rows: DataFrame, content: list[str], row_id: str) -> DataFrame:
    """Contents that occur more than once. Rows are grouped by a hash of the whole
    content, so long texts are neither shuffled nor kept."""
    whole = F.sha2(F.to_json(F.struct(*content)) if len(content) > 1 else F.col(content[0]), 256)
    return (
        rows.select(whole.alias("content_hash"), row_id)
        .groupBy("content_hash")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(row_id).alias("first_id"))
        .filter(F.col("copies") > 1)
    )


def deduplicate(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per content. Copies collapse map-side, a much repeated row never piles up."""
    return rows.dropDuplicates(keys) if keys else rows.distinct()


def out_of_order(rows: DataFrame, file: list[str], arrival: str, ts: str = "ts", chunk_size: int = 65536) -> DataFrame:
    """Per file: rows whose time lies before that of the row that arrived just ahead."""
    seen = previous(rows, file, [arrival], {"__before": ts}, id_chunk(arrival, chunk_size))
    return seen.groupBy(*file).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("__before") > F.col(ts)).alias("out_of_order_rows")
    )


def schema_drift(actual: list[str], expected: list[str], spark) -> DataFrame:
    """Columns a source gained or lost, as rows."""
    rows = [(c, "added") for c in actual if c not in expected] + [(c, "removed") for c in expected if c not in actual]
    return spark.createDataFrame(rows, "column string, change string")


def require_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    """The expected columns, or an error naming the missing ones."""
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"Missing expected columns: {missing}")
    return df.select(*expected)


def payload_drift(payloads: DataFrame, column: str, expected: list[str]) -> DataFrame:
    """Fields of JSON records against the expected ones, with the number of records concerned.
    A record that is absent, or no JSON object, is counted as such under an empty field."""
    keys = payloads.select(F.col(column), F.json_object_keys(column).alias("keys"))
    contract = F.array(*[F.lit(c) for c in expected])
    whole = F.when(F.col(column).isNull(), "absent").when(F.col("keys").isNull(), "malformed")
    changes = keys.select(
        F.when(whole.isNotNull(), F.array(F.struct(F.lit("").alias("field"), whole.alias("change"))))
        .otherwise(F.concat(
            F.transform(F.array_except("keys", contract), lambda k: F.struct(k.alias("field"), F.lit("added").alias("change"))),
            F.transform(F.array_except(contract, "keys"), lambda k: F.struct(k.alias("field"), F.lit("removed").alias("change"))),
        )).alias("changes")
    )
    return (
        changes.select(F.explode("changes").alias("c"))
        .groupBy(F.col("c.field").alias("field"), F.col("c.change").alias("change"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def stale_replay(arrivals: DataFrame, completed: DataFrame, period: list[str]) -> DataFrame:
    """Per completed period: rows that arrived after it had been completed."""
    return (
        spread_join(arrivals, completed.select(*period, "completed_at"), period)
        .filter(F.col("arrived_at") > F.col("completed_at"))
        .groupBy(*period)
        .agg(F.count(F.lit(1)).alias("replayed_rows"), F.min("arrived_at").alias("first_replay"))
    )


def post_run_drift(arrivals: DataFrame, period: list[str], run_at: Column) -> DataFrame:
    """Periods whose row count changed after the job ran."""
    counts = arrivals.groupBy(*period).agg(
        F.count_if(F.col("arrived_at") <= run_at).alias("baseline"), F.count(F.lit(1)).alias("current")
    )
    return counts.withColumn("drift", F.col("current") - F.col("baseline")).filter(F.col("drift") != 0)


def phantom_entities(rows: DataFrame, entity: str, roster: list[str]) -> DataFrame:
    counts = rows.groupBy(entity).agg(F.count(F.lit(1)).alias("records"))
    return counts.filter(~F.col(entity).isin(roster))


def stale(latest: DataFrame, as_of: Column, age_seconds: int) -> DataFrame:
    age = epoch_micros(as_of) - epoch_micros("updated_at")
    return latest.filter(age >= age_seconds * 1_000_000).withColumn(
        "age_seconds", F.floor(age / 1_000_000).cast("bigint")
    )


def in_future(rows: DataFrame, ts: str, as_of: Column) -> DataFrame:
    return rows.filter(F.col(ts) > as_of)


def inconsistent_status(rows: DataFrame) -> DataFrame:
    """Stored status against the one its own measures give."""
    derived = machine_health("temperature", "vibration", "pressure")
    return rows.withColumn("derived_status", derived).filter(F.col("status") != F.col("derived_status"))


def flapping(
    rows: DataFrame,
    entity: str,
    state: str,
    ts: str,
    tie: str,
    span_seconds: int = 300,
    min_toggles: int = 4,
    chunk_seconds: int = 3600,
) -> DataFrame:
    """Moments at which an entity's state had changed ``min_toggles`` times within the span.

    Changes are counted per (entity, span-wide slot); each change is also lent to the
    next slot, moved on by one span. For a change at ``t`` the span then holds its own
    slot's changes up to ``t`` and the lent ones from ``t`` on: two running counts, in
    place of a frame that is counted afresh for every row.
    """
    span = span_seconds * 1_000_000
    changes = previous(rows, [entity], [ts, tie], {"__before": state}, time_chunk(ts, chunk_seconds))
    changes = changes.filter(F.col("__before") != F.col(state)).select(entity, ts, tie, epoch_micros(ts).alias("__us"))
    slot = time_chunk(ts, span_seconds)
    copies = F.array(
        F.struct(slot.alias("slot"), F.lit(0).alias("lent"), F.col("__us").alias("at")),
        F.struct((slot + 1).alias("slot"), F.lit(1).alias("lent"), (F.col("__us") + span).alias("at")),
    )
    placed = changes.select(entity, ts, tie, F.explode(copies).alias("c")).select(entity, ts, tie, "c.*")
    group = Window.partitionBy(entity, "slot")
    upto = group.orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    before = group.orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    toggles = (
        F.sum(1 - F.col("lent")).over(upto) + F.sum("lent").over(group) - F.coalesce(F.sum("lent").over(before), F.lit(0))
    )
    return (
        placed.withColumn("toggles", toggles)
        .filter((F.col("lent") == 0) & (F.col("toggles") >= min_toggles))
        .select(entity, tie, ts, "toggles")
    )


def rolling_degradation(runs: DataFrame, order: str, metric: str, floor: float, min_drops: int = 2) -> DataFrame:
    """Unbroken falls of a metric over successive runs that end below ``floor``."""
    chunk = id_chunk(order)
    seen = previous(runs.select(order, metric), [], [order], {"__before": metric}, chunk)
    fell = F.coalesce((F.col(metric) < F.col("__before")).cast("int"), F.lit(0))
    series = running_total(seen.withColumn("__fell", fell), [], [order], {"series": 1 - F.col("__fell")}, chunk)
    at = F.col(order)
    return (
        series.groupBy("series")
        .agg(
            F.min(order).alias("first_run"), F.max(order).alias("last_run"), F.sum("__fell").alias("drops"),
            F.min_by(metric, at).alias("first_value"), F.max_by(metric, at).alias("last_value"),
        )
        .filter((F.col("drops") >= min_drops) & (F.col("last_value") < floor))
        .drop("series")
    )


def feature_profile(rows: DataFrame, run: Column, columns: list[str]) -> DataFrame:
    """Mean and spread of feature columns per run, to see noise grow."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return rows.groupBy(run.alias("run")).agg(*aggs)


def dangling_references(references: DataFrame, artifacts: DataFrame, key: str) -> DataFrame:
    """References, counted, to artifacts that do not exist."""
    wanted = references.groupBy(key).agg(F.count(F.lit(1)).alias("references"))
    return wanted.join(artifacts.select(key).distinct(), key, "left_anti")


def stale_triggers(done: DataFrame, updates: DataFrame, key: str, window_seconds: int = 1800) -> DataFrame:
    """Completions not followed by an update of the same key within the window.

    Time is cut into window-wide slots, and only the first and last update of each
    slot matter: one later in the completion's own slot always counts, one in the
    next slot counts when it comes early enough. So each completion meets two rows.
    """
    width = window_seconds * 1_000_000
    slots = updates.groupBy(key, time_chunk("ts", window_seconds).alias("__slot")).agg(
        F.max(epoch_micros("ts")).alias("__last"), F.min(epoch_micros("ts")).alias("__first")
    )
    here = done.withColumn("__slot", time_chunk("ts", window_seconds)).withColumn("__at", epoch_micros("ts"))
    own = slots.select(key, "__slot", "__last")
    following = slots.select(key, (F.col("__slot") - 1).alias("__slot"), "__first")
    answered = F.coalesce(F.col("__last") > F.col("__at"), F.lit(False)) | F.coalesce(
        F.col("__first") <= F.col("__at") + width, F.lit(False)
    )
    return (
        here.join(own, [key, "__slot"], "left")
        .join(following, [key, "__slot"], "left")
        .filter(~answered)
        .select(*done.columns)
    )


def false_success(gated: DataFrame, runs: DataFrame, key: str = "run_no") -> DataFrame:
    """Runs that reported success although a metric of theirs is NaN."""
    bad = gated.filter(F.col("reason").startswith("NaN detected"))
    return bad.join(runs.filter(F.col("status") == "SUCCEEDED").select(key), key, "left_semi")


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
