"""Feature preparation, training, quality gate and promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingline.functions.columns import (
    FEATURE_RANGES, MAX_LOSS, MIN_ACCURACY, is_nan_text, min_max, row_fingerprint,
)
from pingline.operators.ordered import id_chunk, running_total
from pingline.operators.quality import require_columns
from pingline.schemas import FEATURE_COLUMNS
from pingline.sources.bronze import write_partitioned

TRAIN_RATIO = 0.8


def normalize(rows: DataFrame, keep: list[str] = []) -> DataFrame:
    """Features scaled by their fixed ranges; the label is passed on, other columns are dropped."""
    checked = require_columns(rows, [*keep, *FEATURE_COLUMNS])
    return checked.select(*keep, *[min_max(c) if c in FEATURE_RANGES else F.col(c).cast("double") for c in FEATURE_COLUMNS])


def cut_key(rows: DataFrame, key: str, ratio: float = TRAIN_RATIO, chunk_size: int = 65536) -> int | None:
    """Key of the last training row when rows are taken in key order; None for none.

    ``key`` is a unique integer. Keys are counted per chunk, the chunk holding the
    cut is found from the running counts, and only that chunk is sorted. Three small
    jobs over the key column; the table itself is never shuffled.
    """
    keys = rows.select(key)
    wanted = int(keys.count() * ratio)
    if wanted == 0:
        return None
    counts = keys.groupBy(id_chunk(key, chunk_size).alias("chunk")).agg(F.count(F.lit(1)).alias("n"))
    upto = running_total(counts, [], ["chunk"], {"upto": "n"}, id_chunk("chunk", 4096))
    cut = upto.filter((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted)).first()
    low = cut.chunk * chunk_size
    inside = keys.filter((F.col(key) >= low) & (F.col(key) < low + chunk_size)).orderBy(key)
    return inside.offset(wanted - (cut.upto - cut.n) - 1).first()[0]


def positional_split(rows: DataFrame, key: str, ratio: float = TRAIN_RATIO) -> DataFrame:
    """The first ``int(n * ratio)`` rows in key order train, the rest test."""
    cut = cut_key(rows, key, ratio)
    is_train = F.lit(False) if cut is None else F.col(key) <= cut
    return rows.withColumn("split", F.when(is_train, "train").otherwise("test"))


def fingerprint(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and an order-free hash of a table."""
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum(row_fingerprint(*columns)).alias("fingerprint"))


def quality_gate(models: DataFrame, accuracy: str = "accuracy", loss: str = "loss") -> DataFrame:
    """``passed`` and the first failing gate's ``reason``. Metrics are text until checked here."""
    a, l = F.col(accuracy).try_cast("double"), F.col(loss).try_cast("double")
    reason = F.lit(None).cast("string")
    steps = [
        (F.col(accuracy).isNull(), F.lit("missing required field: accuracy")),
        (is_nan_text(accuracy), F.lit("NaN detected in accuracy")),
        (F.col(loss).isNull(), F.lit("missing required field: loss")),
        (is_nan_text(loss), F.lit("NaN detected in loss")),
        (a.isNull(), F.lit("accuracy is not a number")),
        (l.isNull(), F.lit("loss is not a number")),
        (a < MIN_ACCURACY, F.format_string(f"accuracy %.4f below threshold {MIN_ACCURACY}", a)),
        (l >= MAX_LOSS, F.format_string(f"loss %.4f exceeds threshold {MAX_LOSS}", l)),
        (F.coalesce("weights_hash", F.lit("")) == "", F.lit("missing weights_hash")),
    ]
    for failed, text in reversed(steps):
        reason = F.when(failed, text).otherwise(reason)
    shown = lambda c, v: F.when(F.col(c).isNull() | is_nan_text(c), 0.0).otherwise(F.coalesce(v, F.lit(0.0)))
    return models.select(
        *models.columns,
        reason.isNull().alias("passed"),
        F.coalesce(reason, F.lit("all checks passed")).alias("reason"),
        shown(accuracy, a).alias("accuracy_value"),
        shown(loss, l).alias("loss_value"),
    )


def promote(gated: DataFrame, day: Column) -> DataFrame:
    """The last model of each day that passed."""
    return (
        gated.filter("passed")
        .groupBy(day.alias("par_day"))
        .agg(
            F.max_by("model_version", "run_no").alias("model_version"),
            F.max_by("accuracy_value", "run_no").alias("accuracy"),
            F.max("run_no").alias("run_no"),
        )
    )


def deploy(gated: DataFrame, day: Column, path: str) -> DataFrame:
    """Put each day's promoted model into the production table, in a folder of its day: a
    rerun replaces that day. Returns the table as stored."""
    write_partitioned(promote(gated, day), path, ["par_day"], "overwrite")
    return gated.sparkSession.read.parquet(path)


#: Keeps the weights finite where few rows leave the classes separable.
PENALTY = 0.001


def train(prepared: DataFrame) -> DataFrame:
    """Fit a logistic regression on the train rows of a stored, split table and measure
    it on the test rows. The fit reads the table once and then works on cached blocks."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    vectors = VectorAssembler(inputCols=list(FEATURE_RANGES), outputCol="features").transform(prepared)
    model = LogisticRegression(maxIter=50, regParam=PENALTY, labelCol="label").fit(vectors.filter(F.col("split") == "train"))
    p = F.element_at(vector_to_array("probability"), 2)
    p = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    y = F.col("label")
    measured = model.transform(vectors.filter(F.col("split") == "test")).agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.avg((F.col("prediction") == y).cast("double")).alias("accuracy"),
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("loss"),
    )
    # features have six places, so as whole numbers they read alike everywhere
    whole = [F.round(F.col(c) * 1_000_000).cast("bigint").alias(c) for c in FEATURE_COLUMNS]
    trained = fingerprint(prepared.filter(F.col("split") == "train").select(*whole), FEATURE_COLUMNS)
    return measured.select(
        F.lit("v1.0").alias("model_version"), "accuracy", "loss", "test_rows",
        trained.select("row_count").scalar().alias("training_rows"),
        trained.select(F.col("fingerprint").cast("string")).scalar().alias("weights_hash"),
    )
