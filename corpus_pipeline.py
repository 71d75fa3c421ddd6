"""A corpus pipeline: every stage reads what the one before it kept.

``STAGES`` are (name, function) pairs. A function takes the session, the documents so far and
the folder of the tables and returns the documents it keeps; the last one packs them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingline.llm import exact_dedup, near_dedup, packing, quality, suffix_dedup
from pingline.llm.common import prepare, read
from pingline.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules (4): documents they reject go."""
    return quality.keep_good(docs, read(prepare(spark), sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup (10): of equal texts the one with the smallest id stays."""
    prepare(spark)
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (7) with the operator's shingle length and bit distance: one document of each group stays."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup (1): strings that an earlier document holds are cut out."""
    prepare(spark)
    return suffix_dedup.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (9): the pieces of every document and their places."""
    prepare(spark)
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", keep_good),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("suffix dedup", cut_repeats),
    ("packing", pack),
]

#: SQL can express neither fingerprints nor the tokenizer; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
