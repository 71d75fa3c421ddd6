"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pingline.session import configure, scratch_path

#: Words are runs of everything but these six ASCII white-space characters.
WHITE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Null ids order after every other id.
LAST_ID = 2**63 - 1


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the library, Arrow batches small enough for long texts, and this
    package on the executors, whose Python needs it."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), package.name), "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(made)  # Spark's own file server hands it out
        _SHIPPED.add(app)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut, safe when an
    executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(stem: str) -> str:
    """A column name no input can hold."""
    return f"_{stem}_{uuid.uuid4().hex[:12]}"


def whole(text: str | Column) -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def order_key(doc_id: str, row: str, null_last: bool = True) -> Column:
    """(id, row number) as one number: hash aggregates keep decimals in place, structs not."""
    big = F.coalesce(F.col(doc_id), F.lit(LAST_ID if null_last else -LAST_ID - 1)).cast("decimal(19,0)")
    return (big * F.lit(10**18).cast("decimal(19,0)")).cast("decimal(38,0)") + F.col(row).cast("decimal(19,0)")


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def chunks_of(batches: Iterator[pa.RecordBatch], most: int, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``most`` bytes; one long row may
    be a slice of its own."""
    for batch in batches:
        sizes = [0 if x is None else x for x in _lengths(batch.column(column))]
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def _lengths(column: pa.Array) -> list[int | None]:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_pylist()
