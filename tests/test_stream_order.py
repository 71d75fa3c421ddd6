"""Streams over more files than one trigger takes, newest first, give what one file gives."""

import os

import pytest
from pyspark.sql import functions as F

from pingline.catalog import streams  # noqa: F401
from pingline.catalog.registry import QUERIES
from pingline.session import scratch_path
from pingline.sources import bronze, tables

SMALL = "/root/testdata/sf0.01"
FILES = 200  # late rows are dropped from the third micro-batch on


@pytest.fixture(scope="module")
def newest_first(spark):
    folder = scratch_path(spark, "newest-first").removeprefix("file:")
    events = tables.table(spark, SMALL, "events")
    events.repartitionByRange(FILES, F.col("ts").desc()).write.parquet(f"{folder}/events.parquet")
    names = sorted(x for x in os.listdir(f"{folder}/events.parquet") if x.endswith(".parquet"))
    assert len(names) > 3 * 64
    for i, name in enumerate(names):
        os.utime(f"{folder}/events.parquet/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    return folder


@pytest.mark.parametrize("name", ["stream_hourly_counts", "stream_daily_hours", "stream_latch", "stream_factory_health", "stream_window_volume", "stream_dedup", "stream_late", "stream_bank_lag"])
def test_no_row_is_lost(spark, newest_first, name):
    got, want = (sorted(map(str, bronze.as_ntz(QUERIES[name](spark, d)).collect())) for d in (newest_first, SMALL))
    assert want and got == want
