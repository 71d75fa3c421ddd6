"""Line dedup by site-relative frequency.

A line's share on a host is the number of the host's pages that hold it, divided by the number
of the host's pages. Lines with a share over ``ratio`` are the host's boilerplate and are
dropped from its pages, provided they repeat: a host of one page says nothing about its lines. Lines are compared trimmed; lines without a
character besides white space never count and stay.

Pages count a line once, lines combine before the shuffle, and a host has fewer than (lines of
its average page) / ratio boilerplate lines, so its list is small and the pages need no regrouping.

* null text: no lines, empty result text; null host: a host of its own
* repeated pages count as often as they occur
* an empty table gives an empty result; other columns stay as they are
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingline.llm.common import fresh, stored, whole

RATIO = 0.3
#: Pages on which a line must stand to repeat at all.
LEAST = 2


def host_of(url: str | Column) -> Column:
    """The host of an address, without user, port and a leading www., m. or blog.; lower case."""
    url = F.col(url) if isinstance(url, str) else url
    host = F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(host, r"^(www|m|blog)\.", "")


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """host and its boilerplate lines."""
    lines = F.array_distinct(F.transform(lines_of(text), trimmed))
    slim = pages.select(host.alias("host"), lines.alias("lines"))
    totals = slim.groupBy("host").agg(F.count("*").alias("pages"))
    found = (slim.select("host", F.explode("lines").alias("line")).where("line != ''")
             .groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least))
    both = found.alias("f").join(totals.alias("t"), F.col("f.host").eqNullSafe(F.col("t.host")))
    over = both.where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return over.groupBy(F.col("f.host").alias("host")).agg(F.collect_list("line").alias("lines"))


def without_boilerplate(pages: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO,
                        least: int = LEAST) -> DataFrame:
    """``pages`` with the kept lines as text and one struct column ``lines`` of n_lines and
    n_dropped."""
    mark = fresh("host")
    text = whole(F.col(text_col).cast("string"))
    common = stored(boilerplate(pages, host, text, ratio, least), "boilerplate")
    common = common.select(F.col("host").alias(mark), F.col("lines").alias(mark + "c"))
    both = pages.withColumn(mark + "h", host).join(common, F.col(mark + "h").eqNullSafe(F.col(mark)), "left")
    none = F.array().cast("array<string>")
    drops = F.coalesce(F.col(mark + "c"), none)
    every = F.when(F.col(text_col).isNull(), none).otherwise(lines_of(text))
    kept = F.filter(every, lambda x: ~F.array_contains(drops, trimmed(x)))
    others = [c for c in pages.columns if c not in (text_col, "lines")]
    return both.select(*others, every.alias(mark + "e"), kept.alias(mark + "k")).select(
        *others, F.array_join(mark + "k", "\n").alias(text_col),
        F.struct(F.size(mark + "e").cast("long").alias("n_lines"),
                 (F.size(mark + "e") - F.size(mark + "k")).cast("long").alias("n_dropped")).alias("lines"))
