"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its content says so, so equal passages give equal chunks wherever they
stand. Chunks become identifiers: a 64-bit hash, and a rank among chunks that share the
hash. To know those ranks every distinct chunk is shuffled once (copies combine before the
shuffle) and compared as text. After that only identifier lists travel: texts are equal
when their ordered lists are equal.

* null text: empty; all empty texts are equal (the empty list)
* null id: orders after every other id; ``keep_id`` is null only if the whole group has none
* repeated rows: one row of those with the smallest id stays
* an empty table gives an empty result; other columns are ignored
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pingline.llm.common import WHITE, fresh, order_key, stored, whole

#: Bounds of a chunk in characters.
SHORTEST, LONGEST = 256, 4096


def cut_pattern(shortest: int = SHORTEST, longest: int = LONGEST) -> str:
    """A chunk ends at the first content cut after ``shortest`` characters: a character of
    one pseudo-random class followed by one of another, about once in forty in ASCII text.
    Scripts without such characters are cut at ``longest``."""
    chars = [c for c in range(0x20, 0x100) if not 0x7F <= c < 0xA0]

    def some(seed: int) -> str:
        return "".join(f"\\x{{{c:X}}}" for c in chars if (c * 2654435761 + seed * 40503) >> 7 & 7 in (1, 6))

    return f"(?s).{{{shortest},{longest - 1}}}?[{some(1)}](?=[{some(5)}])|(?s).{{1,{longest}}}"


def normalised(text: str | Column) -> Column:
    """Every run of white space is one space; nothing is trimmed."""
    return F.regexp_replace(whole(text), f"{WHITE}+", " ")


def chunks(text: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    return F.regexp_extract_all(text, F.lit(cut_pattern(shortest, longest)), F.lit(0))


def collisions(texts: DataFrame, hash_of: Callable[[Column], Column]) -> DataFrame:
    """(hash, chunk, rank) of the chunks that share their hash with another chunk."""
    every = texts.select(F.explode(chunks(F.col("text"))).alias("chunk")).select(hash_of(F.col("chunk")).alias("hash"), "chunk")
    distinct = every.groupBy("hash", "chunk").agg(F.lit(1).alias("one"))
    # chunks cross the network once; only hashes do again
    shared = stored(distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "shared-hashes")
    if shared.isEmpty():
        return texts.sparkSession.createDataFrame([], "hash long, chunk string, rank int")
    ranked = every.join(shared, "hash", "left_semi").distinct()
    return ranked.select("hash", "chunk", F.row_number().over(W.partitionBy("hash").orderBy("chunk")).alias("rank"))


def recipes(texts: DataFrame, shared: DataFrame, hash_of: Callable[[Column], Column]) -> DataFrame:
    """``texts`` (columns of its own, and text) with ``recipe``, its ordered identifiers."""
    pieces = F.transform(chunks(F.col("text")), lambda c: hash_of(c))
    plain = F.transform(pieces, lambda h: F.struct(h.alias("hash"), F.lit(0).alias("rank")))
    if shared.isEmpty():
        return texts.withColumn("recipe", plain).drop("text")
    # some hash stands for two chunks: look the rank of each chunk up
    at = texts.select("row", F.posexplode(chunks(F.col("text"))).alias("at", "chunk"))
    named = (
        at.withColumn("hash", hash_of(F.col("chunk"))).join(shared, ["hash", "chunk"], "left")
        .select("row", "at", "hash", F.coalesce("rank", F.lit(0)).alias("rank"))
        # a document holds its own chunks only, so the list is as long as its text
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "hash", "rank"))).alias("all"))
        .select("row", F.transform("all", lambda x: F.struct(x["hash"].alias("hash"), x["rank"].alias("rank"))).alias("exact"))
    )
    # a text without chunks is empty, and so is its plain list
    return texts.withColumn("plain", plain).drop("text").join(named, "row", "left").withColumn(
        "recipe", F.coalesce("exact", "plain")).drop("exact", "plain")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hash_of: Callable[[Column], Column] = lambda chunk: F.xxhash64(chunk)) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("text"))
    shared = stored(collisions(texts, hash_of), "chunk-collisions")
    numbered = texts.select("doc_id", "text", F.monotonically_increasing_id().alias("row"),
                            F.sha2(F.col("text"), 256).alias("text_sha256"))
    if not shared.isEmpty():
        numbered = stored(numbered, "chunk-texts")  # row numbers must not change between two reads
    listed = stored(recipes(numbered, shared, hash_of), "chunk-recipes").withColumn("at", order_key("doc_id", "row"))
    # stored, so that the join shuffles both sides itself and may split the rows of a large group
    groups = stored(listed.groupBy("recipe").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.min("at").alias("first")), "chunk-groups")
    return listed.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", (F.col("at") == F.col("first")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns they came with."""
    mark = fresh("id")
    found = stored(exact_duplicates(docs, id_col, text_col), "exact-duplicates")
    keep = found.where("kept").select(F.col("doc_id").alias(mark), F.col("text_sha256").alias(mark + "t"))
    stay = docs.withColumn(mark + "s", F.sha2(normalised(text_col), 256))
    stay = stay.join(keep, F.col(id_col).eqNullSafe(F.col(mark)) & (F.col(mark + "s") == F.col(mark + "t")), "left_semi")
    repeated = found.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():  # rows that agree in id and text: one of them
        stay = stay.dropDuplicates([id_col, mark + "s"])
    return stay.drop(mark + "s")
