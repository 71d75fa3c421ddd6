"""SimHash near-duplicates: pigeonring candidates, Hamming check, connected groups.

A fingerprint's 64 bits form a ring of ``segments`` segments. If two fingerprints differ in at
most d bits there is a segment from which every chain of l consecutive segments differs in at
most l * d / segments bits (the pigeonring principle). With three segments and two bits: one
segment is equal, it and the next differ in at most one bit, all three in at most two. The
first two links of the chain are an equality join: a fingerprint is stored under (start,
segment, next segment) and looks itself up with every change of the next segment that the
budget allows. The remaining links and then the full Hamming distance are checked on the
pairs that meet. 43 of 64 bits select a pair, so candidates stay few as documents grow.

Equal fingerprints are one node, so a group of copies, however large, links to others once.
Groups are found by alternating large-star and small-star rounds over stored tables.

* null or empty text, or only white space: fingerprint zero, linked like any other
* null id: never the smallest id of a group unless the group has no other
* repeated rows share a fingerprint, so they are linked
* an empty table gives an empty result
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingline.llm.common import LAST_ID, chunks_of, fresh, order_key, stored, text_bytes

SHINGLE, BITS, SEGMENTS, SEED = 3, 2, 3, 42
#: Shingles hashed at a time, for bounded memory.
BLOCK = 1 << 16


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the shingles' hashes, repeats included."""
    words = text.lower().split()  # bytes: A-Z and the six white-space characters only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * total > len(starts)).tolist())


def with_fingerprint(docs: DataFrame, text_col: str, name: str, width: int = SHINGLE, keep_text: bool = False) -> DataFrame:
    """``docs`` without (or with) its text, and the fingerprint of the whole text."""
    at = docs.columns.index(text_col)
    fields = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    keep = [i for i, f in enumerate(docs.schema.fields) if keep_text or f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, 8 << 20, at):
            made = np.array([fingerprint(x, width) for x in text_bytes(batch.column(at))], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(made.view(np.int64))],
                                             [*(batch.schema.names[i] for i in keep), name])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(name, T.LongType())]))


def edges_of_segments(segments: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each segment."""
    cut = [round(i * 64 / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def _part(value: Column, segment: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(value, segment[0]).bitwiseAND(F.lit((1 << segment[1]) - 1))


def links(prints: DataFrame, bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints in ``prints`` (column fp) that differ
    in at most ``bits`` bits."""
    if segments <= bits:
        raise ValueError("more segments than bits are needed, so that one of them is equal")
    ring, fp = edges_of_segments(segments), F.col("fp")
    spare = 2 * bits // segments  # bits the second link may differ in: 0 or 1
    stands, looks = [], []
    for i in range(segments):
        here, following = ring[i], ring[(i + 1) % segments]
        a, b = _part(fp, here), _part(fp, following)
        stands.append(F.struct(F.lit(i).alias("start"), a.alias("here"), b.alias("following")))
        changes = [0, *(1 << k for k in range(following[1]) if spare)]
        looks.extend(F.struct(F.lit(i).alias("start"), a.alias("here"), b.bitwiseXOR(F.lit(c).cast("long")).alias("following")) for c in changes)
    key = ["start", "here", "following"]
    left = prints.select(fp.alias("b"), F.explode(F.array(*stands)).alias("k")).select("b", "k.*")
    right = prints.select(fp.alias("a"), F.explode(F.array(*looks)).alias("k")).select("a", "k.*")
    met = right.join(left, key).where("a < b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    chain = F.lit(False)
    for i in range(segments):
        kept, sums = F.col("start") == i, F.lit(0)
        for length in range(1, segments):
            sums = sums + F.bit_count(_part(differ, ring[(i + length - 1) % segments]))
            kept = kept & (sums <= length * bits // segments)
        chain = chain | kept
    return met.where(chain).where(F.bit_count(differ) <= bits).select("a", "b").distinct()


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(node, root) for the nodes of ``edges`` (columns u, v, of one orderable type): root is
    the smallest node of the connected component."""
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), name)
    seen = None
    while True:
        checks = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if checks == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seen = checks
        # large star: every larger neighbour of a node moves to the smallest one around it
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, name)
        # small star: a node and its smaller neighbours move to the smallest of them
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        moved = small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(moved.union(small.select("u", F.col("m").alias("v"))).distinct(), name)


def grouped(printed: DataFrame, bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """fp, root: the component of every distinct fingerprint of ``printed`` (fp, at), named by
    its smallest ``at``."""
    nodes = stored(printed.groupBy("fp").agg(F.min("at").alias("at")), "fingerprints")
    found = links(nodes.select("fp"), bits, segments)
    ends = nodes.withColumnsRenamed({"fp": "a", "at": "u"}), nodes.withColumnsRenamed({"fp": "b", "at": "v"})
    roots = components(found.join(ends[0], "a").join(ends[1], "b").select("u", "v"))
    return nodes.join(roots, nodes["at"] == roots["node"], "left").select("fp", F.coalesce("root", "at").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    printed = stored(with_fingerprint(slim, "text", "fp", width).withColumn("at", F.coalesce("doc_id", F.lit(LAST_ID))), "simhash")
    # stored, so that the join shuffles both sides itself and may split a fingerprint's rows
    roots = stored(grouped(printed, bits, segments), "groups")
    root = F.when(F.col("root") != LAST_ID, F.col("root"))
    return printed.join(roots, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), root.alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
             bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """Of each group the document with the smallest id, with the columns it came with."""
    fp, row, at = fresh("fp"), fresh("row"), fresh("at")
    # stored once, so row numbers are the same in every later read
    numbered = stored(with_fingerprint(docs, text_col, fp, width, keep_text=True)
                      .withColumn(row, F.monotonically_increasing_id()), "near-documents")
    printed = numbered.select(F.col(fp).alias("fp"), order_key(id_col, row).alias("at"))
    roots = grouped(printed, bits, segments).select(F.col("root").alias(at)).distinct()
    return numbered.join(roots, order_key(id_col, row) == F.col(at), "left_semi").drop(fp, row)
