"""Ranked lexical search, exact, by inner products over sparse ball trees.

A document is a vector over the terms that the queries hold: a term's component is its
saturated frequency, scaled by the root of the term's weight; a query has the roots of its
terms' weights. Their inner product is the score. Documents come in blocks; a block is a tree
of balls, halved between two far documents until a leaf holds ``LEAF``. No document of a ball
scores more than query · centroid + |query| · radius. That bound is rounded up (``SLACK`` is
far above what doubles lose in these sums), so a subtree is passed over only if all of it
scores below the k-th best found so far. Subtrees are opened best bound first; at a leaf the
scores are computed in whole numbers. What a task has found carries over to its next block.

1. Items' terms form a vocabulary; items come in lots of about ``LOT`` terms, so what tasks
   are given has a bound however many items there are.
2. One pass over the texts counts each document's terms, and stores the components of the
   documents that hold any, with the sums of the corpus: N, L and the documents per term.
3. One pass over the stored vectors searches all items of the lot, best documents per task.
4. The k best of the tasks' best are ranked.

* null or empty text: no terms; null document id: after all others of its score
* repeated rows: documents of their own; repeated items are ranked each
* an item without terms, or with no document above 0: no row
* an empty table gives an empty result; other columns are ignored
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

from pingline.llm.common import LAST_ID, chunks_of, stored, text_bytes

BEST = 10
#: Fixed values of the score.
SCALE, TF, LENGTH_SHARE, LEAST_LENGTH, SATURATION = 1_000_000_000, 1000, 90, 10, 8
#: Distinct (item, term) pairs searched together; documents and components of a tree; of a leaf.
LOT, BLOCK, COMPONENTS, LEAF = 1 << 17, 4096, 1 << 20, 64
#: Relative and absolute slack of a bound.
SLACK = 1e-9
#: Bytes split into terms at a time.
PIECE = 1 << 20

#: ASCII but digits and letters separates terms; A-Z become a-z; all other bytes belong to terms.
_SEPARATE = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    text = text.translate(_SEPARATE)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE) if len(text) - at > PIECE else -1
        yield text[at:end if end >= 0 else len(text)].split()
        at = end if end >= 0 else len(text)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, terms = [], []
        for i, text in enumerate(text_bytes(batch.column(2))):
            found = {t for some in terms_of(text) for t in some}
            rows.extend([i] * len(found))
            terms.extend(sorted(found))
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(terms, pa.binary())],
                                         ["query", "item_id", "term"])


class Items:
    """The items of a lot: terms by number, and each item's terms."""

    def __init__(self, rows: list[tuple[int, object, bytes]]):
        self.number: dict[bytes, int] = {}
        self.ids: list[object] = []
        of: dict[int, list[int]] = {}
        for query, item, term in rows:
            if query not in of:
                of[query] = []
                self.ids.append(item)
            of[query].append(self.number.setdefault(bytes(term), len(self.number)))
        self.queries = list(of)
        self.terms = [np.array(sorted(t), np.int64) for t in of.values()]


def _counter(items):
    """Texts (doc_id, text) to vectors (doc_id, n, terms, counts), and one last row per task:
    n is the sum of all n, ``documents`` counts those with a term, and terms and counts hold
    the documents per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = items.value.number
        held = np.zeros(len(number), np.int64)
        total = documents = 0
        for batch in chunks_of(batches, PIECE, 1):
            found, sizes = [], []
            for text in text_bytes(batch.column(1)):
                mine, n = [], 0
                for some in terms_of(text):
                    n += len(some)
                    ids = np.fromiter(map(number.get, some, repeat(-1)), np.int64, len(some))
                    mine.append(ids[ids >= 0])
                found.append(np.unique(np.concatenate(mine), return_counts=True) if mine else (np.zeros(0, np.int64),) * 2)
                sizes.append(n)
            total += sum(sizes)
            documents += sum(n > 0 for n in sizes)
            on = [i for i, (t, _) in enumerate(found) if len(t)]
            for i in on:
                held[found[i][0]] += 1
            yield _vectors(batch.column(0).take(pa.array(on, pa.int64())), [sizes[i] for i in on], [None] * len(on), [found[i] for i in on])
        there = np.flatnonzero(held)
        yield _vectors(pa.array([None], pa.int64()), [total], [documents], [(there, held[there])])

    return run


def _vectors(ids: pa.Array, n: list[int], documents: list, found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n, pa.int64()), pa.array(documents, pa.int64()), pa.array([len(t) for t, _ in found], pa.int32()),
         pa.array([t.astype("<i4").tobytes() for t, _ in found], pa.binary()), pa.array([c.astype("<i8").tobytes() for _, c in found], pa.binary())],
        ["doc_id", "n", "documents", "size", "terms", "counts"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for terms, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms, "<i4")), pa.array(np.frombuffer(counts, "<i8"))], ["term", "documents"])


def weights(corpus: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * corpus + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)


class Tree:
    """A block of documents as balls. Rows of the block lie in the order of the leaves."""

    def __init__(self, ptr: np.ndarray, term: np.ndarray, part: np.ndarray, value: np.ndarray, queries: Queries):
        """Row i holds term[ptr[i]:ptr[i+1]], its whole-number saturation ``part`` and scaled
        component ``value``."""
        self.limits: list[np.ndarray] = []  # per node, the bound of every query
        self.nodes: list[tuple[int, int, int, int]] = []  # rows from, to; children or -1
        order = np.arange(len(ptr) - 1)
        norm = np.add.reduceat(value * value, ptr[:-1])

        def grow(rows: np.ndarray, start: int) -> int:
            size = ptr[rows + 1] - ptr[rows]
            first = np.cumsum(size) - size
            at = np.repeat(ptr[rows] - first, size) + np.arange(size.sum())
            t, v = term[at], value[at]
            centre = np.bincount(t, v, queries.width) / len(rows)
            square = centre @ centre
            far = norm[rows] - 2 * np.add.reduceat(centre[t] * v, first) + square
            most = np.maximum(far.max(), 0) + SLACK * (norm[rows].max() + square)
            me = len(self.nodes)
            self.nodes.append((start, start + len(rows), -1, -1))
            self.limits.append(queries.bounds(centre, math.sqrt(most)))
            if len(rows) > LEAF and far.max() > SLACK * square:
                def apart(i: int) -> np.ndarray:
                    pivot = np.zeros(queries.width)
                    a, b = ptr[rows[i]], ptr[rows[i] + 1]
                    pivot[term[a:b]] = value[a:b]
                    return norm[rows] - 2 * np.add.reduceat(pivot[t] * v, first) + norm[rows[i]]

                left = apart(int(far.argmax()))
                side = np.argsort(left - apart(int(left.argmax())), kind="stable")
                half = len(rows) // 2
                order_left, order_right = rows[side[:half]], rows[side[half:]]
                a = grow(order_left, start)
                b = grow(order_right, start + half)
                self.nodes[me] = (start, start + len(rows), a, b)
            else:
                order[start:start + len(rows)] = rows
            return me

        grow(np.arange(len(ptr) - 1), 0)
        self.order = order
        size = np.diff(ptr)[order]
        self.ptr = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(ptr[order] - self.ptr[:-1], size) + np.arange(len(term))
        self.term, self.part = term[at], part[at]
        self.bound = np.stack(self.limits)


class Queries:
    """The items of a lot with their weights, and the best documents found for each."""

    def __init__(self, items: Items, weight: np.ndarray, best: int):
        self.items, self.weight, self.best, self.width = items, weight, best, len(weight)
        self.root = np.sqrt(weight.astype(float))
        sizes = np.array([len(t) for t in items.terms])
        self.starts = np.cumsum(sizes) - sizes
        self.flat = np.concatenate(items.terms)
        self.norm = np.sqrt(np.add.reduceat(self.root[self.flat] ** 2, self.starts))
        self.found: list[list[tuple[int, int]]] = [[] for _ in items.terms]  # (-score, id), best first
        self.least = np.ones(len(items.terms), np.int64)  # what a document must score to matter
        self.opened = self.passed = 0

    def bounds(self, centre: np.ndarray, radius: float) -> np.ndarray:
        inner = np.add.reduceat((self.root * centre)[self.flat], self.starts)
        return (inner + self.norm * radius) * (1 + SLACK) + 1

    def search(self, tree: Tree, ids: np.ndarray) -> None:
        mine = np.zeros(self.width, np.int64)
        for q in np.flatnonzero(tree.bound[0] >= self.least).tolist():
            terms, bound = self.items.terms[q], tree.bound[:, q]
            mine[terms] = self.weight[terms]
            queue = [(-bound[0], 0)]
            while queue:
                limit, node = heapq.heappop(queue)
                if -limit < self.least[q]:
                    break
                start, end, left, right = tree.nodes[node]
                if left >= 0:
                    for child in (left, right):
                        if bound[child] >= self.least[q]:
                            heapq.heappush(queue, (-bound[child], child))
                    continue
                self.opened += 1
                a, b = tree.ptr[start], tree.ptr[end]
                score = np.add.reduceat(mine[tree.term[a:b]] * tree.part[a:b], tree.ptr[start:end] - a)
                hit = np.flatnonzero(score >= self.least[q])
                if len(hit):
                    self._take(q, score[hit], ids[tree.order[start + hit]])
            mine[terms] = 0

    def _take(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        both = sorted([*self.found[q], *zip((-score).tolist(), ids.tolist())])[: self.best]
        self.found[q] = both
        if len(both) == self.best:
            self.least[q] = max(1, -both[-1][0])


def _searcher(items, weight: np.ndarray, corpus: int, length: int, best: int, kind: pa.DataType):
    """Vectors to the best documents of every item in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(items.value, weight, best)
        held: list[tuple] = []

        def flush() -> None:
            ids, n, sizes, terms, counts = (np.concatenate(x) for x in zip(*held))
            held.clear()
            ptr = np.concatenate([[0], np.cumsum(sizes)])
            room = np.array([LEAST_LENGTH + LENGTH_SHARE * x * corpus // length for x in n.tolist()], np.int64)
            part = (SCALE * counts) // (TF * counts + SATURATION * np.repeat(room, sizes))
            queries.search(Tree(ptr, terms, part, part * queries.root[terms], queries), ids)

        components = documents = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.array([LAST_ID if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            sizes = np.asarray(batch.column(2)).astype(np.int64)
            held.append((ids, np.asarray(batch.column(1)), sizes,
                         np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i4").astype(np.int64),
                         np.frombuffer(b"".join(batch.column(4).to_pylist()), "<i8")))
            components, documents = components + int(sizes.sum()), documents + len(ids)
            if documents >= BLOCK or components >= COMPONENTS:
                flush()
                components = documents = 0
        if held:
            flush()
        rows = [(number, item, -score, doc) for number, item, some in zip(queries.items.queries, queries.items.ids, queries.found) for score, doc in some]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), kind, pa.int64(), pa.int64()))],
                                         ["query", "item_id", "score", "doc"])

    return run


def _lots(terms: DataFrame) -> list[DataFrame]:
    """(query, item_id, term) in parts of about LOT rows, items whole."""
    total = terms.count()
    number = -(-total // LOT)
    lot = F.pmod(F.xxhash64("query"), F.lit(number))
    return [terms] if number == 1 else [terms.where(lot == i) for i in range(number)]


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of every row of ``items``."""
    spark = docs.sparkSession
    # numbered once and stored, so that repeated items stay apart
    slim = items.select(F.monotonically_increasing_id().alias("query"), F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    kind = slim.schema["item_id"].dataType
    terms = stored(slim.mapInArrow(_item_terms, f"query long, item_id {kind.simpleString()}, term binary"), "item-terms")
    found = None
    for lot in _lots(terms):
        some = _search_lot(spark, docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), lot, best, kind)
        if some is not None:
            found = some if found is None else found.unionByName(some)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    order = W.partitionBy("query").orderBy(F.col("score").desc(), "doc")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("item_id", "rank", F.when(F.col("doc") != LAST_ID, F.col("doc")).alias("doc_id"), "score")


def _search_lot(spark: SparkSession, docs: DataFrame, lot: DataFrame, best: int, kind) -> DataFrame | None:
    rows = lot.orderBy("query", "term").collect()  # about LOT terms
    if not rows:  # no item fell into this lot
        return None
    items = spark.sparkContext.broadcast(Items([tuple(r) for r in rows]))
    vectors = stored(docs.mapInArrow(_counter(items), "doc_id long, n long, documents long, size int, terms binary, counts binary"), "vectors")
    sums = vectors.where("documents IS NOT NULL")
    corpus, length = sums.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(items.value.number), np.int64)
    per_term = sums.select("terms", "counts").mapInArrow(_sums, "term int, documents long").groupBy("term").agg(F.sum("documents").alias("n"))
    for term, n in per_term.collect():  # one row per term of the lot
        holding[term] = n
    # rich documents first, so that the bar to pass is high from the start
    rich = vectors.where("documents IS NULL").sortWithinPartitions(F.col("size").desc())
    return rich.select("doc_id", "n", "size", "terms", "counts").mapInArrow(
        _searcher(items, weights(corpus, holding), corpus, length, best, to_arrow_type(kind)),
        f"query long, item_id {kind.simpleString()}, score long, doc long")
