"""Approximate nearest neighbours by cosine, through stable projections and kd-trees.

Vectors of length one are projected on ``DIMENSIONS`` Gaussian directions. The Gaussian is
2-stable, so for two vectors at distance d the squared distance of their projections, divided
by d², follows the chi-square law with that many degrees of freedom. Projected neighbours are
taken in order of distance, leaf by leaf of a kd-tree, and verified against the vectors. The
search stops when the next one lies so far off that a vector nearer than the k-th best would
have been projected nearer with probability ``SURE``: each true neighbour is found with at
least that probability. Nothing else ends a search; there is no cap on what it verifies.

1. Equal vectors are one: of their rows the k + 1 smallest ids stand for all, so a group of
   copies, however large, is never searched pair by pair.
2. The top of the kd-tree splits the space into cells, at medians of the ``SAMPLE`` rows with
   the smallest hash. Every row is dealt to its cell; a cell of more than ``ROWS`` rows is cut
   into chunks. Each chunk has a kd-tree of its own.
3. Every query visits one chunk of its own cell, which gives a first k-th best distance.
4. Then it visits all chunks of the cells that its test does not rule out. Queries come in
   lots of about ``QUERIES``, neighbouring ones together, so one task holds one chunk and one lot.
5. The best of the visits are ranked, and shared out to the queries with that vector.

* vectors that are null, all zero, of another length than most, or that hold a null or
  non-finite component: take no part, neither as query nor as candidate
* null id: no query; as a candidate after all others of its score
* repeated ids: rows with the query's id are its own and never its neighbours
* ties: smaller id first; fewer candidates than k: all of them
* an empty table gives an empty result; other columns are ignored
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from pingline.llm.common import LAST_ID, stored

NEAREST, DIMENSIONS, SURE, SEED = 5, 8, 0.95, 11
#: Rows the cells are fitted on, rows of a chunk, queries of a lot, rows of a leaf, most cells.
SAMPLE, ROWS, QUERIES, LEAF, CELLS = 1 << 14, 8192, 8192, 128, 1024
#: Squared distances this close are not told apart.
CLOSE = 1e-12


def chi_square(x: float, freedom: int) -> float:
    """Distribution function, for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(freedom // 2):
        total += term
        term *= half / (i + 1)
    return 1 - math.exp(-half) * total


def quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 100.0 * freedom
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < share else (low, middle)
    return high


def directions(width: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.RandomState(SEED).standard_normal((width, dimensions))


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors in double precision, times a power of two that keeps sums finite, and their lengths."""
    vectors = vectors.astype(float)
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    return vectors, np.sqrt((vectors * vectors).sum(axis=1))


def _projector(width: int, element: str, dimensions: int):
    """Batches (id, array) to the usable rows: vec_id, vec (bytes), at (bytes of the projection)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        onto = directions(width, dimensions)
        for batch in batches:
            right = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), width), False)
            batch = batch.filter(right)
            flat = batch.column(1).flatten()
            values = np.asarray(flat.to_numpy(zero_copy_only=False), element).reshape(-1, width)
            usable = np.isfinite(values).all(axis=1) & (values != 0).any(axis=1)
            values = np.ascontiguousarray(values[usable]) + np.dtype(element).type(0)  # no negative zero
            if not len(values):
                continue
            unit, length = scaled(values)
            at = (unit / length[:, None]) @ onto
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(usable)), pa.array([v.tobytes() for v in values], pa.binary()),
                 pa.array([a.tobytes() for a in at], pa.binary())], ["vec_id", "vec", "at"])

    return run


class Cells:
    """The top of the kd-tree: cells numbered from left to right."""

    def __init__(self, sample: np.ndarray, number: int):
        depth = max(0, math.ceil(math.log2(max(1, number))))
        self.number = 1 << depth
        size = sample.shape[1] if sample.ndim == 2 and len(sample) else DIMENSIONS
        self.low, self.high = np.full((self.number, size), -np.inf), np.full((self.number, size), np.inf)
        self.splits: list[list[tuple[int, float]]] = [[] for _ in range(depth)]

        def split(rows: np.ndarray, level: int, first: int) -> None:
            if level == depth:
                return
            axis, cut = 0, 0.0
            if len(rows):
                axis = int(np.argmax(rows.max(axis=0) - rows.min(axis=0)))
                cut = float(np.median(rows[:, axis]))
            span = 1 << (depth - level)
            self.high[first:first + span // 2, axis] = np.minimum(self.high[first:first + span // 2, axis], cut)
            self.low[first + span // 2:first + span, axis] = np.maximum(self.low[first + span // 2:first + span, axis], cut)
            self.splits[level].append((axis, cut))
            right = rows[:, axis] > cut if len(rows) else np.zeros(0, bool)
            split(rows[~right], level + 1, first)
            split(rows[right], level + 1, first + span // 2)

        split(sample, 0, 0)

    def of(self, at: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(at), np.int64)
        for level in self.splits:  # in order of the nodes, left to right
            axes, cuts = np.array([a for a, _ in level]), np.array([c for _, c in level])
            cell = 2 * cell + (at[np.arange(len(at)), axes[cell]] > cuts[cell])
        return cell

    def square_from(self, at: np.ndarray) -> np.ndarray:
        """Least squared distance of every cell."""
        off = np.maximum(np.maximum(self.low - at, at - self.high), 0)
        return (off * off).sum(axis=1)


class Tree:
    """A kd-tree over one chunk's projections, for incremental search."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, at: np.ndarray):
        leaves: list[np.ndarray] = []
        pending = [np.arange(len(at))]
        while pending:
            rows = pending.pop()
            spread = at[rows].max(axis=0) - at[rows].min(axis=0)
            if len(rows) <= LEAF or spread.max() == 0:
                leaves.append(rows)
                continue
            axis = int(np.argmax(spread))
            order = rows[np.argpartition(at[rows, axis], len(rows) // 2)]
            pending += [order[: len(rows) // 2], order[len(rows) // 2:]]
        order = np.concatenate(leaves)
        self.ptr = np.concatenate([[0], np.cumsum([len(x) for x in leaves])])
        self.low, self.high = (np.stack([f(at[x], axis=0) for x in leaves]) for f in (np.min, np.max))
        self.ids, self.at = ids[order], at[order]
        self.vectors, self.lengths = scaled(vectors[order])
        self.units = self.vectors / self.lengths[:, None]
        self.verified = 0

    def nearest(self, vector: np.ndarray, length: float, at: np.ndarray, k: int, bar: float, kth: float) -> list[tuple[float, int]]:
        """(-score, id) of the k best found. ``bar`` is the chi-square quantile of the stopping
        test, ``kth`` a squared distance within which k vectors are known to lie."""
        off = np.maximum(np.maximum(self.low - at, at - self.high), 0)
        square = (off * off).sum(axis=1)
        order, unit = np.argsort(square), vector / length
        found, rows = np.zeros(0), np.zeros(0, np.int64)
        done, step = 0, 1
        while done < len(order) and square[order[done]] <= bar * kth + CLOSE:  # the stopping test
            leaves = order[done:done + step]
            leaves = leaves[square[leaves] <= bar * kth + CLOSE]
            some = np.concatenate([np.arange(self.ptr[x], self.ptr[x + 1]) for x in leaves.tolist()])
            apart = self.at[some] - at
            some = some[(apart * apart).sum(axis=1) <= bar * kth + CLOSE]
            self.verified += len(some)
            found, rows = np.concatenate([found, self.units[some] @ unit]), np.concatenate([rows, some])
            if len(found) > k:
                least = np.partition(found, len(found) - k)[len(found) - k]
                on = found >= least - CLOSE  # exact scores decide between those this close
                found, rows = found[on], rows[on]
                kth = min(kth, max(0.0, 2 - 2 * least))
            done, step = done + len(leaves), 2 * step
        exact = (self.vectors[rows] * vector).sum(axis=1) / (self.lengths[rows] * length)
        return sorted(zip((-exact).tolist(), self.ids[rows].tolist()))[:k]


def _matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _visits(element: str, k: int, bar: float):
    """One chunk and one lot of queries that visit it, to (q, doc, score)."""

    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if points.num_rows and queries.num_rows:
            tree = Tree(np.asarray(points["vec_id"]), _matrix(points["vec"], element), _matrix(points["at"], float))
            vectors, lengths = scaled(_matrix(queries["vec"], element))
            for q, vector, length, at, kth in zip(queries["q"].to_pylist(), vectors, lengths, _matrix(queries["at"], float), queries["kth"].to_pylist()):
                for score, doc in tree.nearest(vector, length, at, k, bar, kth):
                    for column, value in zip(out, (q, doc, -score)):
                        column.append(value)
        return pa.table({"q": pa.array(out[0], pa.int64()), "doc": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return run


def _with_cell(cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = cells.of(_matrix(batch.column("at"), float))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], [*batch.schema.names, "cell"])

    return run


def _cells_to_visit(cells: Cells, bar: float, chunks: np.ndarray):
    """Queries to one row per chunk whose cell the stopping test does not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, kth = _matrix(batch.column("at"), float), np.asarray(batch.column("kth"))
            for i in range(batch.num_rows):
                near = np.flatnonzero((cells.square_from(at[i]) <= bar * kth[i] + CLOSE) & (chunks > 0))
                cell = np.repeat(near, chunks[near])
                chunk = np.arange(len(cell)) - np.repeat(np.cumsum(chunks[near]) - chunks[near], chunks[near])
                row = batch.take(pa.array(np.full(len(cell), i)))
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array(cell.astype(np.int32)), pa.array(chunk.astype(np.int32))],
                                                 [*row.schema.names, "cell", "chunk"])

    return run


def _per_cell(df: DataFrame, cells: Cells) -> np.ndarray:
    out = np.zeros(cells.number, np.int64)
    for cell, n in df.groupBy("cell").count().collect():  # at most CELLS rows
        out[cell] = n
    return out


def _lots(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First lot and number of lots of every cell; small neighbouring cells share one."""
    first, number = np.zeros(len(counts), np.int64), np.maximum(1, -(-counts // QUERIES))
    lot = held = 0
    for cell, n in enumerate(counts.tolist()):
        if held and held + n > QUERIES:
            lot, held = lot + 1, 0
        first[cell] = lot
        if n > QUERIES:
            lot, held = lot + int(number[cell]), 0
        else:
            held += n
    return first, number


def _pick(values: np.ndarray, cell: str):
    return F.element_at(F.array(*(F.lit(int(x)) for x in values)), F.col(cell) + 1)


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST,
            dimensions: int = DIMENSIONS, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of ``vectors`` found for every row
    of ``queries``, both with an id and a vector column."""
    spark = vectors.sparkSession
    element = "<f4" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    array = "array<float>" if element == "<f4" else "array<double>"
    slim = [df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("vec_id"), F.col(vector_col).cast(array).alias("vec")) for df in (vectors, queries)]
    widths = slim[0].where("vec IS NOT NULL").groupBy(F.size("vec").alias("width")).count().where("width > 0")
    width = widths.orderBy(F.col("count").desc(), "width").select("width").first()
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if width is None:
        return none
    rows = [df.mapInArrow(_projector(width[0], element, dimensions), "vec_id long, vec binary, at binary") for df in slim]
    bar = quantile(sure, dimensions)

    # the k + 1 smallest ids of each vector
    least = W.partitionBy("vec").orderBy("vec_id")
    points = stored(rows[0].distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1).drop("n"), "points")
    asked = stored(rows[1].where(F.col("vec_id") != LAST_ID).distinct(), "queries")
    number = points.count()
    if not number:
        return none
    sample = points.orderBy(F.xxhash64("vec"), "vec_id").limit(SAMPLE).select("at").toArrow()["at"]
    cells = Cells(_matrix(sample, float), min(CELLS, -(-number // ROWS)))
    points = points.mapInArrow(_with_cell(cells), "vec_id long, vec binary, at binary, cell int")
    chunks = -(-_per_cell(points, cells) // ROWS)
    points = points.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.greatest(_pick(chunks, "cell"), F.lit(1))).cast("int"))

    # a query is a distinct vector, named by its smallest id
    named = asked.groupBy("vec").agg(F.min("vec_id").alias("q"), F.first("at").alias("at")).mapInArrow(
        _with_cell(cells), "vec binary, q long, at binary, cell int")
    named = stored(named, "distinct-queries")
    first, lots = _lots(_per_cell(named, cells))
    lot = (_pick(first, "cell") + F.pmod(F.xxhash64("q"), _pick(lots, "cell"))).cast("int")
    named = named.select("q", "vec", "at", lot.alias("lot"), F.col("cell").alias("home"))
    visit = _visits(element, k + 1, bar)

    def visited(visits: DataFrame) -> DataFrame:
        key = ["cell", "chunk", "lot"]
        needed = visits.select(*(F.col(c).alias(f"to_{c}") for c in key)).distinct()
        there = points.join(needed, (F.col("cell") == F.col("to_cell")) & (F.col("chunk") == F.col("to_chunk"))).select(
            "vec_id", "vec", "at", *(F.col(f"to_{c}").alias(c) for c in key))
        return there.groupBy(*key).cogroup(visits.groupBy(*key)).applyInArrow(visit, "q long, doc long, score double")

    # no bound is known yet, so the first visit verifies its chunk until the test stops it
    home = F.pmod(F.xxhash64("q"), F.greatest(_pick(chunks, "home"), F.lit(1))).cast("int")
    opening = visited(named.select("q", "vec", "at", "lot", F.lit(4.0).alias("kth"), F.col("home").alias("cell"), home.alias("chunk")))
    bound = opening.groupBy("q").agg(F.min("score").alias("score"), F.count("*").alias("n"))
    bound = stored(bound.select("q", F.when(F.col("n") > k, F.greatest(2 - 2 * F.col("score"), F.lit(0.0))).otherwise(4.0).alias("kth")), "bounds")
    visits = named.join(bound, "q", "left").select("q", "vec", "at", "lot", F.coalesce("kth", F.lit(4.0)).alias("kth")).mapInArrow(
        _cells_to_visit(cells, bar, chunks), "q long, vec binary, at binary, lot int, kth double, cell int, chunk int")
    best = W.partitionBy("q").orderBy(F.col("score").desc(), "doc")
    found = stored(visited(visits).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1), "neighbours")

    members = asked.select("vec_id", "vec").join(named.select("q", "vec"), "vec").select("q", F.col("vec_id").alias("query_id"))
    mine = F.array_sort(F.collect_list(F.struct("place", "doc", "score")))
    lists = found.groupBy("q").agg(mine.alias("found"))  # at most k + 1 each
    others = F.slice(F.filter("found", lambda x: x["doc"] != F.col("query_id")), 1, k)
    return members.join(lists, "q").select("query_id", F.posexplode(others).alias("i", "x")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"),
        F.when(F.col("x.doc") != LAST_ID, F.col("x.doc")).alias("vec_id"), F.col("x.score").alias("score"))
