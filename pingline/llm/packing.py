"""Packing tokenised documents into windows, planned by non-negative least squares.

A document is its token ids and an end id. Whole windows are cut off its front; what is left,
shorter than a window, is counted in a histogram of at most ``window`` bars. Every pair and
triple of lengths that fills a window exactly is a column; repeat counts x >= 0 minimise
|A x - histogram|. They are rounded up in order of size while the histogram lasts. Documents
take the places of the plan by their rank among those of their length. The residual ones are
packed greedily end to end and cut where a window ends; the tail of under one window becomes
sequences whose lengths are powers of two. So no sequence needs padding, and only residual
documents and those longer than a window are cut.

The plan depends on the histogram alone (at most window^2 / 12 columns); ranks and running
totals are taken per written part and chained through the parts' sums, so no length, however
common, meets in one task.

* null or empty text: the end id alone
* null id: packed like any other row; repeated rows are packed once each
* an empty table gives an empty result; other columns are ignored
"""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pingline.llm.common import chunks_of, stored

WINDOW, END_ID = 2048, 1
#: Words a worker remembers before it starts afresh, the ids it holds for them, and the longest of them.
REMEMBER, HOLD, LONGEST = 300_000, 5_000_000, 64
#: About the bytes the library gets at once, a word counting as 100 at least; what it returns is large.
LOT = 1 << 17
#: About the bytes of texts or ids a task works on at once.
CHUNK = 1 << 20
#: Letters that are whole by themselves: normal forms leave them alone, and each has one lower-case letter.
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]*"
PLAIN = LETTERS + "[" + re.escape(string.punctuation) + "]*"
#: What a vocabulary file must say for a word to fall into letters, in lower case, and signs behind them.
SEPARABLE = (
    [("NFC", None, None), ("Replace", {"Regex": "\\s+"}, " "), ("Lowercase", None, None)],
    [("Split", {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "Removed", True), ("ByteLevel", None, None, None)],
    ("BPE", None, "</w>"))
#: Rounds of the least-squares solver.
ROUNDS = 200


def _stretches(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``values`` in a row, and where each begins; the last entry is their end."""
    ends = np.zeros(len(sizes) + 1, np.int32)  # a batch holds a few million ids
    np.cumsum(sizes, out=ends[1:])
    at = np.arange(ends[-1], dtype=np.int32)
    at += np.repeat(starts - ends[:-1], sizes)
    return values[at], ends


def _listed(words: pa.Array) -> list[bytes]:
    """The words, none of which holds a space, as bytes."""
    row = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.binary()))
    return pc.binary_join(row, b" ")[0].as_py().split(b" ") if len(words) else []


class WordEncoder:
    """Ids of texts through the tokenizers library. No token spans white space, so a text's
    ids are its words' ids in a row, and words recur: a batch is split and its words numbered
    in Arrow, and only words not met before reach the library. Control strings in a text get
    the ids the library gives them.

    With a vocabulary that lower-cases and takes runs of letters and runs of signs apart, a word
    of letters and ASCII signs behind them is remembered as two, the letters in lower case, so
    that its other forms are not new. New runs of letters reach the library many in one text;
    each ends with the one of its ids that stands for the end of a word."""

    loaded: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        #: as narrow as the vocabulary allows
        self.dtype = "<u2" if len(vocabulary) <= 1 << 16 else "<u4"
        self.separable = self._separable(path)
        #: whether an id ends a word
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.forget()

    @staticmethod
    def _separable(path: str) -> bool:
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        normal, cut, model = rules.get("normalizer") or {}, rules.get("pre_tokenizer") or {}, rules["model"]
        made = ([(x["type"], x.get("pattern"), x.get("content")) for x in normal.get("normalizers", [])],
                [(x["type"], x.get("pattern"), x.get("behavior"), x.get("invert")) for x in cut.get("pretokenizers", [])],
                (model["type"], model.get("dropout"), model.get("end_of_word_suffix")))
        # a control string of letters and signs behind them would be cut
        return made == SEPARABLE and not any(re.fullmatch(PLAIN, x["content"]) for x in rules.get("added_tokens", []))

    def forget(self) -> None:
        #: word to its slot; a slot is a stretch of ``ids``
        self.known: dict[bytes, int] = {b"": 0}
        self.ids = np.zeros(0, self.dtype)
        self.starts = self.sizes = np.zeros(1, np.int32)

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def _made(self, words: list[bytes], letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words by the library, and how many each has."""
        if letters:
            made = self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)
            ids = np.array(made[0].ids, self.dtype)
            sizes = np.diff(np.flatnonzero(self.last[ids]), prepend=-1).astype(np.int32)
            if len(sizes) == len(words):
                return ids, sizes
        made = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        lists = [e.ids for e in made]
        return np.fromiter(chain.from_iterable(lists), self.dtype), np.fromiter(map(len, lists), np.int32, len(lists))

    def _slots(self, distinct: pa.Array, letters: bool) -> np.ndarray:
        words = _listed(distinct)
        out = np.fromiter(map(self.known.get, words, repeat(-1)), np.int32, len(words))
        new = np.flatnonzero(out < 0)
        if len(new):
            missing, first = [words[i] for i in new.tolist()], len(self.sizes)
            lots = np.cumsum(np.fromiter((max(len(w), 100) for w in missing), np.int64, len(missing))) // LOT
            cuts = [0, *(np.flatnonzero(np.diff(lots)) + 1).tolist(), len(missing)]
            made = [self._made(missing[a:b], letters) for a, b in pairwise(cuts)]
            self.ids = np.concatenate([self.ids, *(ids for ids, _ in made)])
            self.sizes = np.concatenate([self.sizes, *(sizes for _, sizes in made)])
            self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
            self.known.update((w, i) for i, w in enumerate(missing, first) if len(w) <= LONGEST)
            out[new] = np.arange(first, first + len(new))
        return out

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in a row, and where each word's begin and end."""
        if len(self.sizes) > REMEMBER or len(self.ids) > HOLD:
            self.forget()
        if not len(words):
            return self.ids[:0], np.zeros(1, np.int32)
        front = pc.ascii_rtrim(words, string.punctuation)
        plain = pc.match_substring_regex(front, f"^{LETTERS}$") if self.separable else pa.array(np.zeros(len(words), bool))
        front = pc.if_else(plain, front, "")
        lower = pc.utf8_lower(front).dictionary_encode()
        # a word that is not plain is all behind
        _, offsets, data = words.buffers()
        starts = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words)]
        skip = np.asarray(pc.binary_length(front))
        behind, bounds = _stretches(np.frombuffer(data, np.uint8), starts + skip, np.asarray(pc.binary_length(words)) - skip)
        behind = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(bounds), pa.py_buffer(behind)]).dictionary_encode()
        slots = np.empty(2 * len(words), np.int32)
        slots[::2] = self._slots(lower.dictionary, True)[np.asarray(lower.indices)]
        slots[1::2] = self._slots(behind.dictionary, False)[np.asarray(behind.indices)]
        ids, ends = _stretches(self.ids, self.starts[slots], self.sizes[slots])
        return ids, ends[::2]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin and end."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        words = split.flatten().dictionary_encode()
        ids, ends = self._words(words.dictionary)
        at = np.asarray(words.indices)
        ids, ends = _stretches(ids, ends[:-1][at], np.diff(ends)[at])
        bounds = np.asarray(split.offsets).astype(np.int64)
        return ids, ends[bounds - bounds[0]].astype(np.int64)


def encoded(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """row, doc_id, n, the bytes of an id, and the ids of each document with its end id.
    ``vocabulary`` is a file every executor has."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, CHUNK, 1):
            encoder = WordEncoder.of(vocabulary)
            ids, bounds = encoder.encode(batch.column(1))
            n = batch.num_rows
            # each text's ids move up by the end ids of the texts before it
            whole = np.full(len(ids) + n, end_id, encoder.dtype)
            whole[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(bounds))] = ids
            wide = whole.itemsize
            offsets = ((bounds + np.arange(n + 1)) * wide).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds) + 1, pa.int64()), pa.array(np.full(n, wide), pa.int32()),
                 pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(whole)])],
                ["doc_id", "n", "wide", "ids"])

    made = slim.mapInArrow(run, f"doc_id {kind}, n long, wide int, ids binary")
    return made.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n", "wide", "ids")


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Every pair and triple (0: no third) of the lengths that fills the window, as rows."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    found = []
    for a in lengths.tolist():
        b = np.arange(a, (window - a) // 2 + 1)  # a <= b <= c
        b = b[there[b]]
        c = window - a - b
        ok = there[c] & (c >= b) & (c > 0)
        found.append(np.stack([np.full(int(ok.sum()), a), b[ok], c[ok]], axis=1))
        if window - a >= a and there[window - a]:
            found.append(np.array([[a, window - a, 0]]))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def least_squares(columns: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """x >= 0 towards the minimum of |A x - histogram|, by multiplicative updates; column j
    of A counts the lengths in combination j."""
    size, (a, b, c) = len(histogram), columns.T
    third = (c > 0).astype(float)

    def total(x: np.ndarray) -> np.ndarray:
        return np.bincount(a, x, size) + np.bincount(b, x, size) + np.bincount(c, x * third, size)

    def gather(y: np.ndarray) -> np.ndarray:
        return y[a] + y[b] + y[c] * third

    wanted = gather(histogram.astype(float))
    x = np.minimum(np.minimum(histogram[a], histogram[b]), np.where(c > 0, histogram[c], histogram[a])) / 3.0
    for _ in range(rounds):
        x *= wanted / np.maximum(gather(total(x)), 1e-12)
    return x


def plan(histogram: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places (length, first rank, end rank, first sequence, offset) sorted by length and rank,
    how many documents of each length have one, and the number of sequences."""
    columns = combinations(np.flatnonzero(histogram), window)
    places, taken, sequences = [], np.zeros(len(histogram), np.int64), 0
    if len(columns):
        x = least_squares(columns, histogram)
        left = histogram.tolist()
        for j in np.argsort(-x, kind="stable").tolist():
            parts = [p for p in columns[j].tolist() if p]
            times = min(int(np.ceil(x[j] - 1e-9)), *(left[p] // parts.count(p) for p in parts))
            if times <= 0:
                continue
            offset = 0
            for p in parts:
                places.append((p, int(taken[p]), int(taken[p]) + times, sequences, offset))
                taken[p] += times
                left[p] -= times
                offset += p
            sequences += times
    return np.array(sorted(places), np.int64).reshape(-1, 5), taken, sequences


def _chained(df: DataFrame, amount: str, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` (part, row, ...) with the total of ``amount`` in the rows before each, within
    ``by``: running totals inside each part, plus the sums of the parts before."""
    inside = W.partitionBy("part", *by).orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    sums = df.groupBy("part", *by).agg(F.sum(amount).alias("_sum"))
    before = W.partitionBy(*by).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("part", *by, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    run = df.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return run.join(sums, ["part", *by]).withColumn(name, F.col("_inside") + F.col("_before")).drop("_inside", "_before")


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset."""
    texts = stored(encoded(docs, vocabulary, id_col, text_col, end_id), "encoded")
    slim = texts.select("row", F.expr("row >> 33").alias("part"), F.lit(1).alias("one"),
                        (F.col("n") % window).alias("rest"), F.floor(F.col("n") / window).alias("whole"))
    bars = slim.where("rest > 0").groupBy("rest").agg(F.count("*").alias("n")).collect()  # under ``window`` rows
    histogram = np.zeros(window + 1, np.int64)
    for b in bars:
        histogram[b["rest"]] = b["n"]
    places, taken, planned = plan(histogram, window)
    number = np.arange(window + 1)
    left = int(((histogram - taken) * number).sum())
    ends = planned + left // window  # then come the tail's sequences, then the whole windows
    tail = [1 << k for k in range(left.bit_length(), -1, -1) if (left % window) >> k & 1 and 1 << k < window]
    tail_from = np.cumsum([0, *tail])
    whole_from = ends + len(tail)

    ranked = _chained(slim, "one", "rank", ("rest",))
    short = F.array(*(F.lit(int(t)) for t in taken))
    ranked = stored(ranked.withColumn("residual", F.when(
        F.col("rank") >= F.element_at(short, F.col("rest").cast("int") + 1), F.col("rest")).otherwise(0)), "ranked")
    placed = _chained(_chained(ranked, "residual", "at"), "whole", "before").select("row", "rank", "residual", "at", "before")
    key = (places[:, 0] << 44) + places[:, 1] if len(places) else np.zeros(0, np.int64)

    def residual_pieces(n: int, residual: int, at: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of a rest that lies end to end with others."""
        start = n - residual
        while residual:
            sequence, offset = divmod(at, window)
            most, sequence = window - offset, sequence + planned
            if sequence >= ends:
                i = int(np.searchsorted(tail_from, offset, "right")) - 1
                sequence, most, offset = ends + i, int(tail_from[i + 1]) - offset, offset - int(tail_from[i])
            cut = min(residual, most)
            yield start, cut, sequence, offset
            start, at, residual = start + cut, at + cut, residual - cut

    def pieces(n: np.ndarray, rank: np.ndarray, residual: np.ndarray, at: np.ndarray, before: np.ndarray) -> np.ndarray:
        """(row, start, length, sequence, offset) of all pieces of a batch, in order."""
        full, rest = np.divmod(n, window)
        row = np.repeat(np.arange(len(n)), full)
        k = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
        found = [np.stack([row, k * window, np.full(len(row), window), whole_from + before[row] + k, np.zeros(len(row), np.int64)])]
        in_plan = np.flatnonzero((rest > 0) & (residual == 0))
        if len(in_plan):
            place = places[np.searchsorted(key, (rest[in_plan] << 44) + rank[in_plan], "right") - 1]
            found.append(np.stack([in_plan, full[in_plan] * window, rest[in_plan], place[:, 3] + rank[in_plan] - place[:, 1], place[:, 4]]))
        some = [(i, *p) for i in np.flatnonzero(residual).tolist() for p in residual_pieces(int(n[i]), int(residual[i]), int(at[i]))]
        if some:
            found.append(np.array(some, np.int64).T)
        out = np.concatenate(found, axis=1)
        return out[:, np.lexsort((out[1], out[0]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        WordEncoder.loaded.clear()  # all words are encoded; a worker that did so holds many
        pa.default_memory_pool().release_unused()
        for batch in chunks_of(batches, CHUNK, 3):
            n, rank, residual, at, before = (np.asarray(batch.column(c)).astype(np.int64) for c in ("n", "rank", "residual", "at", "before"))
            wide = batch.column("wide")[0].as_py()
            # pieces in order are the ids in order, so they share one buffer
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), f"<u{wide}").astype("<u4")
            row, start, length, sequence, offset = pieces(n, rank, residual, at, before)
            bounds = np.concatenate([[0], np.cumsum(length * 4)]).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), data, pa.array(n[row]), pa.array(sequence), pa.array(offset)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.join(placed, "row").select("doc_id", "n", "wide", "ids", "rank", "residual", "at", "before").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
