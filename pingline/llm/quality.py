"""Quality rules whose cutoffs are chosen under a proven limit on false rejections.

Per stratum, labelled clean documents are the holdout. A rule with cutoff c rejects k of its
n clean documents; the cutoff is certified if a share ``alpha`` of false rejections would
make so few rejections unlikely: P(Bin(n, alpha) <= k) <= level (the one-sided exact
binomial bound). Cutoffs of a rule are tested from the mildest to the strictest, stopping at
the first that fails, so they need no correction among themselves; strata and rules share
the error by Bonferroni (level = delta / (strata * rules)), and the rules of a stratum share
the allowed share (alpha = limit / rules). With probability 1 - delta no stratum loses more
than ``limit`` of its clean documents to the rules. A stratum with too few labels certifies
nothing and keeps what the base rules keep.

* null or empty text: no words, so the base rules reject it
* null stratum: a stratum of its own
* labels: a document counts once, as clean only if no label says otherwise; labels of unknown
  documents and null labels count for nothing
* repeated rows are judged alike; an empty table gives an empty result
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingline.llm.common import chunks_of, fresh, stored, text_bytes

#: Words of the windows that make a text repetitive.
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
LIMIT, DELTA = 0.02, 0.05


@dataclass(frozen=True)
class Rule:
    """Rejects a document whose 1000 * top / bottom is at or beyond a cutoff; cutoffs go
    from ``mildest`` in ``steps`` steps of ``step``, downwards if that is negative."""

    name: str
    top: str
    bottom: str
    mildest: int
    step: int
    steps: int

    def cutoffs(self) -> list[int]:
        return [self.mildest + i * self.step for i in range(self.steps)]

    @property
    def compare(self) -> str:
        return "<=" if self.step > 0 else ">="


RULES = (
    Rule("long_words", "word_chars", "n_words", 10000, -100, 46),
    Rule("short_words", "word_chars", "n_words", 2500, 100, 24),
    Rule("symbols", "n_symbols", "n_words", 3000, -50, 60),
    Rule("dup_lines", "n_dup_lines", "n_lines", 900, -50, 17),
    Rule("repeats", "n_repeat_words", "n_words", 200, -10, 19),
)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five that occur twice or more, the first occurrence included.
    Windows are compared exactly, by numbering pairs of numbered parts."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    two = _pairs(one[:-1], one[1:])
    four = _pairs(two[:-2], two[2:])
    five = _pairs(four[:-1], one[4:])
    often = np.bincount(five)[five] > 1
    if not often.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(often)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


#: Bytes that start no character of a word.
UNCOUNTED = b"\x20\x09\x0a\x0b\x0c\x0d" + bytes(range(0x80, 0xC0))


def counts_of(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(text.translate(None, UNCOUNTED)), len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines))


def with_counts(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` and the counts of its whole texts as one struct column."""
    at = docs.columns.index(text_col)
    kind = pa.struct([(c, pa.int64()) for c in COUNTS])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, 8 << 20, at):
            rows = [counts_of(x) for x in text_bytes(batch.column(at))]
            made = np.array(rows, np.int64).reshape(len(rows), len(COUNTS))
            new = pa.StructArray.from_arrays([pa.array(made[:, i]) for i in range(len(COUNTS))], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, new], [*batch.schema.names, name])

    fields = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    return docs.mapInArrow(count, T.StructType([*docs.schema.fields, T.StructField(name, fields)]))


BASE_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum and the counts of every whole text, with the base verdict."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"),
                       F.col(text_col).cast("string").alias("text"))
    return (with_counts(slim, "text", "of").select("doc_id", "stratum", "of.*")
            .withColumn("base_failed", F.expr(BASE_FAILED)))


def tail(n: int, k: int, share: float) -> float:
    """P(Bin(n, share) <= k), summed downwards from k until terms no longer matter."""
    if k >= n:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                    + k * math.log(share) + (n - k) * math.log1p(-share))
    total, i = 0.0, k
    while i >= 0 and term > total * 1e-17:
        total += term
        term *= i * (1 - share) / ((n - i + 1) * share)
        i -= 1
    return min(1.0, total)


def certified(counts: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT,
              delta: float = DELTA, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """stratum and, per rule, the strictest certified cutoff (null: none). Has a row for each
    stratum with labelled clean documents; its size doesn't depend on the documents."""
    clean = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("label")).where("label = 1").select("doc_id"))
    holdout = counts.join(clean, "doc_id", "left_semi").where("not base_failed")
    alpha = limit / len(rules)
    # the number of cutoffs that reject the document: always the strictest ones
    hit = []
    for i, r in enumerate(rules):
        value, strictest = F.expr(f"1000 * {r.top} / {r.bottom}"), F.lit(r.cutoffs()[-1])
        beyond = strictest - value if r.step > 0 else value - strictest
        n = F.least(F.greatest(F.floor(beyond / abs(r.step)) + 1, F.lit(0)), F.lit(r.steps))
        hit.append(F.struct(F.lit(i).alias("rule"), F.coalesce(n, F.lit(0)).cast("int").alias("hits")))
    seen = (holdout.select("stratum", F.explode(F.array(*hit)).alias("h")).select("stratum", "h.*")
            .groupBy("stratum", "rule", "hits").agg(F.count("*").alias("n")))
    # one entry for each number of hits, so a list is no longer than the rule has cutoffs
    histograms = stored(seen.groupBy("stratum", "rule").agg(F.collect_list(F.struct("hits", "n")).alias("seen")), "holdout")
    tests = max(1, histograms.select("stratum").distinct().count()) * len(rules)

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for stratum, rule, pairs in zip(b["stratum"], b["rule"], b["seen"]):
                of = np.zeros(rules[rule].steps + 1, np.int64)
                for x in pairs:
                    of[x["hits"]] += x["n"]
                n, rejected = int(of.sum()), np.cumsum(of[::-1])  # by the cutoffs, the mildest first
                best = None
                for cutoff, k in zip(rules[rule].cutoffs(), rejected.tolist()):
                    if k >= n * alpha or tail(n, k, alpha) > delta / tests:
                        break
                    best = cutoff
                rows.append((stratum, rules[rule].name, best))
            yield pd.DataFrame(rows, columns=["stratum", "rule", "cutoff"]).astype({"cutoff": "Int64"})

    chosen = histograms.mapInPandas(choose, "stratum string, rule string, cutoff long")
    return chosen.groupBy("stratum").agg(*(F.min(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(r.name) for r in rules))


def fired(rules: tuple[Rule, ...], counts: str, cutoffs: str) -> Column:
    """Names of the rules that reject a document with the counts below ``counts``."""
    tests = (F.expr(f"1000 * {counts}.{r.top} {r.compare} {cutoffs}.{r.name} * {counts}.{r.bottom}") for r in rules)
    return F.filter(F.array(*(F.when(t, F.lit(r.name)) for t, r in zip(tests, rules))), lambda x: x.isNotNull())


def judged(docs: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT,
           delta: float = DELTA, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
           label_col: str = "quality") -> DataFrame:
    """Every document with its counts, base_failed, the rules that reject it, and kept."""
    counts = stored(counted(docs, id_col, text_col, stratum_col), "quality-counts")
    cutoffs = stored(certified(counts, labels, rules, limit, delta, id_col, label_col), "quality-cutoffs")
    # Spark broadcasts the stored cutoffs if their measured size is small
    both = counts.alias("c").join(cutoffs.alias("t"), F.col("c.stratum").eqNullSafe(F.col("t.stratum")), "left")
    return both.select("c.*", F.when(F.col("base_failed"), F.array().cast("array<string>"))
                       .otherwise(fired(rules, "c", "t")).alias("rejected_by")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def keep_good(docs: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT,
              delta: float = DELTA, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
              label_col: str = "quality") -> DataFrame:
    """The documents that are kept, with the columns they came with. Texts are counted a
    second time where they are, rather than shuffled to their verdict."""
    slim = counted(docs, id_col, text_col, stratum_col)
    cutoffs = stored(certified(slim, labels, rules, limit, delta, id_col, label_col), "quality-cutoffs")
    mark = fresh("of")
    both = with_counts(docs, text_col, mark).join(
        cutoffs.select(F.struct(*cutoffs.columns).alias(mark + "t")),
        F.col(stratum_col).cast("string").eqNullSafe(F.col(mark + "t.stratum")), "left")
    base = F.expr(BASE_FAILED.replace("n_words", f"{mark}.n_words").replace("n_repeat_words", f"{mark}.n_repeat_words"))
    return both.where(~base & (F.size(fired(rules, mark, mark + "t")) == 0)).select(*docs.columns)
