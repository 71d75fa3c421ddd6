"""Removal of byte strings that an earlier document also holds, by prefix-free parsing.

A rolling hash marks triggers: in every window of ``LENGTH`` bytes the ``GRAM``-byte string
with the smallest hash. Which one it is depends on the window alone, so equal windows have
their trigger at the same place. Consecutive windows with one trigger form a phrase, and
neighbouring phrases overlap, so each window lies in exactly one phrase.

1. Parse: each document becomes phrases (trigger key, content hash, place). Copies inside one
   batch of documents are settled at once; only the earliest goes on, so a passage that a
   third of all documents share is a few rows per batch.
2. Dictionary: phrases meet by trigger key. Of equal phrases all but the earliest document's
   are repeated. A key with different phrases may still hide equal windows, at the borders of
   longer matches; those phrases of the dictionary go on.
3. Suffixes: these phrases are sorted, with every window as a suffix cut at ``LENGTH`` bytes,
   in corpus order, those around one 35-byte context of the trigger together. Neighbours of
   equal content are one string; it is repeated in all but its earliest document.
4. The repeated windows' bytes are removed from the texts.

Contents are compared by a 48-bit hash under a 46-bit key in step 2, byte by byte in step 3.

* null or empty text: nothing to remove
* null id: orders after every other id; rows with the same id are never earlier than one
  another, and are told apart by their text
* an empty table gives an empty result
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingline.llm.common import LAST_ID, chunks_of, fresh, stored, text_bytes

LENGTH, GRAM = 50, 20
SPAN = LENGTH - GRAM + 1
#: Bytes parsed in one array, and bytes whose phrases are combined before the shuffle.
BLOCK, BATCH = 1 << 18, 4 << 20
#: Windows sorted at a time, if no single context holds more.
SORTED = 1 << 17
#: Buckets per shuffle partition, so that hashing them spreads evenly.
BUCKETS = 4
#: The trigger lies up to here behind a window's start: windows to the right are compared by
#: what follows the trigger, the others by what surrounds it.
NEAR = 15

_U = np.uint64
_BASE = 0xD6E8FEB86659FD93
_BYTES = np.random.RandomState(7).randint(0, 1 << 62, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_PLACE = (1 << 22) - 1


def _powers(base: int) -> np.ndarray:
    out = np.full(2 * BLOCK + LENGTH, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Hashes of byte strings inside one array, from running sums of powers."""

    up: np.ndarray | None = None
    down: np.ndarray | None = None

    def __init__(self, data: np.ndarray):
        if Hashes.up is None or Hashes.down is None:
            Hashes.up, Hashes.down = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
        n = len(data)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(_BYTES[data] * Hashes.up[:n], out=self.sums[1:])

    def rolling(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * Hashes.down[:n])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * Hashes.down[start])


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(32))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(29)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(32)
    return h


def parse(blocks: list[bytes]) -> tuple[np.ndarray, ...]:
    """Phrases of the blocks: block, first window, number of windows, distance from the first
    window to the trigger, trigger key, content hash."""
    data = np.frombuffer(b"".join(blocks), np.uint8)
    sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.astype(_U), none.astype(_U)
    hashes = Hashes(data)
    keys = hashes.rolling(GRAM)
    # the hash orders, the place breaks ties: the first of equal strings
    low = (keys & _U(~_PLACE & (1 << 64) - 1)) | np.arange(len(keys), dtype=_U)
    width = 1
    while width * 2 <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < SPAN:
        low = np.minimum(low[: len(low) - (SPAN - width)], low[SPAN - width:])
    trigger = (low & _U(_PLACE)).astype(np.int64)
    ends = np.cumsum(sizes)
    block = np.repeat(np.arange(len(blocks)), sizes)[: len(trigger)]
    window = np.flatnonzero(np.arange(len(trigger)) + LENGTH <= ends[block])
    if not len(window):
        return none, none, none, none, none.astype(_U), none.astype(_U)
    trigger, block = trigger[window], block[window]
    first = np.flatnonzero(np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (block[1:] != block[:-1])]))
    count = np.diff(np.concatenate([first, [len(window)]]))
    start, trigger, block = window[first], trigger[first], block[first]
    return (block, start - (ends - sizes)[block], count, trigger - start, keys[trigger],
            hashes.at(start, start + count + LENGTH - 1))


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns of numbers as one compressed string; small differences compress well."""
    head = np.array([len(columns[0])], "<i8").tobytes()
    return zstandard.compress(head + b"".join(np.ascontiguousarray(c).tobytes() for c in columns), 1)


def _unpacked(data: bytes, types: list[str]) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    n, at, out = int(np.frombuffer(raw, "<i8", 1)[0]), 8, []
    for t in types:
        out.append(np.frombuffer(raw, t, n, at))
        at += out[-1].nbytes
    return out


#: key: 5 bytes and 6 bytes of hash as bytes, so that columns stay short
_PARSED = ["<i8", "<u4", "<u4", "u1", "u1", "V5", "V6"]


def _short(values: np.ndarray, size: int) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).view(f"V{size}").ravel()


def _long(values: np.ndarray) -> np.ndarray:
    size = values.dtype.itemsize
    out = np.zeros((len(values), 8), np.uint8)
    out[:, :size] = np.ascontiguousarray(values).view(np.uint8).reshape(-1, size)
    return out.view("<u8").ravel()


def _spread(values: np.ndarray, buckets: int) -> np.ndarray:
    return (values >> _U(40)) % _U(buckets)


def _runs(changed: np.ndarray) -> np.ndarray:
    """Starts of runs, given where a value differs from the one before."""
    return np.flatnonzero(np.concatenate([[True], changed]))


def _slices(order: np.ndarray, buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Bucket and its members, for ``order`` sorted by bucket."""
    if len(order):
        at = _runs(np.diff(buckets[order]) != 0)
        for a, b in zip(at, [*at[1:], len(order)]):
            yield int(buckets[order[a]]), order[a:b]


def parser(buckets: int):
    """Batches (id, tag, text) to blobs of phrases per bucket; kind 0: phrases,
    kind 1: repeated stretches (doc, tag, start, windows)."""

    def emit(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        doc, tag, start, count, reach, key, content = (np.concatenate(x) for x in zip(*held))
        if not len(doc):
            return
        order = np.lexsort((doc, content))
        begins = _runs(content[order][1:] != content[order][:-1])
        earliest = np.repeat(doc[order][begins], np.diff(np.concatenate([begins, [len(order)]])))
        copy = np.zeros(len(doc), bool)
        copy[order] = doc[order] > earliest
        kinds, names, blobs = [], [], []
        bucket = _spread(key, buckets).astype(np.int64)
        on = np.flatnonzero(~copy)
        on = on[np.argsort(bucket[on], kind="stable")]
        for name, of in _slices(on, bucket):
            kinds.append(0)
            names.append(name)
            blobs.append(_packed([doc[of], tag[of], start[of], count[of], reach[of], _short(key[of], 5), _short(content[of], 6)]))
        gone = np.flatnonzero(copy)
        gone = gone[np.lexsort((start[gone], tag[gone], doc[gone]))]
        if len(gone):
            d, t, s, e = merged(doc[gone], tag[gone], start[gone].astype(np.int64), start[gone].astype(np.int64) + count[gone] + LENGTH - 1)
            lot = (mixed(d.astype(_U) + t.astype(_U)) % _U(buckets)).astype(np.int64)
            for name, of in _slices(np.argsort(lot, kind="stable"), lot):
                kinds.append(1)
                names.append(name)
                blobs.append(_packed([d[of], t[of], s[of], e[of]]))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())],
                                         ["bucket", "kind", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def take(part: list[tuple[int, int, int, bytes]]) -> None:
            block, start, count, reach, key, content = parse([x[3] for x in part])
            base = [np.array([x[i] for x in part], t) for i, t in ((0, "<i8"), (1, "<u4"), (2, "<i8"))]
            held.append((base[0][block], base[1][block], (base[2][block] + start).astype("<u4"), count.astype("u1"),
                         reach.astype("u1"), key, content))

        for batch in chunks_of(batches, 1 << 20, 2):
            part: list[tuple[int, int, int, bytes]] = []
            filled = 0
            for doc, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))):
                for at in range(0, max(1, len(text) - LENGTH + 1), BLOCK - LENGTH):
                    # each block holds the windows that start in its stretch
                    piece = text[at:at + BLOCK - 1]
                    if filled + len(piece) > 2 * BLOCK - 1 and part:
                        take(part)
                        part, filled = [], 0
                    part.append((doc, tag, at, piece))
                    filled += len(piece)
                    size += len(piece)
            if part:
                take(part)
            if size > BATCH:
                yield from emit(held)
                held, size = [], 0
        if held:
            yield from emit(held)

    return run


def merged(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches sorted by document and start, those that touch as one."""
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > end[:-1])])
    at = np.flatnonzero(new)
    return doc[at], tag[at], start[at].astype("<i8"), np.maximum.reduceat(end, at).astype("<i8")


_FOUND = "doc long, tag long, start long, end long, reach int, settled boolean"


def _found(doc, tag, start, end, reach=None) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc.astype(np.int64)), pa.array(tag.astype(np.int64)), pa.array(start.astype(np.int64)),
         pa.array(end.astype(np.int64)), pa.array(np.zeros(n, np.int32) if reach is None else reach.astype(np.int32)),
         pa.array(np.full(n, reach is None))],
        ["doc", "tag", "start", "end", "reach", "settled"])


def _by_bucket(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[tuple]]:
    """Rows of one bucket after the other; the partition is sorted by bucket."""
    now, rows = None, []
    for batch in batches:
        for name, *row in zip(batch.column(0).to_pylist(), *(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)):
            if name != now:
                if rows:
                    yield rows
                now, rows = name, []
            rows.append(tuple(row))
    if rows:
        yield rows


def dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settled stretches, and phrases whose windows must be compared."""
    for rows in _by_bucket(batches, ("kind", "blob")):
        settled = [_unpacked(b, ["<i8", "<u4", "<i8", "<i8"]) for k, b in rows if k == 1]
        if settled:
            yield _found(*(np.concatenate(x) for x in zip(*settled)))
        phrases = [_unpacked(b, _PARSED) for k, b in rows if k == 0]
        if not phrases:
            continue
        doc, tag, start, count, reach, key, content = (np.concatenate(x) for x in zip(*phrases))
        key, content = _long(key), _long(content)
        order = np.lexsort((doc, content, key))
        doc, tag, start, count, reach, key, content = (x[order] for x in (doc, tag, start.astype(np.int64), count, reach, key, content))
        of_key = _runs(key[1:] != key[:-1])
        of_phrase = _runs((key[1:] != key[:-1]) | (content[1:] != content[:-1]))
        per = np.diff(np.concatenate([of_phrase, [len(doc)]]))
        earliest = np.repeat(doc[of_phrase], per)
        copy = doc > earliest
        if copy.any():
            at = np.flatnonzero(copy)
            yield _found(doc[at], tag[at], start[at], start[at] + count[at] + LENGTH - 1)
        # a key goes on if it has several phrases, of several documents
        key_of_phrase = np.searchsorted(of_key, of_phrase, "right") - 1
        phrases_of = np.bincount(key_of_phrase, minlength=len(of_key))
        low = np.minimum.reduceat(doc, of_key)
        high = np.maximum.reduceat(earliest, of_key)
        on = (phrases_of > 1) & (high > low)
        size = np.diff(np.concatenate([of_key, [len(doc)]]))
        at = np.flatnonzero(np.repeat(on, size) & ~copy)
        if len(at):
            yield _found(doc[at], tag[at], start[at], start[at] + count[at], reach[at])


def contexts(buckets: int, at: int):
    """Documents with the phrases to compare (doc, tag, text, phrases, from column ``at`` on) to
    blobs of phrase bytes per bucket. Windows that
    start at most ``NEAR`` before the trigger hold the 35 bytes from it; the others hold the
    36 around it. What they hold decides the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, 1 << 20, at + 2):
            routes, places, texts = [], [], []
            for doc, tag, packed, phrases in zip(*(batch.column(at + i).to_pylist() for i in range(4))):
                text = zstandard.decompress(packed)
                for p in phrases:
                    first, trigger = p >> 16, (p >> 16) + (p & 255)
                    end = first + (p >> 8 & 255)
                    middle = min(max(first, trigger - NEAR), end)
                    for a, b, x, y in ((first, middle, trigger - NEAR - 1, trigger + GRAM),
                                       (middle, end, trigger, trigger + LENGTH - NEAR)):
                        if a < b:
                            routes.append(xxhash.xxh3_64_intdigest(text[x:y]))
                            places.append((doc, tag, a, b - a))
                            texts.append(text[a:b + LENGTH - 1])
            if not routes:
                continue
            route = np.array(routes, "<u8")
            bucket = _spread(route, buckets).astype(np.int64)
            place = np.array(places, np.int64)
            names, blobs = [], []
            for name, of in _slices(np.argsort(bucket, kind="stable"), bucket):
                names.append(name)
                body = b"".join(texts[i] for i in of.tolist())
                head = _packed([route[of], *(np.ascontiguousarray(place[of, i]) for i in range(4))])
                blobs.append(len(head).to_bytes(8, "little") + head + zstandard.compress(body, 1))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    return run


def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of windows that an earlier document holds too, from the sorted windows."""
    for rows in _by_bucket(batches, ("blob",)):
        heads, bodies = [], []
        for (blob,) in rows:
            n = int.from_bytes(blob[:8], "little")
            heads.append(_unpacked(blob[8:8 + n], ["<u8", "<i8", "<i8", "<i8", "<i8"]))
            bodies.append(zstandard.decompress(blob[8 + n:]))
        route, doc, tag, start, count = (np.concatenate(x) for x in zip(*heads))
        body = np.frombuffer(b"".join(bodies) + bytes(8), np.uint8)
        size = count + LENGTH - 1
        base = np.cumsum(size) - size
        # a context that only one document holds repeats nothing
        order = np.lexsort((doc, route))
        at = _runs(route[order][1:] != route[order][:-1])
        per = np.diff(np.concatenate([at, [len(order)]]))
        several = doc[order][at] != doc[order][at + per - 1]
        order = order[np.repeat(several, per)]
        at, per = np.cumsum(per[several]) - per[several], per[several]
        if not len(order):
            continue
        # contexts together, about SORTED windows at a time
        total = np.cumsum(np.add.reduceat(count[order], at))
        cut = np.unique(np.searchsorted(total, np.arange(SORTED, total[-1] + SORTED, SORTED), "left") + 1)
        low = 0
        for high in np.minimum(cut, len(at)).tolist():
            if high > low:
                of = order[at[low]:at[high - 1] + per[high - 1]]
                yield from _sorted(body, base[of], count[of], doc[of], tag[of], start[of])
            low = high


def _sorted(body, base, count, doc, tag, start) -> Iterator[pa.RecordBatch]:
    phrase = np.repeat(np.arange(len(base)), count)
    inside = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count)
    at = base[phrase] + inside
    words = np.ndarray((len(body) - 7,), ">u8", body, strides=(1,))  # eight bytes from every place
    parts = [words[at + k].astype("<u8") for k in (*range(0, LENGTH - 8, 8), LENGTH - 8)]
    order = np.lexsort((doc[phrase], *reversed(parts)))
    differ = np.zeros(len(order) - 1, bool)
    for p in parts:
        q = p[order]
        differ |= q[1:] != q[:-1]
    begins = _runs(differ)
    per = np.diff(np.concatenate([begins, [len(order)]]))
    repeated = np.zeros(len(order), bool)
    d = doc[phrase][order]
    repeated[order] = d > np.repeat(d[begins], per)
    hit = np.flatnonzero(repeated)
    if len(hit):
        p = phrase[hit]
        s = start[p] + inside[hit]
        o = np.lexsort((s, tag[p], doc[p]))
        yield _found(*merged(doc[p][o], tag[p][o], s[o], s[o] + LENGTH))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(1)
    for batch in batches:
        texts = [pack.compress(x) if x else b"" for x in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())], batch.schema.names)


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, tag and text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(order(id_col).alias("doc"), F.crc32(text).alias("tag"), text.alias("packed"))


def order(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))


def _texts(docs: DataFrame, id_col: str, text_col: str, others: list[str], doc: str, tag: str, packed: str) -> DataFrame:
    """``others``, then doc, tag and the compressed text: a third of its size crosses the network."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*others, order(id_col).alias(doc), F.crc32(text).alias(tag), text.alias(packed))
    # never null, so that an inner and a left join shuffle the very same rows, and do it once
    small = T.StructType([*rows.schema.fields[:-3], T.StructField(doc, T.LongType(), False), T.StructField(tag, T.LongType(), False),
                          T.StructField(packed, T.BinaryType())])
    return rows.mapInArrow(_compressed, small)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: DataFrame | None = None) -> DataFrame:
    """doc, tag (the text's CRC) and spans: start * 2^32 + end of stretches to remove. ``texts``
    is what ``_texts`` makes of ``docs``, for callers that join it again."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS * parts
    phrases = _slim(docs, id_col, text_col).mapInArrow(parser(buckets), "bucket int, kind int, blob binary")
    found = stored(phrases.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(dictionary, _FOUND), "phrases")
    # a document's phrases and stretches are no longer than the document
    # and one number each: start, number of windows, distance to the trigger
    phrase = F.shiftleft("start", 16) + F.shiftleft(F.col("end") - F.col("start"), 8) + F.col("reach")
    open_ = found.where("NOT settled").groupBy("doc", "tag").agg(F.collect_list(phrase).alias("phrases"))
    if texts is None:
        texts = _texts(docs, id_col, text_col, [], "doc", "tag", "packed")
    doc, tag, _ = texts.columns[-3:]
    # all columns of texts are asked for, so that this join reads the same shuffle as the caller's
    both = texts.join(open_.withColumnsRenamed({"doc": doc, "tag": tag}), [doc, tag]).select(*texts.columns, "phrases")
    blobs = both.mapInArrow(contexts(buckets, len(texts.columns) - 3), "bucket int, blob binary")
    more = blobs.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(suffixes, _FOUND)
    spans = found.where("settled").select("doc", "tag", "start", "end").union(more.select("doc", "tag", "start", "end"))
    return spans.groupBy("doc", "tag").agg(F.collect_list(F.shiftleft("start", 32) + F.col("end")).alias("spans"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", characters: bool = False) -> DataFrame:
    """Every document with its other columns, and in place of its text one struct column
    ``found`` of n_bytes, n_removed, n_spans, kept (the bytes that stay; with ``characters``
    without those of a character that a removal cuts in two)."""
    doc, tag, packed, spans = (fresh(x) for x in ("doc", "tag", "packed", "spans"))
    others = [c for c in docs.columns if c not in (text_col, "found")]
    rows = _texts(docs, id_col, text_col, others, doc, tag, packed)
    gone = repeats(docs, id_col, text_col, rows).withColumnsRenamed({"doc": doc, "tag": tag, "spans": spans})
    both = rows.join(gone, [doc, tag], "left").select(*others, packed, spans)
    made = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    at = len(others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, 2 << 20, at):
            found = []
            for t, s in zip(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist()):
                *counts, parts = cut(zstandard.decompress(t) if t else b"", s or [])
                if characters:
                    parts = [p.decode("utf-8", "ignore").encode() for p in parts]
                found.append((*counts, b"".join(parts)))
            new = pa.StructArray.from_arrays([pa.array([r[i] for r in found], f.type) for i, f in enumerate(made)], fields=list(made))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], new], [*others, "found"])

    out = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])
    return both.mapInArrow(run, T.StructType([*both.schema.fields[:at], T.StructField("found", out)]))


def cut(text: bytes, spans: list[int]) -> tuple[int, int, int, list[bytes]]:
    """Bytes in all, bytes removed, maximal removed stretches, and the parts that stay."""
    kept, at, removed, count, last = [], 0, 0, 0, -1
    for a, b in (divmod(s, 1 << 32) for s in sorted(spans)):
        count += a > last
        last = max(last, b)
        if a > at:
            kept.append(text[at:a])
        removed += max(0, b - max(a, at))
        at = max(at, b)
    return len(text), removed, count, [*kept, text[at:]]


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with what is left of their texts and the columns they came with; those
    of which no word is left go."""
    renamed = docs.withColumnRenamed("found", "_found") if "found" in docs.columns and text_col != "found" else docs
    left = without_repeats(renamed, id_col, text_col, characters=True)
    text = F.col("found.kept").cast("string").alias(text_col)
    back = [text if c == text_col else F.col("_found").alias(c) if c == "found" else F.col(c) for c in docs.columns]
    return left.select(*back).where(F.col(text_col).rlike("[^\\x20\\x09-\\x0D]"))
