"""Byte-level BPE encoding and decoding without regular expressions.

Texts become arrays of code points, code points become classes. A small automaton reads the
classes; its state says what the piece being read is, and a table says for state and class
whether a new piece begins. Transition functions compose associatively, so the automaton runs
over blocks at once: each block's function maps every state to the state after it, the
functions are scanned, then each block runs from its own first state. What needs a look ahead
(the last white space of a run, a contraction's second letter) is part of the class, since
classes of neighbours are there too.

Pieces are byte slices. A worker remembers the ids of pieces it has met; the others are merged,
the lowest rank first, long ones with a heap. Decoding reads the ids' bytes back; piece offsets are kept for callers.

* null or empty text: no ids, no bytes
* very long texts are encoded whole; repeated rows are encoded alike
* an empty table gives an empty result; other columns stay as they are
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pingline.llm.common import chunks_of, text_bytes

# classes of code points
LETTER, NUMBER, SPACE, WHITE, OTHER, QUOTE, ONE, RVL, E = range(9)
#: White space, and the letters that contractions end in.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDS_ONE = "stmd"  # and re, ve, ll
# classes after the look at neighbours
C_LETTER, C_NUMBER, C_SPACE_LAST, C_WHITE_LAST, C_WHITE, C_OTHER, C_QUOTE, C_ONE, C_TWO, C_RESET = range(10)
# states: nothing open, one space open, white space, letters, numbers, others, an apostrophe
# that began its piece, a contraction's first of two letters, and a finished piece
S_NONE, S_SPACE, S_WHITE, S_LETTER, S_NUMBER, S_OTHER, S_QUOTE, S_TWO = range(8)

#: Pieces of a worker's memory's newer half, and the longest it remembers and merges by list.
REMEMBER, LONGEST = 600_000, 48
NO_PAIR = 1 << 40
#: Steps of a block when the automaton runs over blocks.
STEPS = 256


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a piece begins, for (state, class)."""
    after = np.zeros((8, 10), np.uint8)
    begins = np.ones((8, 10), bool)
    run = {C_LETTER: S_LETTER, C_ONE: S_LETTER, C_TWO: S_LETTER, C_NUMBER: S_NUMBER, C_OTHER: S_OTHER, C_QUOTE: S_OTHER}
    for state in range(8):
        for c, to in run.items():
            after[state, c] = to
            begins[state, c] = state not in (to, S_SPACE)
        # an apostrophe that goes on with nothing starts a piece of its own, maybe a contraction
        if state not in (S_SPACE, S_OTHER, S_QUOTE):
            after[state, C_QUOTE] = S_QUOTE
        after[state, C_SPACE_LAST], after[state, C_WHITE_LAST], after[state, C_WHITE] = S_SPACE, S_NONE, S_WHITE
        begins[state, C_WHITE] = state != S_WHITE
        after[state, C_RESET] = S_NONE
    begins[S_QUOTE, [C_OTHER, C_QUOTE]] = False
    after[S_QUOTE, C_ONE], begins[S_QUOTE, C_ONE] = S_NONE, False
    after[S_QUOTE, C_TWO], begins[S_QUOTE, C_TWO] = S_TWO, False
    for c in (C_LETTER, C_ONE, C_TWO):  # the second letter ends the contraction
        after[S_TWO, c], begins[S_TWO, c] = S_NONE, False
    return after, begins


def point_classes() -> np.ndarray:
    """Class of every code point, by the Unicode version of the library to agree with: it is
    asked once which code points are letters and which are numbers."""
    import tiktoken

    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    text, single = "".join(map(chr, points)), {bytes([i]): i for i in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for name, kind in (("L", LETTER), ("N", NUMBER)):
        asked = tiktoken.Encoding(name, pat_str=rf"\p{{{name}}}", mergeable_ranks=single, special_tokens={})
        out[np.frombuffer(asked.decode(asked.encode_ordinary(text)).encode("utf-32-le"), np.uint32)] = kind
    out[WHITE_SPACE] = WHITE
    out[0x20], out[ord("'")] = SPACE, QUOTE
    out[[ord(c) for c in ENDS_ONE]] = ONE
    out[[ord(c) for c in "rvl"]], out[ord("e")] = RVL, E
    return out


def neighbour_classes(points: np.ndarray, kinds: np.ndarray, reset: np.ndarray) -> np.ndarray:
    """Classes with what the next code point decides; ``reset`` marks text starts' separators."""
    c = kinds[points]
    table = np.array([C_LETTER, C_NUMBER, C_WHITE, C_WHITE, C_OTHER, C_QUOTE, C_ONE, C_LETTER, C_LETTER], np.uint8)
    out = np.frombuffer(bytearray(c.tobytes().translate(table.tobytes().ljust(256, b"\0"))), np.uint8)
    white = (c == SPACE) | (c == WHITE)
    following = np.append(~white[1:] & ~reset[1:], False)  # something that is no white space follows
    out[(c == SPACE) & following] = C_SPACE_LAST
    out[(c == WHITE) & following] = C_WHITE_LAST
    second = np.append(points[1:], 0)
    out[(c == RVL) & (second == np.where(points == ord("l"), ord("l"), ord("e")))] = C_TWO
    out[reset] = C_RESET
    return out


def scan(classes: np.ndarray, after: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """State before each class, starting with nothing open."""
    n, states = len(classes), len(after)
    blocks = -(-n // steps)
    if blocks <= 1:
        out, state = np.zeros(n, np.uint8), 0
        for i, c in enumerate(classes.tolist()):
            out[i] = state
            state = int(after[state, c])
        return out
    grid = np.full(blocks * steps, C_RESET, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(blocks, steps).T)
    # every block as a function: the state after it for each state before it
    width, table = after.shape[1], after.tobytes().ljust(256, b"\0")

    def move(state: np.ndarray, row: np.ndarray) -> np.ndarray:
        # bytes.translate looks all states up at once
        return np.frombuffer((state * np.uint8(width) + row).tobytes().translate(table), np.uint8).reshape(state.shape)

    function = np.tile(np.arange(states, dtype=np.uint8)[:, None], (1, blocks))
    for row in grid:
        function = move(function, row)
    out = np.zeros((steps, blocks), np.uint8)
    state = _scan_functions(np.ascontiguousarray(function.T))
    for i, row in enumerate(grid):
        out[i] = state
        state = move(state, row)
    return out.T.ravel()[:n]


def _scan_functions(function: np.ndarray) -> np.ndarray:
    """State before each block, by composing neighbours until one function is left."""
    size = len(function)
    if size == 1:
        return np.zeros(1, np.uint8)
    even, odd = function[0:size - size % 2:2], function[1::2]
    pairs = np.take_along_axis(odd, even.astype(np.intp), axis=1)
    if size % 2:
        pairs = np.concatenate([pairs, function[-1:]])
    before = _scan_functions(pairs)
    out = np.empty(size, np.uint8)
    out[0::2] = before
    out[1::2] = function[0:size - size % 2:2][np.arange(size // 2), before[: size // 2]]
    return out


def boundaries(texts: list[str], kinds: np.ndarray) -> list[np.ndarray]:
    """Byte offsets of the pieces of each text: where each begins, then the end."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    breaks = np.cumsum(sizes + 1) - 1
    reset = np.zeros(len(points), bool)
    reset[breaks] = True
    classes = neighbour_classes(points, kinds, reset)
    after, begins = automaton()
    place = scan(classes, after) * np.uint8(begins.shape[1]) + classes
    begin = np.frombuffer(place.tobytes().translate(begins.tobytes().ljust(256, b"\0")), bool)
    wide = 1 + (points > 0x7F).astype(np.uint8) + (points > 0x7FF) + (points > 0xFFFF)
    at = np.concatenate([[0], np.cumsum(wide, dtype=np.int64)])
    where = np.flatnonzero(begin)  # the separators begin pieces too: each text's end
    place = at[where]
    split = np.searchsorted(where, breaks)
    out, low = [], 0
    for high, stop in zip(split.tolist(), breaks.tolist()):
        base = at[stop - sizes[len(out)]]
        out.append(place[low:high + 1] - base)
        low = high + 1
    return out


class Known(dict):
    """Ids of pieces met so far, in two generations: when the newer one is full, the older is
    forgotten, and what is met again moves to the newer."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece) or self.make(piece)
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids

    def turn(self) -> None:
        if len(self) > REMEMBER:
            self.older = dict(self)
            self.clear()


class Coder:
    """Ranks of one vocabulary, with what the worker has met so far."""

    loaded: dict[str, Coder] = {}

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.kinds = point_classes()
        self.known = Known(self.ids_of)
        self.first = [self.ranks[bytes([b])] for b in range(256)]
        # every way to put a token together from two
        self.pairs = {(self.ranks[t[:i]], self.ranks[t[i:]]): r for t, r in self.ranks.items()
                      for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks}

    @classmethod
    def of(cls, path: str) -> Coder:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def ids_of(self, piece: bytes) -> bytes:
        """A piece that is a token is that token; others are merged."""
        rank = self.ranks.get(piece)
        if rank is not None:
            return rank.to_bytes(4, "little")
        return self.merge(piece) if len(piece) <= LONGEST else self.merge_long(piece)

    def merge(self, piece: bytes) -> bytes:
        """Ids of a short piece: the lowest pair first, the leftmost of equals."""
        get, first = self.pairs.get, self.first
        ids = [first[b] for b in piece]
        ranks = [get(p, NO_PAIR) for p in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == NO_PAIR:
                break
            i = ranks.index(low)
            ids[i] = low
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], low), NO_PAIR)
            if i < len(ranks):
                ranks[i] = get((low, ids[i + 1]), NO_PAIR)
        return struct.pack(f"<{len(ids)}I", *ids)

    def merge_long(self, piece: bytes) -> bytes:
        """Ids of a long piece, by a heap of pairs over a linked list."""
        ids = [self.ranks[piece[i:i + 1]] for i in range(len(piece))]
        token = [piece[i:i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, bytes, bytes]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids):
                rank = self.ranks.get(token[i] + token[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, token[i], token[j]))

        for i in range(len(ids)):
            offer(i)
        gone = [False] * len(ids)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= len(ids) or token[i] != left or token[j] != right:
                continue
            ids[i], token[i], gone[j] = rank, left + right, True
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([x for x, g in zip(ids, gone) if not g], "<u4").tobytes()

    def encode(self, texts: list[bytes]) -> tuple[list[bytes], list[np.ndarray]]:
        """Ids of each text as little-endian unsigned 32-bit numbers, and its pieces' offsets."""
        offsets = boundaries([t.decode("utf-8", "replace") for t in texts], self.kinds)
        out = []
        for text, at in zip(texts, offsets):
            self.known.turn()
            at = at.tolist()
            out.append(b"".join(map(self.known.__getitem__, [text[a:b] for a, b in zip(at, at[1:])])))
        return out, offsets

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoded(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids",
            offsets_col: str | None = None) -> DataFrame:
    """``docs`` without its text, with the ids as little-endian unsigned 32-bit numbers, and
    the byte offsets of the pieces if asked for. A column named as the ids or the offsets is
    replaced. ``vocabulary`` is a rank file that every executor has."""
    at = docs.columns.index(text_col)
    keep = [i for i, name in enumerate(docs.columns) if i != at and name not in (ids_col, offsets_col)]
    fields = [*(docs.schema.fields[i] for i in keep), T.StructField(ids_col, T.BinaryType())]
    if offsets_col:
        fields.append(T.StructField(offsets_col, T.ArrayType(T.LongType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, 2 << 20, at):
            ids, offsets = Coder.of(vocabulary).encode(text_bytes(batch.column(at)))
            new = [pa.array(ids, pa.binary())]
            if offsets_col:
                new.append(pa.array([x.tolist() for x in offsets], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *new], [f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(fields))


def decoded(docs: DataFrame, vocabulary: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``docs`` with the bytes its ids stand for; a column named as those is replaced."""
    docs = docs.select(*(c for c in docs.columns if c != bytes_col))
    at = docs.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, 4 << 20, at):
            coder = Coder.of(vocabulary)
            made = [coder.decode(x or b"") for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*batch.schema.names, bytes_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(bytes_col, T.BinaryType())]))
