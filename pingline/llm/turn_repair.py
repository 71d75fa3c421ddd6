"""Cheapest repair of damaged conversations, by iterative-deepening A*.

A conversation is well formed if the initials of its roles are nothing, or an optional system
turn and then one or more pairs of user and assistant. Each row is kept (K, free), given the
role its place needs (R, 1) or deleted (D, 2); an empty turn may be inserted anywhere (I, 5).
Blank rows and repeats must be deleted; a truncated row that stays adds 5.

The search is depth first, edits in ASCII order, under a bound on the cost that rises to the
least cost not yet refuted. Every state (row, place in the pattern) that failed is remembered
with the cost it is known to need, and is entered again only with more left than that. The
first path that arrives is the cheapest, and of the cheapest the ASCII-least.

Rows are range-partitioned by conversation and turn, so a conversation of any length lies
spread over tasks. A conversation inside one partition is repaired there. Those at its borders
leave pieces of at most ``LONG`` rows: the cheapest path from every place of the pattern to
every other, found by the same search. The pieces of one conversation are then joined in
order, with a path, a cost and a running digest per place. Two paths of one cost that end at
one place are never prefixes of each other, so the lesser of them stays the lesser.

* null role or text: one space; an empty role has a space for its initial
* null turn: before all others; null conversation id: one conversation of its own
* rows of equal turn: ordered by role, then by the digest of role and text
* repeated rows: all but the first are duplicates
* an empty table gives an empty result; other columns are ignored
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pingline.llm.common import order_key, stored

#: Cost of each edit, and of a truncated row that stays.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Faults, in the order in which they count.
BLANK, DUPLICATE, CUT = 1, 2, 3
#: Rows and text bytes a piece holds.
LONG, HEAVY = 64, 1 << 20
#: Places in the pattern: nothing yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = frozenset((START, ASSISTANT))
#: The role each place asks for next, and where it leads.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
LEGAL = ("su", "ua", "au")
_WHITE = " \t\n\x0b\x0c\r"


class Row(NamedTuple):
    initial: str
    fault: int
    turn: int | None
    role: str
    text: str


def _kept(place: int, initial: str) -> int | None:
    """Where keeping a row of this initial leads."""
    if place == START and initial == "s":
        return SYSTEM
    role, after = NEXT[place]
    return after if initial == role[0] else None


def cheapest(rows: list[Row], entry: int = START, goals: frozenset[int] = ENDS) -> tuple[int, str] | None:
    """Cost and edits of the cheapest repair that leads from ``entry`` to a goal, the
    ASCII-least of them; None if there is none."""
    n = len(rows)
    rest = [0] * (n + 1)  # no fault is cheaper than a deletion, no clean row than nothing
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + (DELETE if rows[i].fault else 0)
    if not _reachable(rows, entry, goals):
        return None
    needed: dict[tuple[int, int], int] = {}  # failed states, and what they are known to need
    path: list[str] = []

    def steps(i: int, place: int) -> Iterator[tuple[str, int, int, int]]:
        after = NEXT[place][1]
        if i < n:
            yield "D", DELETE, i + 1, place
        yield "I", INSERT, i, after
        if i < n and rows[i].fault not in (BLANK, DUPLICATE):
            extra, to = TRUNCATED if rows[i].fault == CUT else 0, _kept(place, rows[i].initial)
            if to is not None:
                yield "K", extra, i + 1, to
            yield "R", RELABEL + extra, i + 1, after

    def descend(i: int, place: int, left: int) -> bool:
        if i == n and place in goals:
            return True
        least = None
        for edit, cost, j, after in steps(i, place):
            need = needed.get((j, after), rest[j])
            if need <= left - cost:
                path.append(edit)
                if descend(j, after, left - cost):
                    return True
                path.pop()
                need = needed[j, after]
            least = cost + need if least is None else min(least, cost + need)
        needed[i, place] = max(least, left + 1)
        return False

    bound = rest[0]
    while not descend(0, entry, bound):
        bound = needed[0, entry]
    return bound, "".join(path)


def _reachable(rows: list[Row], entry: int, goals: frozenset[int]) -> bool:
    """Insertions lead to the places of user and assistant from anywhere, nothing back."""
    if goals & {USER, ASSISTANT} or entry in goals:
        return True
    return SYSTEM in goals and entry == START and any(r.initial == "s" and r.fault not in (BLANK, DUPLICATE) for r in rows)


def replayed(rows: list[Row], edits: str, entry: int = START) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired turns."""
    place, at = entry, iter(rows)
    for edit in edits:
        row = next(at) if edit != "I" else None
        if edit == "D":
            continue
        if edit == "K":
            place = _kept(place, row.initial)
            yield row.role, row.text
        else:
            role, place = NEXT[place]
            yield role, row.text if row else ""


@dataclass
class Facts:
    """Counts over consecutive rows of a conversation, in turn order."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: str = ""
    last: str = ""

    @classmethod
    def of(cls, rows: list[Row]) -> Facts:
        out = cls(*(sum(r.fault == f for r in rows) for f in (BLANK, DUPLICATE, CUT)))
        out.illegal = sum(a.initial + b.initial not in LEGAL for a, b in zip(rows, rows[1:]))
        numbers = [r.turn for r in rows if r.turn is not None]
        if numbers:
            out.turns, out.low, out.high = len(set(numbers)), numbers[0], numbers[-1]
        out.first, out.last = rows[0].initial, rows[-1].initial
        return out

    def then(self, more: Facts) -> None:
        self.blank += more.blank
        self.duplicate += more.duplicate
        self.truncated += more.truncated
        self.illegal += more.illegal + (self.last != "" and self.last + more.first not in LEGAL)
        if more.turns:
            self.turns += more.turns - (self.high == more.low)
            self.low = more.low if self.low is None else self.low
            self.high = more.high
        self.first, self.last = self.first or more.first, more.last

    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


class Piece(NamedTuple):
    facts: Facts
    paths: list[tuple[int, int, int, str]]  # entry, exit, cost, edits
    rows: list[Row]


def piece_of(rows: list[Row], entries: tuple[int, ...] = (START, SYSTEM, USER, ASSISTANT)) -> Piece:
    paths = []
    for a in entries:
        for b in (START, SYSTEM, USER, ASSISTANT):
            found = cheapest(rows, a, frozenset((b,)))
            if found:
                paths.append((a, b, *found))
    return Piece(Facts.of(rows), paths, rows)


@dataclass
class _Way:
    """The best way to one place: cost, edits behind those that all ways share, digest."""

    cost: int = 0
    edits: str = ""
    digest: object = field(default_factory=hashlib.sha256)
    empty: bool = True

    def on(self, cost: int, edits: str, turns: Iterator[tuple[str, str]]) -> _Way:
        out = _Way(self.cost + cost, self.edits + edits, self.digest.copy(), self.empty)
        for role, text in turns:
            out.digest.update(f"{'' if out.empty else chr(10)}{role}:{text}".encode())
            out.empty = False
        return out


class Joined:
    """Pieces of one conversation in order."""

    def __init__(self) -> None:
        self.facts, self.shared = Facts(), []
        self.ways: dict[int, _Way] = {START: _Way()}

    def add(self, piece: Piece) -> None:
        best: dict[int, tuple[int, str, int, str]] = {}
        for entry, leave, cost, edits in piece.paths:
            if entry in self.ways:
                way = self.ways[entry]
                ranked = (way.cost + cost, way.edits + edits, entry, edits)
                if leave not in best or ranked < best[leave]:
                    best[leave] = ranked
        self.ways = {leave: self.ways[entry].on(cost - self.ways[entry].cost, edits, replayed(piece.rows, edits, entry))
                     for leave, (cost, _, entry, edits) in best.items()}
        common = os.path.commonprefix([w.edits for w in self.ways.values()])
        self.shared.append(common)
        for way in self.ways.values():
            way.edits = way.edits[len(common):]
        self.facts.then(piece.facts)

    def result(self) -> tuple:
        way = min((w for place, w in self.ways.items() if place in ENDS), key=lambda w: (w.cost, w.edits))
        f = self.facts
        return (f.gaps(), f.blank, f.duplicate, f.truncated, f.illegal, way.cost, "".join(self.shared) + way.edits, way.digest.hexdigest())


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROW = pa.struct([("initial", pa.string()), ("fault", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_PATH = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])
_PIECES = (f"part int, seq int, rows array<struct<initial:string,fault:int,turn:long,role:string,text:string>>, "
           f"paths array<struct<entry:int,exit:int,cost:long,edits:string>>, {_RESULT}")
_NUMBERS = [pa.int64()] * 6 + [pa.string()] * 2


def _lots(rows: Iterator[tuple]) -> Iterator[tuple[object, list[Row], bool]]:
    """(conversation, rows, whether the conversation ends here) of at most LONG rows each."""
    conv, held, size, any_ = None, [], 0, False
    for name, row in rows:
        if any_ and (name != conv or len(held) >= LONG or size > HEAVY):
            yield conv, held, name != conv
            held, size = [], 0
        conv, any_ = name, True
        held.append(row)
        size += len(row.text)
    if any_:
        yield conv, held, True


def _searcher(kind: pa.DataType):
    """Sorted rows (part, conv, fields of Row) to results of conversations, and to pieces of
    those that are long or may go on in another partition."""
    types = [kind, pa.int32(), pa.int32(), pa.list_(_ROW), pa.list_(_PATH), *_NUMBERS]
    names = ["conv_id", "part", "seq", "rows", "paths", *(x.split()[0] for x in _RESULT.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = 0, []

        def rows() -> Iterator[tuple[object, Row]]:
            nonlocal part
            for batch in batches:
                parts, *columns = (c.to_pylist() for c in batch.columns)
                part = parts[0] if parts else part
                for conv, *fields in zip(*columns):
                    yield conv, Row(*fields)

        def piece(conv: object, held: list[Row], seq: int) -> None:
            p = piece_of(held)
            out.append((conv, part, seq, [r._asdict() for r in p.rows],
                        [dict(zip(("entry", "exit", "cost", "edits"), x)) for x in p.paths], *[None] * 8))

        def whole(conv: object, held: list[Row]) -> None:
            joined = Joined()
            joined.add(Piece(Facts.of(held), [(START, ASSISTANT, *cheapest(held))], held))
            out.append((conv, None, None, None, None, *joined.result()))

        def flushed() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out.clear()

        size, seq, opening, starts, waiting = 0, 0, True, True, None
        for conv, held, ends in _lots(rows()):
            if waiting:  # another conversation follows, so the one before ended here
                whole(*waiting)
                waiting = None
            if starts and ends and not opening:
                waiting = (conv, held)
            else:
                piece(conv, held, seq)
            seq += 1
            opening, starts = opening and not ends, ends
            size += sum(len(r.text) for r in held)
            if len(out) >= 500 or size > HEAVY:
                yield from flushed()
                size = 0
        if waiting:
            piece(*waiting, seq)
        yield from flushed()

    return run


def _joiner(kind: pa.DataType):
    """Pieces sorted by conversation, partition and place to results."""
    names = ["conv_id", *(x.split()[0] for x in _RESULT.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(conv: object, joined: Joined) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((conv, *joined.result()), [kind, *_NUMBERS])], names)

        now, joined = None, None
        for batch in batches:
            for conv, rows, paths in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if joined is None or conv != now:
                    if joined is not None:
                        yield made(now, joined)
                    now, joined = conv, Joined()
                held = [Row(**r) for r in rows]
                joined.add(Piece(Facts.of(held), [tuple(p.values()) for p in paths], held))
        if joined is not None:
            yield made(now, joined)

    return run


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def repaired(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit (the edits), repaired_sha256 (of ``role:text`` lines)."""
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        _text(role_col).alias("role"), _text(text_col).alias("text"))
    # what makes two rows equal: conversation, role and text
    name = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    same = F.unhex(F.sha2(F.concat_ws(":", F.length(name), name, F.length("role"), "role", "text"), 256))
    # stored, so that row numbers are the same in every later read
    slim = stored(slim.select("*", same.alias("same"), F.monotonically_increasing_id().alias("row")), "turns")
    early = order_key("turn", "row", null_last=False)
    again = slim.groupBy("same").agg(F.min(early).alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n")
    end = F.rtrim(F.col("text"), F.lit(_WHITE))
    fault = (F.when(end == "", BLANK).when(early > F.col("earliest"), DUPLICATE)
             .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(0))
    initial = F.when(F.col("role") == "", " ").otherwise(F.substring("role", 1, 1))
    marked = slim.join(again, "same", "left").select("conv_id", "turn", "role", "text", "same", "row", fault.alias("fault"), initial.alias("initial"))
    key = ["conv_id", "turn", "role", "same", "row"]
    ordered = marked.repartitionByRange(parts, *key).sortWithinPartitions(*key)
    ordered = ordered.select(F.spark_partition_id().alias("part"), "conv_id", "initial", "fault", "turn", "role", "text")
    kind = slim.schema["conv_id"].dataType
    arrow = to_arrow_type(kind)
    found = stored(ordered.mapInArrow(_searcher(arrow), f"conv_id {kind.simpleString()}, {_PIECES}"), "repairs")
    done = found.where("part IS NULL").select("conv_id", *(x.split()[0] for x in _RESULT.split(", ")))
    open_ = found.where("part IS NOT NULL").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "seq")
    rest = open_.select("conv_id", "rows", "paths").mapInArrow(_joiner(arrow), f"conv_id {kind.simpleString()}, {_RESULT}")
    return done.unionByName(rest)


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with one row in four harmed, by its place."""
    conv, turn = _text("conv_id"), _text("turn")
    way = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    text = F.when(way == 1, "").when(way == 2, F.translate(_text("text"), ".!?", "")).otherwise(_text("text"))
    return turns.where(way != 0).select(
        "conv_id", "turn", F.when(way == 4, "user").otherwise(_text("role")).alias("role"), text.alias("text"),
        F.explode(F.when(way == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def after_damage(turns: DataFrame) -> DataFrame:
    """The repair of every conversation of ``turns`` after damage, those without a row left
    included."""
    fixed = repaired(damaged(turns))
    every = turns.select(F.col("conv_id").alias("conv")).distinct()
    none = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    columns = [x.split() for x in _RESULT.split(", ")]
    return every.join(fixed, F.col("conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("conv").alias("conv_id"), *(F.coalesce(c, F.lit(none.get(c, 0)).cast(t)).alias(c) for c, t in columns))
