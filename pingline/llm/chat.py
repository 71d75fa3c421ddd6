"""Chat formatting by a finite-state machine over roles, in DataFrame functions only.

A template says how each role's turns are marked, which of them bear loss, and which role may
follow in which state. The operator walks the turns of a conversation through the machine,
writes each as its opening mark, its text and its closing mark, and gives every one of these
segments a loss flag; only texts of loss roles have it.

A text may hold control strings of the template. Such a string gets a backslash behind its
first character, and one more if it has some there already, so no escaped text holds a control
string, other texts stay as they are, and taking one backslash away gives the text back.

* null text: empty; null role: the empty role; roles the template doesn't know are written out
* null conversation id: one conversation of its own; null turn: before all others
* a turn number that occurs twice: both turns, ordered by role, then text
* a conversation that breaks the turn order is formatted all the same: ``valid`` is false and
  ``first_bad`` is the position of the turn that broke it
* an empty table gives an empty result; other columns are ignored

A conversation becomes one string, so it meets in one task; no other group does.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingline.llm.common import whole


@dataclass(frozen=True)
class Template:
    """marks: opening and closing mark by role. other: marks around the role, and the closing
    mark, of roles without marks. moves: next state by state and role, from "start"."""

    marks: dict[str, tuple[str, str]]
    loss: frozenset[str]
    other: tuple[str, str, str]
    moves: dict[tuple[str, str], str]
    complete: frozenset[str] = field(default_factory=frozenset)

    @property
    def controls(self) -> list[str]:
        return sorted({*(m for pair in self.marks.values() for m in pair), *self.other})

    def pattern(self) -> tuple[str, str]:
        """Classes of first characters, and what may follow them (both as regex)."""
        first = "".join(sorted({re.escape(c[0]) for c in self.controls}))
        for c in self.controls:
            if "\\" in c or any(x in c[1:] for x in first.replace("\\", "")):
                raise ValueError(f"control string {c!r} may hold no backslash and begin only once")
        rest = "|".join(_quoted(c[1:]) for c in sorted(self.controls, key=len, reverse=True))
        return f"[{first}]", rest

    def escape(self, text: Column) -> Column:
        first, rest = self.pattern()
        return F.regexp_replace(text, f"({first})(\\\\*)({rest})", "$1\\\\$2$3")

    def unescape(self, text: Column) -> Column:
        first, rest = self.pattern()
        return F.regexp_replace(text, f"({first})\\\\(\\\\*)({rest})", "$1$2$3")


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/_ " else "\\" + c for c in text)


INSTRUCT = Template(
    marks={"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")},
    loss=frozenset({"assistant"}),
    other=("[ROLE]", "[/ROLE]", "[/TURN]"),
    moves={("start", "system"): "primed", ("start", "user"): "asked", ("primed", "user"): "asked",
           ("asked", "assistant"): "answered", ("answered", "user"): "asked"},
    complete=frozenset({"answered"}),
)


def formatted(turns: DataFrame, template: Template = INSTRUCT, id_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: conv_id, formatted, segments (text, loss), valid, complete,
    first_bad."""
    role = whole(F.col(role_col).cast("string"))
    text = template.escape(whole(F.col(text_col).cast("string")))
    opening, closing = F.concat(F.lit(template.other[0]), template.escape(role), F.lit(template.other[1])), F.lit(template.other[2])
    for name, (a, b) in template.marks.items():
        opening = F.when(role == name, F.lit(a)).otherwise(opening)
        closing = F.when(role == name, F.lit(b)).otherwise(closing)
    rows = turns.select(F.col(id_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), opening.alias("opening"), closing.alias("closing")).alias("t"))
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segment(t: Column, loss: Column) -> Column:
        return F.struct(t.alias("text"), loss.alias("loss"))

    segments = F.flatten(F.transform("turns", lambda t: F.array(
        segment(t["opening"], F.lit(False)), segment(t["text"], t["role"].isin(*sorted(template.loss))), segment(t["closing"], F.lit(False)))))
    moves = F.create_map(*(F.lit(x) for (s, r), to in template.moves.items() for x in (f"{s}\n{r}", to)))
    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(now: Column, t: Column) -> Column:
        to = F.element_at(moves, F.concat(now["state"], F.lit("\n"), t["role"]))
        # a turn out of order leaves the machine where it was
        return F.struct(F.coalesce(to, now["state"]).alias("state"), (now["at"] + 1).alias("at"),
                        F.coalesce(now["bad"], F.when(to.isNull(), now["at"])).alias("bad"))

    walked = talks.select("conv_id", segments.alias("segments"), F.aggregate("turns", start, step).alias("end"))
    return walked.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments",
        F.col("end.bad").isNull().alias("valid"),
        (F.col("end.bad").isNull() & F.col("end.state").isin(*sorted(template.complete))).alias("complete"),
        F.col("end.bad").alias("first_bad"))


def read_back(text: Column, template: Template = INSTRUCT) -> Column:
    """The turns (role, text) of a formatted conversation."""
    kinds = [f"{_quoted(a)}.*?{_quoted(b)}" for a, b in template.marks.values()]
    a, b, c = (_quoted(x) for x in template.other)
    written = F.regexp_extract_all(text, F.lit("(?s)" + "|".join([*kinds, f"{a}.*?{b}.*?{c}"])), F.lit(0))

    def turn(t: Column) -> Column:
        a, b, c = template.other
        role = F.substring_index(F.substring(t, F.lit(len(a) + 1), F.length(t)), b, 1)
        body = F.substring(t, F.length(role) + len(a) + len(b) + 1, F.length(t) - F.length(role) - len(a) - len(b) - len(c))
        role = template.unescape(role)
        for name, (a, b) in template.marks.items():
            known = t.startswith(F.lit(a))
            role = F.when(known, F.lit(name)).otherwise(role)
            body = F.when(known, F.substring(t, F.lit(len(a) + 1), F.length(t) - len(a) - len(b))).otherwise(body)
        return F.struct(role.alias("role"), template.unescape(body).alias("text"))

    return F.transform(written, turn)
