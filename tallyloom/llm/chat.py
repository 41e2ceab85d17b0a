"""Chat formatting: a state machine over roles and a declarative template, in DataFrame functions.

A conversation is a set of rows (conversation, turn, role, text). Every turn becomes three
segments: the role's opening mark, the text, the closing mark. Only the texts of roles the
template trains on carry the loss flag. Marks inside a text are broken up by a backslash
(and backslashes are doubled), so a text can never be read as a mark, and `unescaped`
restores it exactly.

Defined cases: null text is empty; a null role is the empty role; roles without a format of
their own get the fallback mark, which carries the escaped role name; rows with equal turn
(null first) are ordered by role, then text, and repeated rows are turns of their own; rows
with a null conversation form one conversation; an empty table gives no rows. An order the
state machine refuses is formatted all the same and flagged (`valid`, `bad_turn`).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Marks:
    """What stands before and after the text of a turn, and whether the text is trained on."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Role formats, the roles that may follow each state, and the states a chat may end in.

    The state after a turn is its role; `start` is the state before the first turn. The
    fallback format names the role between `other_opening` and `other_named`.
    """

    roles: dict[str, Marks]
    follows: dict[str, tuple[str, ...]]
    ends: tuple[str, ...]
    start: str = "^"
    other_opening: str = "[ROLE]"
    other_named: str = "[SAYS]"
    other_closing: str = "[/ROLE]"
    extra_controls: tuple[str, ...] = field(default=("<s>",))

    def controls(self) -> list[str]:
        """Every string that must not appear in a text."""
        marks = [mark for m in self.roles.values() for mark in (m.opening, m.closing)]
        others = [self.other_opening, self.other_named, self.other_closing]
        return list(dict.fromkeys([m.strip() for m in marks] + others + [*self.extra_controls]))

    def closings(self) -> list[str]:
        own = [marks.closing for marks in self.roles.values()]
        return list(dict.fromkeys([*own, self.other_closing]))


INSTRUCT = ChatTemplate(
    roles={
        "system": Marks("[SYS] ", " [/SYS]"),
        "user": Marks("[INST] ", " [/INST]"),
        "assistant": Marks("[ANSWER] ", "</s>", loss=True),
    },
    follows={
        "^": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
    ends=("assistant",),
)


def _any_of(strings: list[str]) -> str:
    return "|".join(re.escape(s) for s in strings)


def escaped(text: Column, template: ChatTemplate) -> Column:
    """Double backslashes, then put one after the first character of every control string."""
    broken = "|".join(
        f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.controls()
    )
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), broken, "$0\\\\")


def unescaped(text: Column) -> Column:
    """A doubled backslash is one, a single one is none."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _opening(role: Column, template: ChatTemplate) -> Column:
    named = F.concat(
        F.lit(template.other_opening), escaped(role, template), F.lit(template.other_named)
    )
    for name, marks in template.roles.items():
        named = F.when(role == name, F.lit(marks.opening)).otherwise(named)
    return named


def _closing(role: Column, template: ChatTemplate) -> Column:
    mark = F.lit(template.other_closing)
    for name, marks in template.roles.items():
        mark = F.when(role == name, F.lit(marks.closing)).otherwise(mark)
    return mark


def _first_bad_turn(roles: Column, template: ChatTemplate) -> Column:
    """Run the state machine: the position (from 1) of the first turn it refuses, one past
    the end if it stops in a state that is no end, or null."""
    allowed = F.array(
        *(F.lit(f"{state}\n{role}") for state, nexts in template.follows.items() for role in nexts)
    )
    begin = F.struct(
        F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(0).alias("bad")
    )

    def step(now: Column, role: Column) -> Column:
        at = now["at"] + 1
        fits = F.array_contains(allowed, F.concat_ws("\n", now["state"], role))
        bad = F.when((now["bad"] > 0) | fits, now["bad"]).otherwise(at)
        return F.struct(role.alias("state"), at.alias("at"), bad.alias("bad"))

    def finish(now: Column) -> Column:
        ended = now["state"].isin(*template.ends)
        return F.when(now["bad"] > 0, now["bad"]).when(~ended, now["at"] + 1)

    return F.aggregate(roles, begin, step, finish)


def format_chats(
    chats: DataFrame,
    template: ChatTemplate = INSTRUCT,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: its segments array<struct<text, loss>> in order, `valid`
    and `bad_turn` from the state machine. The formatted chat is the segments joined."""
    role_name = F.coalesce(F.col(role), F.lit(""))
    trained = [name for name, marks in template.roles.items() if marks.loss]
    rows = chats.select(
        F.col(conversation).alias("conversation"),
        F.struct(
            F.col(turn).alias("turn"),
            role_name.alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("row"),
    )
    turns = rows.groupBy("conversation").agg(F.sort_array(F.collect_list("row")).alias("turns"))

    def pieces(row: Column) -> Column:
        loss = row["role"].isin(*trained) if trained else F.lit(False)
        return F.array(
            F.struct(_opening(row["role"], template).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(row["text"], template).alias("text"), loss.alias("loss")),
            F.struct(_closing(row["role"], template).alias("text"), F.lit(False).alias("loss")),
        )

    bad_turn = _first_bad_turn(F.transform("turns", lambda row: row["role"]), template)
    return turns.select(
        "conversation",
        F.flatten(F.transform("turns", pieces)).alias("segments"),
        bad_turn.isNull().alias("valid"),
        bad_turn.alias("bad_turn"),
    )


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescaped(s["text"])), "")


def parsed(formatted_text: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """Read a formatted chat back: array<struct<role, text>>.

    Closing marks appear nowhere but at the end of a turn, so the chat is cut after each.
    """
    cut = F.split(formatted_text, "|".join(f"(?<={re.escape(c)})" for c in template.closings()))
    turns = F.filter(cut, lambda t: t != "")

    def between(t: Column, opening: str, closing: str) -> Column:
        size = F.length(t) - len(opening) - len(closing)
        return unescaped(F.substring(t, F.lit(len(opening) + 1), size))

    def turn_of(t: Column) -> Column:
        raw = F.substring(
            t,
            F.lit(len(template.other_opening) + 1),
            F.length(t) - len(template.other_opening) - len(template.other_closing),
        )
        name = F.substring_index(raw, template.other_named, 1)
        said = F.substring(
            raw, F.length(name) + len(template.other_named) + 1, F.length(raw)
        )
        out = F.struct(unescaped(name).alias("role"), unescaped(said).alias("text"))
        for role, marks in template.roles.items():
            own = F.struct(
                F.lit(role).alias("role"), between(t, marks.opening, marks.closing).alias("text")
            )
            out = F.when(t.startswith(marks.opening), own).otherwise(out)
        return out

    return F.transform(turns, turn_of)
