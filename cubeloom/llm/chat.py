"""Chat formatting: a role automaton and a declarative template, in SQL expressions.

A template says for each role which control strings open and close a turn and whether its text
is under the loss mask.  Inside texts every character that can begin a control string gets the
escape mark *after* it, so a control string never occurs in a text, and taking away one mark
after each such character gives the text back.  The automaton's states are the roles; a
conversation that leaves it is still formatted, with the first offending turn reported.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RoleFormat:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    roles: dict[str, RoleFormat] = field(
        default_factory=lambda: {
            "system": RoleFormat("<<SYS>>", "<</SYS>>"),
            "user": RoleFormat("[INST]", "[/INST]"),
            "assistant": RoleFormat("<s>", "</s>", loss=True),
        }
    )
    # any other role is named between these two; never under the loss mask
    other_open: tuple[str, str] = ("<|", "|>")
    other_close: str = "<|end|>"
    leads: str = "<["
    mark: str = "\\"
    start: str = "start"
    # state -> roles that may follow
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )

    def closers(self) -> str:
        every = [r.close for r in self.roles.values()] + [self.other_close]
        return "|".join(re.escape(c) for c in every)


def escape(text: Column, template: ChatTemplate, more: str = "") -> Column:
    for lead in template.leads + more:
        text = F.replace(text, F.lit(lead), F.lit(lead + template.mark))
    return text


def unescape(text: Column, template: ChatTemplate, more: str = "") -> Column:
    for lead in template.leads + more:
        text = F.replace(text, F.lit(lead + template.mark), F.lit(lead))
    return text


def _case(role: Column, template: ChatTemplate, pick, otherwise: Column) -> Column:
    out = otherwise
    for name, form in template.roles.items():
        out = F.when(role == name, pick(form)).otherwise(out)
    return out


def format_chats(
    turns: DataFrame,
    template: ChatTemplate = ChatTemplate(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, formatted, segments, n_turns, valid, first_bad_turn), one row per conversation.

    ``segments`` are (text, loss) in order and make up ``formatted`` when joined.  Turns are
    ordered by turn number (null first), then role and text; repeated rows are turns of their
    own.  A null text is empty, a null role is the empty role; rows with a null conversation
    id are one conversation.  Other columns are ignored.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        role = t["role"]
        first, last = template.other_open
        named = F.concat(F.lit(first), escape(role, template, "|"), F.lit(last))
        opening = _case(role, template, lambda f: F.lit(f.open), named)
        closing = _case(role, template, lambda f: F.lit(f.close), F.lit(template.other_close))
        loss = _case(role, template, lambda f: F.lit(f.loss), F.lit(False))

        def segment(text: Column, under: Column) -> Column:
            return F.struct(text.alias("text"), under.alias("loss"))

        return F.array(
            segment(opening, F.lit(False)),
            segment(escape(t["text"], template), loss),
            segment(closing, F.lit(False)),
        )

    pairs = [f"{s}\n{r}" for s, allowed in template.follows.items() for r in allowed]

    def step(state: Column, t: Column) -> Column:
        goes = F.array(*[F.lit(p) for p in pairs])
        fine = F.array_contains(goes, F.concat(state["role"], F.lit("\n"), t["role"]))
        bad = F.coalesce(state["bad"], F.when(~fine, state["n"]))
        return F.struct(t["role"].alias("role"), (state["n"] + 1).alias("n"), bad.alias("bad"))

    begin = F.struct(
        F.lit(template.start).alias("role"),
        F.lit(0).alias("n"),
        F.lit(None).cast("int").alias("bad"),
    )
    built = grouped.select(
        "conv_id",
        F.flatten(F.transform("turns", segments)).alias("segments"),
        F.size("turns").cast("long").alias("n_turns"),
        F.aggregate("turns", begin, step, lambda s: s["bad"]).alias("first_bad_turn"),
    )
    return built.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        "n_turns",
        F.col("first_bad_turn").isNull().alias("valid"),
        "first_bad_turn",
    )


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """Array of (role, text), from the formatted string alone."""
    pieces = F.split(formatted, template.closers(), -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    first, last = template.other_open

    def turn(piece: Column) -> Column:
        end = F.instr(piece, last)
        role = unescape(
            F.substring(piece, F.lit(len(first) + 1), end - 1 - len(first)), template, "|"
        )
        text = F.substring(piece, end + len(last), F.length(piece))
        for name, form in template.roles.items():
            hit = F.startswith(piece, F.lit(form.open))
            role = F.when(hit, F.lit(name)).otherwise(role)
            text = F.when(
                hit, F.substring(piece, F.lit(len(form.open) + 1), F.length(piece))
            ).otherwise(text)
        return F.struct(role.alias("role"), unescape(text, template).alias("text"))

    return F.transform(pieces, turn)


def loss_text(segments: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    own = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(own, lambda s: unescape(s["text"], template)), "")
