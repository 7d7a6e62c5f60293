"""Chat formatting: a role automaton over whole conversations, with a loss flag on every text segment.

A template is plain data: for every role the strings before and after a turn and whether the turn's
text is trained on, plus the automaton's transitions. Everything below is DataFrame expressions.

Defined results: a null text or role counts as empty; rows with equal ``turn`` are ordered by role, then
text, and all stay, repeated rows too; null turns come first; rows with a null ``conv_id`` form one conversation; very long
texts are formatted whole, and one conversation lies in one task; columns other than the four named ones,
whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Escapes, in the order they are applied. After them neither ``<`` nor ``[`` occurs in a text, so no
#: control string can; every backslash is followed by 0, 1 or 2, so undoing them in reverse order is exact.
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"))
#: A role is followed by ``after_role``, so its ``]`` is escaped too.
ROLE_ESCAPES = (*ESCAPES, ("]", "\\3"))


@dataclass(frozen=True)
class ChatTemplate:
    """``open_turn``/``after_role`` and ``close_turn`` mark a turn; ``loss_roles`` are trained on."""

    open_turn: str = "<s>[TURN "
    after_role: str = "]\n"
    close_turn: str = "</s>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    #: (state, role) -> state. A missing entry is an invalid turn.
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "briefed",
            ("start", "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    accepting: tuple[str, ...] = ("answered",)


def escape(text: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, coded in escapes:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, coded in reversed(escapes):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_chats(conversations: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: ``conv_id, segments array<struct<text, loss>>, formatted, n_bad_turns, complete``.

    The automaton walks the roles in turn order. A turn that it doesn't allow is counted in ``n_bad_turns``
    and the walk goes on from the state that the turn's role leads to from the start, so one misplaced turn
    doesn't condemn the rest; such conversations are formatted like all others. ``complete`` says that the
    walk was clean and ended in an accepting state.
    """
    rows = conversations.select(
        F.col("conv_id").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    steps = F.create_map(*[F.lit(x) for (s, r), t in template.transitions.items() for x in (f"{s}\n{r}", t)])
    entry = {r: t for (_, r), t in reversed(list(template.transitions.items()))}
    resume = F.create_map(*[F.lit(x) for r, t in entry.items() for x in (r, t)])

    def walk(acc: Column, turn: Column) -> Column:
        to = F.try_element_at(steps, F.concat(acc["state"], F.lit("\n"), turn["role"]))
        back = F.coalesce(F.try_element_at(resume, turn["role"]), acc["state"])
        return F.struct(F.coalesce(to, back).alias("state"), (acc["bad"] + F.when(to.isNull(), 1).otherwise(0)).alias("bad"))

    zero = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("bad"))
    walked = F.aggregate("turns", zero, walk)

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def segments(turn: Column) -> Column:
        head = F.concat(F.lit(template.open_turn), escape(turn["role"], ROLE_ESCAPES), F.lit(template.after_role))
        return F.array(
            segment(head, F.lit(False)),
            segment(escape(turn["text"]), turn["role"].isin(*template.loss_roles)),
            segment(F.lit(template.close_turn), F.lit(False)),
        )

    return chats.select(
        "conv_id",
        F.flatten(F.transform("turns", segments)).alias("segments"),
        walked.alias("walked"),
    ).select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.col("walked.bad").cast("long").alias("n_bad_turns"),
        ((F.col("walked.bad") == 0) & F.col("walked.state").isin(*template.accepting)).alias("complete"),
    )


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """array<struct<role, text>> from a formatted conversation: the inverse of :func:`format_chats`."""
    quoted = "".join(f"\\{c}" if not c.isalnum() and c != "\n" else c for c in template.close_turn)
    parts = F.split(formatted, quoted)
    turns = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    start, mark = len(template.open_turn) + 1, len(template.after_role)

    def parse(part: Column) -> Column:
        at = F.instr(part, template.after_role)
        return F.struct(
            unescape(F.substr(part, F.lit(start), at - F.lit(start)), ROLE_ESCAPES).alias("role"),
            unescape(F.substr(part, at + F.lit(mark))).alias("text"),
        )

    return F.transform(turns, parse)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""))
