"""Chat formatting: a declarative template, a finite-state machine over roles, a loss flag for each segment."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Turns are folded in runs of this size, so that no step copies the states of a whole long conversation.
FOLD = 256
_STRAY = "!"


@dataclass(frozen=True)
class ChatTemplate:
    """How turns are marked, which role may follow which, and in which states a text trains.

    ``names``: role to the name shown in its header.  Other roles are shown as they are.  ``moves``: state to
    role to next state.  A role without a move leads to the stray state of that role, from which every role leads
    to its own stray state.  ``trained``: the states whose turn's text is under the loss mask; a stray state is if
    its role leads to such a state anywhere.
    """

    head: str = "### "
    after_name: str = ": "
    end: str = " </turn>\n"
    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    trained: tuple[str, ...] = ("answered",)
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "briefed", "user": "asked"},
            "briefed": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    accepting: tuple[str, ...] = ("answered",)

    #: Inside texts the first becomes the second; a backslash is doubled before, so this can be undone.  After it
    #: no text holds a header's first character unprotected, nor an end mark.
    escapes: tuple[tuple[str, str], ...] = (("#", "\\#"), ("</turn>", "<\\/turn>"))


def escaped(text: Column, t: ChatTemplate) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, safe in t.escapes:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    """Each backslash of an escaped text is followed by what it protects: a doubled one by itself."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _name(role: Column, t: ChatTemplate) -> Column:
    """The name of a role in a header: those of the template, or else the escaped role after an equals sign."""
    other = F.concat(F.lit("="), F.replace(escaped(role, t), F.lit(t.after_name), F.lit(f"{t.after_name[0]}\\{t.after_name[1:]}")))
    out = other
    for r, shown in t.names.items():
        out = F.when(role == r, F.lit(shown)).otherwise(out)
    return out


def _role(name: Column, t: ChatTemplate) -> Column:
    out = unescaped(F.substring(name, 2, 1 << 30))
    for r, shown in t.names.items():
        out = F.when(name == shown, F.lit(r)).otherwise(out)
    return out


def turn_states(turns: Column, t: ChatTemplate) -> Column:
    """array<string>: the machine's state after each turn; stray states begin with an exclamation mark."""
    table = F.create_map(*[F.lit(x) for state, by in t.moves.items() for role, to in by.items() for x in (f"{state} {role}", to)])
    step = lambda state, role: F.coalesce(F.try_element_at(table, F.concat_ws(" ", state, role)), F.concat(F.lit(_STRAY), role))
    fresh = lambda state, seen: F.struct(state.alias("state"), seen.alias("seen"))

    def run(acc: Column, number: Column) -> Column:
        inner = F.aggregate(
            F.slice(turns, number * FOLD + 1, F.lit(FOLD)),
            fresh(acc["state"], F.expr("cast(array() as array<string>)")),
            lambda a, x: fresh(step(a["state"], x["role"]), F.concat(a["seen"], F.array(step(a["state"], x["role"])))),
        )
        return F.struct(inner["state"].alias("state"), F.concat(acc["seen"], F.array(inner["seen"])).alias("seen"))

    start = fresh(F.lit("start"), F.expr("cast(array() as array<array<string>>)"))
    numbers = F.sequence(F.lit(0), F.floor((F.size(turns) - 1) / F.lit(FOLD)).cast("int"))
    return F.flatten(F.aggregate(numbers, start, run)["seen"])


def format_chats(rows: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row a conversation: conv_id, n_turns, segments (text, loss), formatted, valid, state, bad_turn.

    The machine runs over the roles; the state that it reaches with a turn decides whether that turn's text is
    under the loss mask, and whether the conversation is valid.  A segment is a header, an escaped text or an end
    mark; only texts can have ``loss``.

    ``rows`` has conv_id, turn, role, text; further columns are ignored.  Turns are taken by turn number, null
    numbers first, equal ones by role, then text; repeated rows are turns of their own.  A null text or role is
    an empty one.  Rows with a null conv_id make one conversation of their own.  A conversation against the
    role order is formatted as well: ``state`` is bad, ``valid`` is false and ``bad_turn`` is the position (from 1)
    of the first turn that had no move, null if none had; conversations that stop in a state that isn't accepting
    are invalid too.  Texts of any length are formatted whole.  An empty table gives an empty one.
    """
    t = template
    turns = rows.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    walked = grouped.withColumn("states", turn_states(F.col("turns"), t))

    trains = sorted({*t.trained, *(f"{_STRAY}{role}" for by in t.moves.values() for role, to in by.items() if to in t.trained)})
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    parts = F.flatten(
        F.zip_with(
            "turns", "states",
            lambda x, state: F.array(
                segment(F.concat(F.lit(t.head), _name(x["role"], t), F.lit(t.after_name)), F.lit(False)),
                segment(escaped(x["text"], t), state.isin(*trains)),
                segment(F.lit(t.end), F.lit(False)),
            ),
        )
    )
    last = F.element_at("states", -1)
    strays = F.array_position(F.transform("states", lambda s: s.startswith(_STRAY)), F.lit(True))
    out = walked.select("conv_id", F.size("turns").cast("long").alias("n_turns"), parts.alias("segments"), last.alias("_last"), strays.cast("int").alias("_stray"))
    return out.select(
        "conv_id", "n_turns", "segments",
        F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"),
        F.col("_last").isin(*t.accepting).alias("valid"),
        F.when(F.col("_stray") > 0, "bad").otherwise(F.col("_last")).alias("state"),
        F.when(F.col("_stray") > 0, F.col("_stray")).alias("bad_turn"),
    )


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """array<struct<role, text>> of a formatted conversation; undoes ``format_chats``.

    No escaped text holds an end mark, so the marks alone delimit turns.
    """
    t = template
    size = len(t.head)
    blocks = F.filter(F.split(formatted, rf"\Q{t.end}\E"), lambda b: b != "")
    at = lambda b: F.instr(F.substring(b, size + 1, 1 << 30), F.lit(t.after_name))
    return F.transform(
        blocks,
        lambda b: F.struct(
            _role(b.substr(F.lit(size + 1), at(b) - 1), t).alias("role"),
            unescaped(b.substr(at(b) + size + len(t.after_name), F.lit(1 << 30))).alias("text"),
        ),
    )
