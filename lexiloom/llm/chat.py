"""Chat formatting by a finite-state machine over roles, in DataFrame functions only.

A declarative Template names the marks, the turn order that is allowed and the roles that
carry loss. `format_chats` makes one row per conversation with its text segments, each with
its loss flag; `read_back` parses the formatted text into turns again.

Defined results: a null role or text counts as empty; turns go by (turn, role, text), null
turns first, so ties and repeated rows have one order and every row is a turn of its own;
rows with a null conversation id form one conversation; an empty table gives no rows; other
columns are not looked at. A conversation whose roles break the turn order is formatted all
the same, with valid = false and the index of its first wrong turn.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks must start with `<|`; texts and roles never hold that pair once they are escaped."""

    open: str = "<|im_start|>"
    close: str = "<|im_end|>"
    role_end: str = "\n"
    turn_end: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: State (the last role, or "" at the start) to the roles that may follow.
    order: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant", "tool"),
        }
    )


def escape(text: Column) -> Column:
    r"""Puts one more backslash between `<` and `|`, so that no `<|` is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    slashed = F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))
    return escape(slashed)


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def _first_wrong(turns: Column, template: Template) -> Column:
    """Runs the machine: index of the first turn that no transition allows, else null."""
    pairs = [F.lit(f"{state}\x01{role}") for state, roles in template.order.items() for role in roles]
    allowed = F.array(*pairs)

    def step(acc: Column, turn: Column) -> Column:
        ok = F.array_contains(allowed, F.concat(acc["state"], F.lit("\x01"), turn["role"]))
        wrong = F.when(acc["wrong"].isNull() & ~ok, acc["i"]).otherwise(acc["wrong"])
        return F.struct(turn["role"].alias("state"), (acc["i"] + 1).alias("i"), wrong.alias("wrong"))

    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("wrong"))
    return F.aggregate(turns, start, step, lambda acc: acc["wrong"])


def _segments(turn: Column, template: Template) -> Column:
    seg = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    head = F.concat(F.lit(template.open), _escape_role(turn["role"]), F.lit(template.role_end))
    return F.array(
        seg(head, F.lit(False)),
        seg(escape(turn["text"]), turn["role"].isin(*template.loss_roles)),
        seg(F.lit(template.close + template.turn_end), F.lit(False)),
    )


def format_chats(messages: DataFrame, template: Template | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, segments (array of struct<text, loss>), formatted, valid, wrong_turn.

    One conversation is one output text, so its turns have to meet in one row; the shuffle
    carries only the columns needed.
    """
    template = template or Template()
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = messages.select(F.col(conv).alias("conv_id"), F.struct(F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    out = turns.select("conv_id", F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"), _first_wrong(F.col("turns"), template).alias("wrong_turn"))
    return out.select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), F.col("wrong_turn").isNull().alias("valid"), "wrong_turn")


def read_back(formatted: Column, template: Template | None = None) -> Column:
    """The turns (array of struct<role, text>) that a formatted text holds."""
    template = template or Template()
    parts = F.split(formatted, template.open.replace("|", r"\|"))
    tail = len(template.close + template.turn_end)

    def turn(part: Column) -> Column:
        at = F.instr(part, template.role_end)
        begin = at + len(template.role_end)
        role = F.substring(part, F.lit(1), at - 1)
        text = F.substring(part, begin, F.length(part) - tail - begin + 1)
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_text(segments: Column) -> Column:
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digests(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """Figures of each conversation, read back from `format_chats`' output."""
    turns = chats.select("conv_id", "valid", "wrong_turn", "formatted", read_back(F.col("formatted"), template).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        F.coalesce(F.col("wrong_turn").cast("long"), F.lit(-1)).alias("wrong_turn"),
    )
