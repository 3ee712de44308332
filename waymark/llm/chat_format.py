"""Chat formatting: a finite-state machine over roles and a declarative template, in SQL functions only.

`format_chats` takes one row per turn (conv_id, turn, role, text) and returns one row per conversation:
conv_id, n_turns, valid (the machine accepts the roles in turn order), state (where it stopped), segments
(array of struct(text, loss)) and formatted (the segments' texts, concatenated).  `read_back` recovers roles and
texts from `formatted` alone.

Defined results: null role or text counts as empty; turns sort by (turn, role, text), null turns first, so ties and
repeated rows are all kept, in one order; a null conv_id is a conversation of its own; an empty table gives no rows;
further columns are ignored.  Conversations that the machine refuses are formatted too, with valid = false.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPES = (("\\", "\\\\"), ("<|", "<\\|"), ("\n", "<\\n>"))  # in this order; the last for roles only


@dataclass(frozen=True)
class Template:
    """What surrounds a turn, the roles that are trained on, and the moves of the machine over roles."""

    opens: str = "<|im_start|>"
    between: str = "\n"
    closes: str = "<|im_end|>"
    ends: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "told",
            ("start", "user"): "asked",
            ("told", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
            ("asked", "tool"): "asked",
        }
    )
    accepts: tuple[str, ...] = ("answered",)


def escape(text: Column, role: bool = False) -> Column:
    """No control string is left in what this returns, and `unescape` undoes it."""
    for plain, safe in ESCAPES[: 3 if role else 2]:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    for plain, safe in reversed(ESCAPES[: 3 if role else 2]):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def final_state(roles: Column, template: Template) -> Column:
    """The machine's state after the roles, in order; `refused` has no way out."""
    moves = F.create_map(*[F.lit(x) for (s, r), to in template.moves.items() for x in (f"{s}\n{r}", to)])
    step = lambda s, r: F.coalesce(F.element_at(moves, F.concat(s, F.lit("\n"), r)), F.lit("refused"))
    return F.aggregate(roles, F.lit(template.start), step)


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    row = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    grouped = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))

    def segments(turn: Column) -> Column:
        role = turn["role"]
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            piece(F.concat(F.lit(template.opens), escape(role, role=True), F.lit(template.between)), F.lit(False)),
            piece(escape(turn["text"]), role.isin(*template.loss_roles)),
            piece(F.lit(template.closes + template.ends), F.lit(False)),
        )

    with_segments = grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        final_state(F.col("turns.role"), template).alias("state"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    )
    return with_segments.select(
        "conv_id",
        "n_turns",
        F.col("state").isin(*template.accepts).alias("valid"),
        "state",
        "segments",
        F.concat_ws("", F.col("segments.text")).alias("formatted"),
    )


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """array<struct<role, text>> of a formatted conversation; needs nothing but its text and the template."""
    opened = F.filter(F.split(formatted, f"\\Q{template.opens}\\E"), lambda x: x != "")

    def turn(part: Column) -> Column:
        role = F.substring_index(part, template.between, 1)
        rest = F.substr(part, F.char_length(role) + len(template.between) + 1)
        text = F.substr(rest, F.lit(1), F.char_length(rest) - len(template.closes + template.ends))
        return F.struct(unescape(role, role=True).alias("role"), unescape(text).alias("text"))

    return F.transform(opened, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.concat_ws("", F.transform(F.filter(segments, lambda x: x["loss"]), lambda x: unescape(x["text"])))
