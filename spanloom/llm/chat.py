"""Chat formatting: a finite-state machine over roles and a declarative template.

A template says how a turn begins and ends and which roles are trained on; ``ORDER`` says which role
may follow which.  Texts and roles are escaped so that no marker of the template can occur in them,
and the escape is undone when a formatted conversation is read back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the ChatML layout.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

#: From state to the roles that may come next; a state is the last role, "" before the first turn.
ORDER = {
    "": ["system", "user"],
    "system": ["user"],
    "user": ["assistant"],
    "assistant": ["user"],
}
FINAL = ["assistant"]


@dataclass(frozen=True)
class Template:
    begin: str = OPEN
    after_role: str = "\n"
    end: str = CLOSE + "\n"
    trained: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape(text: Column) -> Column:
    """Backslashes are doubled; one goes between the two characters that open a marker."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _role_out(role: Column) -> Column:
    """A line break would end the role, so it is written as a marker no role contains."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n>"))


def _role_in(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def _state_after(state: Column, role: Column) -> Column:
    """Null once an order was broken; then it stays null."""
    allowed = F.create_map(*[
        x for s, roles in ORDER.items()
        for x in (F.lit(s), F.array(*[F.lit(r) for r in roles]))
    ])
    return F.when(F.array_contains(F.element_at(allowed, state), role), role)


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation with its turns in order (``turns``: role, text).

    A conversation is the unit of output and is gathered whole.  Turns of equal number follow each
    other by role and text; a null role or text counts as empty, a null number comes first.
    """
    row = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))


def segments(gathered: DataFrame, template: Template = CHATML) -> DataFrame:
    """Add ``segments`` (text, loss), in order, and ``valid`` (the machine accepts the roles)."""
    state = F.aggregate("turns", F.lit(""), lambda s, t: _state_after(s, t["role"]))

    def pieces(t: Column) -> Column:
        head = F.concat(F.lit(template.begin), _role_out(t["role"]), F.lit(template.after_role))
        trained = t["role"].isin(*template.trained)
        return F.array(
            _segment(head, F.lit(False)), _segment(escape(t["text"]), trained),
            _segment(F.lit(template.end), F.lit(False)),
        )

    return gathered.withColumn("segments", F.flatten(F.transform("turns", pieces))).withColumn(
        "valid", F.coalesce(state.isin(*FINAL), F.lit(False))
    )


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def formatted(with_segments: DataFrame) -> DataFrame:
    """Add the whole ``formatted`` text and the code-point ranges under loss (``loss_spans``)."""
    start = F.struct(
        F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")
    )

    def walk(acc: Column, s: Column) -> Column:
        end = acc["at"] + F.length(s["text"])
        span = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"), F.when(s["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans")
        )

    return with_segments.withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    ).withColumn("loss_spans", F.aggregate("segments", start, walk, lambda acc: acc["spans"]))


def read_back(written: DataFrame, template: Template = CHATML) -> DataFrame:
    """Add ``read`` (role, text per turn) and ``loss_text`` from ``formatted`` and ``loss_spans``.

    Nothing but the formatted text and the ranges is looked at.
    """
    # every turn starts behind a begin marker, the piece before the first one is empty
    opened = F.split(F.col("formatted"), _literal(template.begin), -1)
    turns = F.slice(opened, F.lit(2), F.size(opened) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, template.after_role, 1)
        text_at = F.length(role) + len(template.after_role) + 1
        text = F.substring(piece, text_at, F.length(piece) - text_at - len(template.end) + 1)
        return F.struct(_role_in(role).alias("role"), unescape(text).alias("text"))

    loss = F.array_join(
        F.transform(
            "loss_spans",
            lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
        ), "",
    )
    return written.withColumn("read", F.transform(turns, turn)).withColumn("loss_text", loss)


def _literal(marker: str) -> str:
    return "\\Q" + marker + "\\E"


def format_conversations(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """``conv_id, valid, segments, formatted, loss_spans`` per conversation."""
    return formatted(segments(conversations(turns), template)).drop("turns")
