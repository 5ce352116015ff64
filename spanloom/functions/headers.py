"""The ``x-amzn-trace-id`` header: parse, classify, format."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the header format.
HEADER_NAME = "x-amzn-trace-id"
ROOT_LENGTH = 35
ROOT_PATTERN = "^1-[0-9a-f]{8}-[0-9a-f]{24}"
PARENT_PATTERN = "^[0-9a-f]{16}"
# root first, then optionally a parent and a decision: the length tells which are there
PLAIN_PATTERN = (
    "^Root=1-[0-9a-f]{8}-[0-9a-f]{24}(;Parent=[0-9a-f]{16})?(;Sampled=[01?])?$"
)

_STATE = (
    "struct<root:string,parent:string,sampled:boolean,custom:string,"
    "stop:boolean,swallow:boolean,held:string>"
)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: inside a lambda Spark shares no subexpressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _step(state: Column, token: Column) -> Column:
    """Read one ``;``-separated token.

    ``held`` is text that has not been delimited yet and so begins the next field name;
    null means that the delimiter was consumed.  ``swallow`` drops the next token, which is
    what an empty ``Self`` does.
    """
    text = F.concat(F.coalesce(F.concat(state["held"], F.lit(";")), F.lit("")), token["text"])

    def parts(text: Column) -> Column:
        equals = F.instr(text, "=")
        return F.struct(
            text.alias("text"), equals.alias("equals"),
            F.replace(F.substring(text, F.lit(1), equals - 1), F.lit(" "), F.lit("")).alias("name"),
            F.substring(text, equals + 1, F.length(text)).alias("value"),
        )

    read = _bound(_bound(text, parts), lambda field: _read_field(state, token, field).cast(_STATE))
    return F.when(state["stop"], state).when(state["swallow"], _state_of(state)).otherwise(read)


def _state_of(state: Column, root=None, parent=None, sampled=None, custom=None, stop=None, swallow=None, held=None):
    return F.struct(
        (state["root"] if root is None else root).alias("root"),
        (state["parent"] if parent is None else parent).alias("parent"),
        (state["sampled"] if sampled is None else sampled).alias("sampled"),
        (state["custom"] if custom is None else custom).alias("custom"),
        (F.lit(False) if stop is None else stop).alias("stop"),
        (F.lit(False) if swallow is None else swallow).alias("swallow"),
        (F.lit(None) if held is None else held).cast("string").alias("held"),
    )


def _read_field(state: Column, token: Column, field: Column) -> Column:
    text, equals, name, value = (field[part] for part in ("text", "equals", "name", "value"))
    # "name=" at the very end of the header says nothing
    dangling = token["last"] & (value == "")

    is_root = name.startswith("Root")
    is_parent = name.startswith("Parent")
    is_sampled = name.startswith("Sampled")
    is_self = name.startswith("Self")

    good_root = value.rlike(ROOT_PATTERN)
    good_parent = value.rlike(PARENT_PATTERN)
    # what a malformed root leaves behind: bad digits clear an earlier root; a bad version keeps it, and
    # so does a header that ends too soon to hold another one
    too_short = F.length(value) + token["left"] < ROOT_LENGTH
    cleared_root = F.when(
        value.startswith("1-") & ~too_short,
        F.lit(None).cast("string"),
    ).otherwise(state["root"])

    used = (
        F.when(is_root, F.lit(ROOT_LENGTH))
        .when(is_parent, F.lit(16))
        .when(is_sampled, F.lit(1))
    )
    rest = F.substring(value, used + 1, F.length(value))
    # one character after a value is skipped whatever it is; here it is usually the delimiter
    held_after = F.when(F.length(rest) > 0, F.substring(rest, F.lit(2), F.length(rest)))

    state_of = partial(_state_of, state)
    digits = F.concat(F.substring(value, 3, 8), F.substring(value, 12, 24))
    flag = F.substring(value, 1, 1)
    return (
        F.when(equals == 0, state_of(held=F.replace(text, F.lit(" "), F.lit(""))))
        .when(dangling, state_of(stop=F.lit(True)))
        .when(
            is_root,
            F.when(good_root, state_of(root=digits, held=held_after)).otherwise(
                state_of(root=cleared_root, stop=F.lit(True))
            ),
        )
        .when(
            is_parent,
            F.when(
                good_parent, state_of(parent=F.substring(value, 1, 16), held=held_after)
            ).otherwise(state_of(stop=F.lit(True))),
        )
        .when(
            is_sampled,
            state_of(
                sampled=F.when(flag == "1", F.lit(True))
                .when(flag == "0", F.lit(False))
                .otherwise(state["sampled"]),
                held=held_after,
            ),
        )
        .when(is_self, state_of(swallow=value == ""))
        .otherwise(
            state_of(custom=F.concat(state["custom"], F.lit(";"), name, F.lit("="), value))
        )
    )


def parse_trace_header(header: Column) -> Column:
    """Struct of root (32 digits), parent (16 digits), sampled and custom fields; null for null.

    Custom fields keep their order and come back as ``;name=value`` text.  The first malformed
    root or parent ends the reading; what was read before it stays.
    """
    return F.when(header.rlike(PLAIN_PATTERN), _settle(_read_plain(header))).when(
        header.isNotNull(), _read_any(header)
    )


def _read_plain(header: Column) -> dict[str, Column]:
    """A header in the form it is written in, read by position."""
    length = F.length(header)
    flag = F.when(length.isin(50, 74), F.substring(header, -1, 1))
    return {
        "root": F.concat(F.substring(header, 8, 8), F.substring(header, 17, 24)),
        "parent": F.when(length >= 64, F.substring(header, 49, 16)),
        "sampled": F.when(flag == "1", F.lit(True)).when(flag == "0", F.lit(False)),
        "custom": F.lit(""),
    }


def _read_any(header: Column) -> Column:
    return _bound(F.split(header, ";"), lambda tokens: _read_tokens(header, tokens))


def _read_tokens(header: Column, tokens: Column) -> Column:
    last = F.size(tokens) - 1

    def token(text, i):
        # the characters behind the token, delimiters included
        following = F.length(header) - F.length(F.array_join(F.slice(tokens, 1, i + 1), ";"))
        return F.struct(
            text.alias("text"), (i == last).alias("last"), following.alias("left")
        )

    return F.aggregate(
        F.transform(tokens, token),
        F.struct(
            F.lit(None).alias("root"),
            F.lit(None).alias("parent"),
            F.lit(None).alias("sampled"),
            F.lit("").alias("custom"),
            F.lit(False).alias("stop"),
            F.lit(False).alias("swallow"),
            F.lit(None).alias("held"),
        ).cast(_STATE),
        lambda s, t: _step(s, t).cast(_STATE),
        _settle,
    )


def _settle(s) -> Column:
    # an all-zero high half counts as absent, and a parent without a root says nothing
    usable = s["root"].isNotNull() & ~s["root"].startswith("0" * 16)
    return F.struct(
        F.when(usable, s["root"]).alias("root"),
        F.when(usable, s["parent"]).alias("parent"),
        s["sampled"].alias("sampled"),
        s["custom"].alias("custom"),
    )


def with_parsed(rows: DataFrame, header: Column, name: str) -> DataFrame:
    """Rows with their parsed header, which is read once a row whatever uses it.

    A plain column would be copied to every place that reads it, filters and join conditions included; what
    ``explode`` makes is not.
    """
    return rows.select("*", F.explode(F.array(parse_trace_header(header))).alias(name))


def classify_trace_context(parsed: Column) -> Column:
    """``flags`` (nothing but a sampling decision), ``trace_id`` or ``context``."""
    return (
        F.when(parsed["root"].isNull(), F.lit("flags"))
        .when(parsed["parent"].isNull(), F.lit("trace_id"))
        .otherwise(F.lit("context"))
    )


def custom_fields(custom: Column) -> Column:
    """Custom fields as a map; the text form keeps their order."""
    return F.when(custom != "", F.str_to_map(F.substring(custom, F.lit(2), F.length(custom)),
                                             F.lit(";"), F.lit("=")))


def format_root_id(trace_id: Column) -> Column:
    """128-bit ID as ``1-<8 digits>-<24 digits>``."""
    return F.concat(
        F.lit("1-"), F.substring(trace_id, 1, 8), F.lit("-"), F.substring(trace_id, 9, 24)
    )


def format_trace_header(
    trace_id: Column, span_id: Column, sampled: Column, custom: Column | None = None
) -> Column:
    flag = (
        F.when(sampled.isNull(), F.lit("?")).when(sampled, F.lit("1")).otherwise(F.lit("0"))
    )
    fields = F.lit("") if custom is None else F.coalesce(custom, F.lit(""))
    return F.concat(
        F.lit("Root="), format_root_id(trace_id),
        F.lit(";Parent="), span_id,
        F.lit(";Sampled="), flag,
        fields,
    )


def root_from_passthrough(header: Column) -> Column:
    """The 35 characters after the first ``Root=`` of an unparsed header, null when too short."""
    at = F.instr(header, "Root=")
    found = F.substring(header, at + 5, F.lit(ROOT_LENGTH))
    return F.when((at > 0) & (F.length(found) == ROOT_LENGTH), found)


def root_epoch(trace_id: Column) -> Column:
    """The time in the first 8 digits of a trace ID."""
    return F.timestamp_seconds(F.conv(F.substring(trace_id, 1, 8), 16, 10).cast("bigint"))
