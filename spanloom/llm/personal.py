"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, URL schemes and cues such as
``account``.  From each anchor a small parser reads on, and for at-signs back, to the boundaries of an
e-mail address, a network address, a number or an account, and validates what it read.  Parsers of one
kind never enter text that an earlier find of the kind holds, so each character is read a bounded number
of times, however many anchors a text has.

Everything sought is ASCII; other characters count as ``?``, which no parser accepts, so that offsets are
code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows, strings

# Kinds in the order in which they are listed; the last two are what cues and schemes add.
KINDS = ("email", "ip", "card", "phone", "account", "login")
EMAIL, IP, CARD, PHONE, ACCOUNT, LOGIN = range(len(KINDS))

# Words in front of an identifier, and schemes whose addresses may name a user.
CUES = (
    "account", "acct", "customer id", "iban", "member id", "passport", "policy number", "ssn", "tax id",
    "user id",
)
SCHEMES = ("ftp://", "http://", "https://", "sftp://", "ssh://")

_DIGITS = frozenset(b"0123456789")
_LETTERS = frozenset(range(ord("a"), ord("z") + 1)) | frozenset(range(ord("A"), ord("Z") + 1))
_WORD = _DIGITS | _LETTERS
_LOCAL = _WORD | frozenset(b"._%+-")
_LABEL = _WORD | frozenset(b"-")
_CALL = _DIGITS | frozenset(b" ().-")
_USER = _WORD | frozenset(b"._~%!$&'*+,;=:-")
_HOST = _WORD | frozenset(b".-")
_BETWEEN = frozenset(b" :#=")

CARD_DIGITS = (13, 19)
PHONE_DIGITS = (9, 15)
ACCOUNT_LENGTH = (6, 34)
ACCOUNT_DIGITS = 4
#: Blanks, colons, hashes and equals signs between a cue and its identifier.
CUE_GAP = 4

_SPANS = "array<struct<kind:int,start:long,end:long>>"

Span = tuple[int, int, int]


def _run(text: bytes, at: int, allowed: frozenset) -> int:
    """Where the run of allowed characters from ``at`` on ends."""
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def email(text: bytes, at_sign: int, floor: int) -> Span | None:
    """The address around an at-sign that does not begin before ``floor``."""
    start = at_sign
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, at_sign + 1, _LABEL)
    if start == at_sign or end == at_sign + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == 0x2E:
        after = _run(text, end + 1, _LABEL)
        if after == end + 1:
            break
        end, labels = after, labels + 1
    return (EMAIL, start, end) if labels else None


def dotted(text: bytes, at: int) -> tuple[list[Span], int]:
    """Addresses of four numbers in a chain of numbers joined by points, and where the chain ends."""
    parts = []
    while True:
        end = _run(text, at, _DIGITS)
        parts.append((at, end))
        if end + 1 < len(text) and text[end] == 0x2E and text[end + 1] in _DIGITS:
            at = end + 1
        else:
            break
    found = []
    for i in range(0, len(parts) - 3, 4):
        four = parts[i:i + 4]
        if all(_at_most_255(text[a:b]) for a, b in four):
            found.append((IP, four[0][0], four[3][1]))
    return found, end


def _at_most_255(digits: bytes) -> bool:
    short = digits.lstrip(b"0")
    return len(short) < 3 or (len(short) == 3 and short <= b"255")


def card(text: bytes, at: int) -> tuple[Span | None, int]:
    """The number whose digits stand alone or one blank or hyphen apart, and where it ends."""
    start, end = at, at + 1
    while end < len(text):
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in b" -" and end + 1 < len(text) and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    digits = text[start:end].replace(b" ", b"").replace(b"-", b"")
    right = CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)
    return ((CARD, start, end) if right else None), end


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d -= 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def phone(text: bytes, plus: int) -> Span | None:
    """An international number from its plus sign on, up to the last digit of the run."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return None
    end = _run(text, plus + 2, _CALL)
    while end > plus + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end <= plus + 3 or text[end - 1] not in _DIGITS:
        return None
    digits = sum(c in _DIGITS for c in text[plus:end])
    return (PHONE, plus, end) if PHONE_DIGITS[0] <= digits <= PHONE_DIGITS[1] else None


def account(text: bytes, start: int, end: int) -> Span | None:
    """The identifier behind a cue: letters, digits and hyphens, with digits enough.

    What looks like an IBAN has to satisfy its check digits.
    """
    if start and text[start - 1] in _WORD:
        return None
    begin = _run(text, end, _BETWEEN)
    if not 0 < begin - end <= CUE_GAP:
        return None
    stop = _run(text, begin, _LABEL)
    while stop > begin and text[stop - 1] == 0x2D:
        stop -= 1
    value = text[begin:stop].replace(b"-", b"")
    digits = sum(c in _DIGITS for c in value)
    if not ACCOUNT_LENGTH[0] <= len(value) <= ACCOUNT_LENGTH[1] or digits < ACCOUNT_DIGITS:
        return None
    if text[begin] == 0x2D or (_is_iban(value) and not _iban_checks(value)):
        return None
    return ACCOUNT, begin, stop


def _is_iban(value: bytes) -> bool:
    return len(value) >= 15 and set(value[:2]) <= _LETTERS and set(value[2:4]) <= _DIGITS


def _iban_checks(value: bytes) -> bool:
    moved = (value[4:] + value[:4]).decode().lower()
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def login(text: bytes, start: int, end: int) -> Span | None:
    """A URL's scheme, user and host where it names a user; ``start`` to ``end`` is the scheme."""
    at_sign = _run(text, end, _USER)
    if at_sign == end or at_sign >= len(text) or text[at_sign] != 0x40:
        return None
    stop = _run(text, at_sign + 1, _HOST)
    while stop > at_sign + 1 and text[stop - 1] not in _WORD:
        stop -= 1
    return (LOGIN, start, stop) if stop > at_sign + 1 else None


def anchors() -> ahocorasick.Automaton:
    """All anchors with what reads on from them, and their lengths."""
    found = ahocorasick.Automaton()
    for kind, words in (
        (EMAIL, "@"), (PHONE, "+"), (CARD, "0123456789"), (ACCOUNT, CUES), (LOGIN, SCHEMES),
    ):
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def spans(text: str, automaton: ahocorasick.Automaton) -> list[Span]:
    """All finds in a whole text by kind, then start."""
    flat = text.encode("ascii", "replace")
    out: list[Span] = []
    mails = logins = numbers = chains = 0  # up to where each kind has read
    for last, (kind, length) in automaton.iter(flat.lower().decode("ascii")):
        start, found = last - length + 1, None
        if kind == CARD:
            if start >= chains:
                more, chains = dotted(flat, start)
                out += more
            if start >= numbers:
                found, numbers = card(flat, start)
        elif kind == EMAIL:
            found = email(flat, start, mails)
            mails = found[2] if found else mails
        elif kind == PHONE:
            found = phone(flat, start)
        elif kind == ACCOUNT:
            found = account(flat, start, last + 1)
        elif kind == LOGIN and start >= logins:
            found = login(flat, start, last + 1)
            logins = found[2] if found else logins
        if found:
            out.append(found)
    return sorted(out)


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id`` and ``spans`` (kind, start and end in code points) per row; no shuffle.

    Null and empty texts have none; rows of null or equal IDs are rows of their own.
    """

    def run(batches: Batches) -> Iterator[dict]:
        automaton = anchors()
        for batch in batches:
            yield {
                "id": batch.column("id"),
                "spans": [
                    [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans(t, automaton)]
                    for t in strings(batch.column("text"))
                ],
            }

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    return map_rows(rows, run, f"id long, spans {_SPANS}")


def of_kind(spans: Column, *kinds: int) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")
