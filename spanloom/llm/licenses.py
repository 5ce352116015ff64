"""Licence scans: canonical digests of texts, lines and runs of lines, joined to known digests."""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows, strings

# Spellings that count as the same word.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze",
    "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "calibre": "caliber", "cancelled": "canceled", "favour": "favor", "favourite": "favorite",
    "fulfil": "fulfill", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "licence": "license", "licences": "licenses", "licenced": "licensed", "merchantability": "merchantability",
    "modelling": "modeling", "organisation": "organization", "practise": "practice",
    "programme": "program", "recognise": "recognize", "utilisation": "utilization",
    "whilst": "while", "wilful": "wilfull", "noncommercial": "non commercial",
    "sublicence": "sublicense", "https": "http",
}

# Notices and short licences as their stewards publish them.
KNOWN = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License");',
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at

        http://www.apache.org/licenses/LICENSE-2.0

        Unless required by applicable law or agreed to in writing, software distributed under the
        License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions
        and limitations under the License.""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions:

        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.

        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
        FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    ],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.

        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
        SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
        THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
        DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE
        OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
}

# comment signs may stand in front; a year, a sign or a holder has to follow
_YEAR = r"[\[<{(]?(?:\d{4}|yyyy|year)\b"
_COPYRIGHT = re.compile(
    rf"\W*(?:copyright\b\W*(?:\(c\)|©|{_YEAR}|by\b)"
    rf"|\(c\)\W*(?:copyright\b|{_YEAR})|©|all rights reserved\W*$)", re.IGNORECASE,
)
_HOLDER = re.compile(r"\W*copyright\b\W*(\w+)", re.IGNORECASE)
# What licence texts say after the word "copyright", where a line may break.
NO_HOLDERS = {
    "act", "and", "as", "claim", "claims", "disclaimer", "for", "have", "headers", "holder", "holders",
    "in", "information", "interest", "interests", "is", "law", "laws", "license", "licenses", "licence",
    "licences", "notice", "notices", "of", "on", "or", "owner", "owners", "permission", "permissions",
    "protection", "related", "right", "rights", "similar", "statement", "statements", "status", "that",
    "the", "this", "to", "treaty", "which",
}
_WORD = re.compile(r"\w+")

# Title lines, as words; a text that is nothing else keeps them.
TITLES = {
    "mit", "mit license", "the mit license", "the mit license mit", "mit license mit",
    "mit expat license", "expat license", "isc", "isc license", "the isc license", "isc license isc",
    "the isc license isc", "bsd license", "the bsd license", "bsd 2 clause license", "the bsd 2 clause license",
    "bsd 2 clause simplified license", "simplified bsd license", "bsd 3 clause license",
    "the bsd 3 clause license", "bsd 3 clause new or revised license", "new bsd license",
    "modified bsd license", "zlib license", "the zlib license", "the unlicense", "unlicense",
    "bsd zero clause license", "zero clause bsd", "0bsd",
}

#: Words that have to agree before a run of lines is digested.
_FIRST = 3


def _is_copyright(line: str) -> bool:
    if _COPYRIGHT.match(line):
        return True
    holder = _HOLDER.match(line)
    return bool(holder) and holder[1][0].isupper() and holder[1].lower() not in NO_HOLDERS


def _line_words(text: str) -> list[list[str]]:
    """Canonical words of each line; copyright lines and titles before the text have none."""
    lines = []
    for line in text.split("\n"):
        words = [] if _is_copyright(line) else _WORD.findall(line.lower())
        lines.append(" ".join([SPELLINGS.get(w, w) for w in words]).split(" ") if words else [])
    filled = [n for n, words in enumerate(lines) if words]
    titles = list(itertools.takewhile(
        lambda n: len(lines[n]) < 8 and " ".join(lines[n]) in TITLES, filled
    ))
    if len(titles) < len(filled):
        for n in titles:
            lines[n] = []
    return lines


def canonical(text: str) -> str:
    """Words in lower case and one spelling; copyright lines, titles, punctuation and space are gone."""
    return " ".join([w for line in _line_words(text) for w in line])


def _digest(words: list[str]) -> bytes:
    return hashlib.sha256(" ".join(words).encode("utf-8", "replace")).digest()


def digest(text: str) -> bytes | None:
    """Digest of the canonical text; none if nothing is left."""
    plain = canonical(text)
    return _digest(plain.split(" ")) if plain else None


def known_texts() -> dict[str, list[str]]:
    """``KNOWN`` and the texts in ``license_texts``; ``LICENSE_TEXTS`` names a folder of further ones.

    A file ``NAME.txt`` holds one text of the licence ``NAME``, or several with lines ``%%`` between.
    """
    out = {name: list(texts) for name, texts in KNOWN.items()}
    folders = [os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")]
    for folder in [*folders, *filter(None, [os.environ.get("LICENSE_TEXTS")])]:
        for name in sorted(os.listdir(folder)):
            if name.endswith(".txt"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    out.setdefault(name.removesuffix(".txt"), []).extend(f.read().split("\n%%\n"))
    return out


def _digests(known: dict[str, list[str]]) -> dict[bytes, set[str]]:
    out: dict[bytes, set[str]] = {}
    for name, texts in known.items():
        for text in texts:
            if d := digest(text):
                out.setdefault(d, set()).add(name)
    return out


def known_digests(spark: SparkSession, known: dict[str, list[str]] = KNOWN) -> DataFrame:
    """``(digest, license)``; its size is that of the table above, so it may be broadcast."""
    rows = {(d, name) for d, names in _digests(known).items() for name in names}
    return spark.createDataFrame(sorted(rows), "digest binary, license string")


def _runs(lines: list[list[str]], starts: dict[tuple, list[int]]) -> Iterator[tuple[int, int, list[str]]]:
    """First line, number of lines and words of the runs of lines that begin as a known text does
    and have as many words, longest first.  A run of all words is left out, it is the whole text."""
    words = [w for line in lines for w in line]
    ends, total = {}, 0
    for n, line in enumerate(lines):
        total += len(line)
        if line:
            ends[total] = n
    at = 0
    for n, line in enumerate(lines):
        if line:
            for size in starts.get(tuple(words[at:at + _FIRST]), ()):
                last = ends.get(at + size)
                if last is not None and last > n and size < total:
                    yield n, last - n + 1, words[at:at + size]
        at += len(line)


def units(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    known: dict[str, list[str]] = KNOWN,
) -> DataFrame:
    """``(doc_id, line, digest)``: the whole text (line null), each of several lines, and the runs of
    lines that may be a known text (line is the first one; of runs and lines that begin at one line
    and are the same licence the longest counts)."""
    names = _digests(known)
    starts: dict[tuple, set[int]] = {}
    for texts in known.values():
        for words in (canonical(t).split(" ") for t in texts):
            starts.setdefault(tuple(words[:_FIRST]), set()).add(len(words))
    longest = {k: sorted(v, reverse=True) for k, v in starts.items()}

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for i, text in zip(batch.column("id").to_pylist(), strings(batch.column("text")), strict=True):
                lines = _line_words(text)
                words = [w for line in lines for w in line]
                found = [(None, _digest(words))] if words else []
                if len(lines) > 1:
                    said: dict[int, set[str]] = {}
                    for n, _, part in _runs(lines, longest):
                        d = _digest(part)
                        if names.get(d, set()) - said.get(n, set()):
                            said.setdefault(n, set()).update(names[d])
                            found.append((n, d))
                    for n, line in enumerate(text.split("\n")):
                        # a title line alone is a unit too
                        if (own := lines[n]) or line.strip():
                            d = _digest(own) if own else digest(line)
                            if d and not (n in said and names.get(d, set()) & said[n]):
                                found.append((n, d))
                for n, d in found:
                    for column, v in zip(out, (i, n, d), strict=True):
                        column.append(v)
            yield dict(zip(("doc_id", "line", "digest"), out, strict=True))

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    return map_rows(rows, run, "doc_id long, line int, digest binary")


def license_matches(
    docs: DataFrame, known: dict[str, list[str]] | None = None, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(doc_id, line, license)`` for every whole text, line or run of lines that is a known text.

    ``known`` are the texts of ``known_texts`` if not given.  Null and empty texts and those of
    copyright lines only match nothing; repeated rows give repeated matches.  The corpus is not
    shuffled.
    """
    known = known_texts() if known is None else known
    table = F.broadcast(known_digests(docs.sparkSession, known))
    found = units(docs, id_column, text_column, known).join(table, "digest")
    return found.select("doc_id", "line", "license")
