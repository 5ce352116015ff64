import os
import textwrap

import pytest

from spanloom.llm import licenses

ISC = """ISC License

Copyright (c) 2004-2013 Some Body

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""


def found(rows, **options):
    return sorted((tuple(r) for r in licenses.license_matches(rows, **options).collect()), key=str)


def test_published_layouts_above_and_around_other_text(make_docs):
    mit = "The MIT License (MIT)\n\nCopyright Some Body\n\n" + textwrap.dedent(licenses.KNOWN["MIT"][2])
    header = "\n".join(" * " + x for x in textwrap.wrap(licenses.KNOWN["Apache-2.0"][2], 60))
    rows = [
        (1, ISC), (2, mit), (3, "Read me\n\n" + ISC + "\nMore text follows.\n"),
        (4, "/*\n * Copyright 2020 Some Body\n *\n" + header + "\n */\nint main() {}\n"),
        (5, ISC.replace("FITNESS", "SOMETHING ELSE")), (6, "x\r\n" + mit.replace("\n", "\r\n")),
    ]
    assert found(make_docs(*rows)) == [
        (1, None, "ISC"), (2, None, "MIT"), (3, 6, "ISC"), (4, 3, "Apache-2.0"), (6, 5, "MIT"),
    ]


def test_line_breaks_do_not_matter():
    body = " ".join(ISC.split("\n\n", 2)[2].split())
    assert len({licenses.digest("\n".join(textwrap.wrap(body, n))) for n in range(20, 120)}) == 1
    assert licenses.canonical("Copyright Some Body\n(c) 2001 X\n© Y\nCopyright (C) [yyyy] Z") == ""
    assert licenses.canonical("copyright notice\ncopyrighted work\nCOPYRIGHT HOLDERS BE") != ""


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0",
                                  "BSD-2-Clause", "BSD-3-Clause", "Zlib", "MIT", "ISC"])
def test_full_texts(make_docs, name):
    text = licenses.known_texts()[name][-1]
    assert found(make_docs((1, text), (2, "Before.\n" + text + "\nAfter."))) == [(1, None, name), (2, 1, name)] or \
        {(d, x) for d, _, x in found(make_docs((1, text), (2, "Before.\n" + text)))} == {(1, name), (2, name)}


def test_texts_of_a_user(make_docs, tmp_path, monkeypatch):
    (tmp_path / "House-1.txt").write_text("House terms\napply here.\n%%\nOther house terms.")
    monkeypatch.setenv("LICENSE_TEXTS", str(tmp_path))
    assert os.listdir(tmp_path) and found(make_docs((1, "a\nhouse terms apply\nhere\nb"), (2, "Other house terms"))) == [
        (1, 1, "House-1"), (2, None, "House-1"),
    ]
    assert found(make_docs((1, "a\nown\nwords here")), known={"Own": ["own words here"]}) == [(1, 1, "Own")]
