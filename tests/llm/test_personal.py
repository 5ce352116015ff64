import random
import re

import duckdb
import pytest

import checker
from spanloom.llm import catalog, oracle, personal


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def digits_of(text):
    return re.sub(r"[^0-9]", "", text)


def brute(text):
    """The base kinds by plain patterns."""
    text = text or ""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [
        (1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]
    out += [
        (2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
        if 13 <= len(digits_of(m[0])) <= 19 and luhn(digits_of(m[0]))
    ]
    out += [
        (3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
        if 9 <= len(digits_of(m[0])) <= 15
    ]
    return sorted(out)


TEXTS = [
    None, "", "a@b.c@d.e f..%+-@-.-.. x@y", "@", "a@", "a@b", "é🙂 a.b@mail.example.com, x@@y.z", "a@b..c d@e.f.",
    "1.2.3.4.5.6.7.8.9 256.1.1.1 0255.001.0.00000 1..2.3.4 1.2.3", "4111 1111-1111 1111 and 4111  1111 1111 1111",
    "4111111111111111.4111111111111111 4111111111111112 0000000000000 00000000000000000000", "１２３４ ٤٥٦",
    "+1 (234) 567-8901 +12 +1( +1-2 +123456789012345 +1234567890123456 ++1 23 45 67 89 +1)...2345678 9- x",
    "x" * 50_000 + "long@tail.example " + "1" * 30_000 + " 10.0.0.1" + ".7" * 9_000, "a@b.c" * 2000,
    "K account account 12345 ACCOUNT#=:99-88-77- myaccount 123456 ssn: 123-45-6789 ssn 12345 iban GB82WEST12345698765432",
    "iban GB83WEST12345698765432 Tax ID  : 1234567 acct     1234567 acct: 1234-account 99999a passport:-123456",
    "sftp://u:p@h.example. http://a@ https://x@-.- ftp://host/x@y http://http://u@h HTTP://me@h shttp://m@n ssh://a@b@c",
]


def test_base_spans_are_brute_force(make_docs, clashing):
    docs = clashing(make_docs(*enumerate(TEXTS), (3, TEXTS[2]), (None, TEXTS[2])))
    assert not brute(TEXTS[3])
    found = personal.find(docs).collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        text = TEXTS[2] if r.id is None or (r.id == 3 and r.spans) else TEXTS[r.id]  # 3 comes twice
        assert [(s.kind, s.start, s.end) for s in r.spans if s.kind < 4] == brute(text)
    assert personal.find(docs.limit(0)).count() == 0


def test_base_spans_of_random_texts():
    automaton, rng = personal.anchors(), random.Random(7)
    alphabet = ["a", "Z", ".", ".", "@", "@", "-", "+", "+", " ", "(", ")", "%", "0", "1", "25", "256", "4111", "é", "\n", "://"]
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
        assert [s for s in personal.spans(text, automaton) if s[0] < 4] == brute(text), text


def test_cues_and_schemes():
    automaton = personal.anchors()

    def found(text):
        return [(personal.KINDS[k], text[a:b]) for k, a, b in personal.spans(text, automaton) if k > 3]

    assert found(TEXTS[15]) == [
        ("account", "99-88-77"), ("account", "123-45-6789"), ("account", "GB82WEST12345698765432"),
    ]
    assert found(TEXTS[16]) == [("account", "1234567"), ("account", "1234-account"), ("account", "99999a")]
    assert found(TEXTS[17]) == [
        ("login", "sftp://u:p@h.example"), ("login", "http://u@h"), ("login", "HTTP://me@h"),
        ("login", "http://m@n"), ("login", "ssh://a@b"),
    ]


def test_query_equals_sql_on_odd_texts(spark, make_docs, tmp_path):
    make_docs(*enumerate(TEXTS)).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    found = catalog.queries()["op12_personal"](spark, str(tmp_path))
    assert checker.compare(found, con, oracle.oracle_sql()["op12_personal"]) is None


@pytest.mark.parametrize("digits,right", [(b"4111111111111111", True), (b"4111111111111112", False), (b"0", True)])
def test_luhn(digits, right):
    assert personal.luhn(digits) is right
