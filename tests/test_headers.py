import pytest
from pyspark.sql import functions as F

from spanloom.functions import headers

ROOT = "65f0c2aa00112233445566778899aabb"
ROOT_TEXT = "1-65f0c2aa-00112233445566778899aabb"
PARENT = "0f1e2d3c4b5a6978"
FULL = f"Root={ROOT_TEXT};Parent={PARENT};Sampled=1"

# forms built from the grammar: order, absent fields, other fields, each field malformed in turn
VECTORS = [
    (FULL, ROOT, PARENT, True, ""),
    (f"Parent={PARENT};Root={ROOT_TEXT};Sampled=0", ROOT, PARENT, False, ""),
    (f"Root={ROOT_TEXT};Sampled=1", ROOT, None, True, ""),
    (f"Root={ROOT_TEXT};Parent={PARENT};Sampled=?", ROOT, PARENT, None, ""),
    (f"Zone=b2;Self=1-65f0c2ab-bbaa99887766554433221100;  Root={ROOT_TEXT};  Hops=3",
     ROOT, None, None, ";Zone=b2;Hops=3"),
    (f"Root=3{ROOT_TEXT[1:]}", None, None, None, ""),
    (f"Root={ROOT_TEXT[:-2]}", None, None, None, ""),
    # a second root: cut off at the end, cut off with room behind it, with a wrong digit
    (f"Root={ROOT_TEXT};Root=1-7a", ROOT, None, None, ""),
    (f"Root={ROOT_TEXT};Root=1-7a;Sampled=1", ROOT, None, None, ""),
    (f"Root={ROOT_TEXT};Root=1-7a;Parent={PARENT};Sampled=1", None, None, None, ""),
    (f"Root={ROOT_TEXT};Root={ROOT_TEXT[:4]}x{ROOT_TEXT[5:]}", None, None, None, ""),
    (f"Root={ROOT_TEXT[:4]}g{ROOT_TEXT[5:]}", None, None, None, ""),
    ("no fields ✗ at all", None, None, None, ""),
    # read before the malformed part stays, what follows is ignored
    (f"Sampled=1;Root=bad;Parent={PARENT}", None, None, True, ""),
    # names match by prefix, spaces in names do not count
    (f"Ro ot={ROOT_TEXT}", ROOT, None, None, ""),
    (f"Rooted={ROOT_TEXT}", ROOT, None, None, ""),
    # a parent needs a root
    ("Parent=0f1e2d3c4b5a6978;Sampled=0", None, None, False, ""),
    ("Root=1-65f0c2aa-00112233445566778899aabb;Parent=7d3c19e5a04b62f", ROOT, None, None, ""),
    # a high half of zeros counts as absent
    ("Root=1-00000000-000000002345678912345678;Parent=0f1e2d3c4b5a6978", None, None, None, ""),
    # custom values keep spaces and equals signs; a name without value at the end says nothing
    (FULL + ";a= x =y ;b=", ROOT, PARENT, True, ";a= x =y "),
    ("a=;b=2", None, None, None, ";a=;b=2"),
    # text that is not a field joins the next name
    ("foo;Root=1-65f0c2aa-00112233445566778899aabb", None, None, None,
     ";foo;Root=1-65f0c2aa-00112233445566778899aabb"),
    ("Sampled=1 ;Parent=0f1e2d3c4b5a6978", None, None, True, ";;Parent=0f1e2d3c4b5a6978"),
    ("", None, None, None, ""),
    (FULL[:40], ROOT, None, None, ""),
    (FULL[:64], ROOT, PARENT, None, ""),
    (FULL[:73], ROOT, PARENT, None, ""),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, v[0]) for i, v in enumerate(VECTORS)]
    df = spark.createDataFrame(rows, "i int, header string")
    result = df.withColumn("p", headers.parse_trace_header(F.col("header"))).select("i", "p.*")
    return {r["i"]: tuple(r)[1:] for r in result.collect()}


@pytest.mark.parametrize("i", range(len(VECTORS)))
def test_vector(parsed, i):
    assert parsed[i] == VECTORS[i][1:], VECTORS[i][0]


def test_plain_form_is_only_a_shortcut(spark):
    plain = [FULL, FULL[:40], FULL[:64], FULL.replace("Sampled=1", "Sampled=?")]
    df = spark.createDataFrame([(h,) for h in plain], "h string")
    both = df.select(
        headers.parse_trace_header(F.col("h")).alias("a"), headers._read_any(F.col("h")).alias("b")
    ).collect()
    assert all(r["a"] == r["b"] for r in both)


def test_null_header_and_class(spark):
    df = spark.createDataFrame([(None,), (FULL,), (FULL[:40],), ("Sampled=1",)], "h string")
    parsed = headers.parse_trace_header(F.col("h"))
    rows = df.select(parsed.isNull(), headers.classify_trace_context(parsed)).collect()
    assert [tuple(r) for r in rows] == [
        (True, "flags"), (False, "context"), (False, "trace_id"), (False, "flags"),
    ]


def test_format_is_the_inverse_of_parse(spark):
    headers_in = [FULL, FULL.replace("Sampled=1", "Sampled=?"), FULL + ";Tenant=north-7"]
    df = spark.createDataFrame([(h,) for h in headers_in], "h string").withColumn(
        "p", headers.parse_trace_header(F.col("h"))
    )
    out = df.select(headers.format_trace_header(
        F.col("p.root"), F.col("p.parent"), F.col("p.sampled"), F.col("p.custom"))).collect()
    assert [r[0] for r in out] == headers_in


def test_passthrough_epoch_and_fields(spark):
    alb = VECTORS[4][0]
    df = spark.createDataFrame([(alb,), (alb[:60],), ("none",)], "h string")
    roots = [r[0] for r in df.select(headers.root_from_passthrough(F.col("h"))).collect()]
    assert roots == [ROOT_TEXT, None, None]
    one = spark.range(1).select(
        F.unix_seconds(headers.root_epoch(F.lit("58406520a006649127e371903a2de979"))),
        headers.custom_fields(F.lit(";a=1;b=x y")),
        headers.custom_fields(F.lit("")),
    ).first()
    assert tuple(one) == (0x58406520, {"a": "1", "b": "x y"}, None)
