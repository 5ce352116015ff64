import pytest

from spanloom.llm import common

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) pairs or (id, text, source) triples."""
    common.prepare(spark)

    def make(*rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture
def clashing():
    """Columns named like those the operators use inside."""

    def add(df):
        from pyspark.sql import functions as F

        names = ["id", "row", "fp0", "part", "owner", "_id", "anchor_id", "label", "seed"]
        return df.withColumns({n: F.lit("x") for n in names})

    return add
