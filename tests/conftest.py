import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from spanloom import schema, session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.local_session(
        8, "tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def make_spans(spark):
    """Spans from dictionaries; absent fields are null, tags and annotations empty."""

    def make(*rows):
        full = [
            tuple(
                {"tags": {}, "annotations": [], **row}.get(field) for field in schema.SPAN_FIELDS
            )
            for row in rows
        ]
        return spark.createDataFrame(full, schema.SPAN)

    return make
