"""One Spark session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillspark.session import build_session  # noqa: E402


SESSION = build_session("8", "tests", partitions=4)  # column expressions need one at import
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def value(spark):
    """Evaluate one expression over one text."""

    def run(text, expression):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(expression.alias("v")).first()["v"]

    return run
