import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnwright.session import ROWS_PER_CHUNK_KEY, local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session("8", app="tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def many_chunks(spark):
    """Force the chunked and bracketed paths on small data."""
    spark.conf.set(ROWS_PER_CHUNK_KEY, "40")
    yield spark
    spark.conf.unset(ROWS_PER_CHUNK_KEY)


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
