import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from slicewright.session import build_session

    ckpt = tempfile.mkdtemp(prefix="slicewright-test-")
    s = build_session("local[4]", 8, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from slicewright.sources.catalog import fixture_tables

    return fixture_tables(spark, SF_SMALL)
