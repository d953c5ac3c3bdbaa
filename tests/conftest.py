import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cinemetric.session import build_session

    # checkpoint folder: the configured spark.checkpoint.dir, or a fresh scratch one if unset
    s = build_session("local[8]", 8, app_name="cinemetric-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def cat(spark):
    from cinemetric.sources.catalogue import Catalogue

    return Catalogue(spark, SF_SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cinemetric-test-")
