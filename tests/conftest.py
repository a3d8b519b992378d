import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("EMPORIUM_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from emporium.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app="emporium-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def shared_context(spark, sf_dir):
    """One build context for all registered queries: the order grain is written once."""
    from emporium.plans import catalog
    from emporium.plans.context import Ctx
    own, built = Ctx(spark, sf_dir), catalog.Ctx
    catalog.Ctx = lambda s, d: own if (s, d) == (spark, sf_dir) else built(s, d)
    yield own
    catalog.Ctx = built
