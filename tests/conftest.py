import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from itemrank.session import local_session

    s = local_session("*", 8, app="itemrank-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from itemrank.plans.tables import Tables

    return Tables(spark, SF_SMALL)
