import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from riskforge.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="riskforge-tests", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def build(spark):
    from riskforge.plans.build import Build

    return Build.from_testdata(spark, SMALL, audit=False)
