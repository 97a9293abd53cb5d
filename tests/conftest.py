import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mart_helpers import SF0001  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from tidemart.session import build_session
    s = build_session("local[*]", app="tidemart-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def landing_small(spark):
    from tidemart.plans.landing import Landing
    return Landing.from_fixtures(spark, SF0001)
