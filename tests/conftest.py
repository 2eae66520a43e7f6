import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kymo.plans import lanes  # noqa: E402
from kymo.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", "kymo-tests", partitions=4)


@pytest.fixture(params=["whole", "lanes"])
def cutting(request, spark):
    """Run a test with plain windows, then with nearly every key cut into lanes."""
    if request.param == "lanes":
        spark.conf.set(lanes.HOT_ROWS_CONF, "3")
        spark.conf.set(lanes.LANE_ROWS_CONF, "2")
    yield request.param
    spark.conf.unset(lanes.HOT_ROWS_CONF)
    spark.conf.unset(lanes.LANE_ROWS_CONF)
