import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from larder.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="larder-tests")
    yield s
    from larder.session import clear_scratch
    clear_scratch(s)
    s.stop()


INV_SCHEMA = ("SnapshotInvID long, ProductID long, ProductName string, WarehouseLocation string, "
              "unitsAvailable double, unitsDemanded double, SnapshotDate date")


@pytest.fixture
def inv(spark):
    def make(rows):
        return spark.createDataFrame(rows, INV_SCHEMA)
    return make
