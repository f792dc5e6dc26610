import sys
from contextlib import contextmanager
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from heldout.session import build_session

    session = build_session("local[*]", 8, "heldout-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck001():
    from oracle_check import duck_connection

    return duck_connection(SF001)


@contextmanager
def executed_plans(spark):
    """A list that afterwards holds the final physical plan of every query that
    ran inside, stored steps included."""
    store = spark._jsparkSession.sharedState().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    before = store.executionsCount()
    known = {store.executionsList().apply(i).executionId() for i in range(before)} if before else set()
    plans = []
    yield plans
    bus.waitUntilEmpty()
    every = store.executionsList()
    plans += [every.apply(i).physicalPlanDescription() for i in range(every.size())
              if every.apply(i).executionId() not in known]
