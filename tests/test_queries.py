"""Every registered query against its SQL, and what its plan must not contain."""

import pathlib

import pytest

import __spark_entry__ as entry_point
import oracle
from assayline.samples import catalog as samples

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry_point.oracle_sql()
# queries of the optional subpackage have tests of their own
QUERIES = {name: query for name, query in entry_point.queries().items() if name in samples.QUERIES}

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(samples.ORACLES)
    assert set(ORACLES) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    rows, difference = oracle.compare(df, con, ORACLES[name])
    assert difference is None
    assert rows > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
