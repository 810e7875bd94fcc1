"""Every registered query against its SQL, and the shape of the plans."""

import pytest

from conftest import TESTDATA
from oracle_check import compare, connect
from workload import ORACLES, QUERIES
from workload.registry import COVERS

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="no test tables")

# Operators of the inventory that only exist as Python calls or are shown by tests.
ELSEWHERE = {"D2", "A5"}


@pytest.fixture(scope="module")
def con():
    return connect(str(TESTDATA))


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    frame = QUERIES[name](spark, str(TESTDATA))
    if name in ORACLES:
        assert compare(frame, con, ORACLES[name]) == ""
    else:
        assert frame.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cartesian_product(spark, name):
    plan = QUERIES[name](spark, str(TESTDATA))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_every_operator_is_covered():
    covered = {c for ids in COVERS.values() for c in ids.split()} | ELSEWHERE
    groups = {"S": 13, "F": 16, "N": 15, "U": 12, "J": 11, "T": 8, "A": 9, "L": 5, "O": 4, "V": 7, "D": 11, "Q": 5, "R": 3}
    wanted = {f"{g}{i}" for g, n in groups.items() for i in range(1, n + 1)}
    assert wanted - covered == set()
