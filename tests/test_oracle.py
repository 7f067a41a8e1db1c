"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entrypoint
from crosscheck.compare import difference
from crosscheck.oracle import ORACLE
from crosscheck.queries import QUERIES

from .conftest import SMALL


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_twin(spark, connection, name):
    result = QUERIES[name](spark, SMALL)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Python", "CartesianProduct", "NestedLoopJoin"))
    assert difference(result, connection, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert entrypoint.entry(spark).count() > 0
