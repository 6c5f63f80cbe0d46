"""Every registered query against its SQL."""

from __future__ import annotations

import re

import oracle
import pytest

from hourline.workload import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Nothing in Python, no pairing of everything with everything, no window in a single task.
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search(r"windowspecdefinition\(\w+#\d+L? (ASC|DESC)", plan)
    problem = oracle.difference(df, con, ORACLES[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
