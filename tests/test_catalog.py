"""Every registered query against its SQL, and what its plan must not contain."""

import re

import pytest
from compare import difference, sql_connection

import __spark_entry__ as entry_point
from catalog import all_names
from catalog.registry import ORACLE, runner

QUERIES = {name: runner(name) for name in all_names()}

# Empty on the smallest data, where no customer or route meets the condition.
MAY_BE_EMPTY = {"k27_pending"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return sql_connection(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, con, ORACLE[name]) in ((None, "empty") if name in MAY_BE_EMPTY else (None,))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # No pairs of everything, no Python in the rows, nothing gathered in one task to be ranked.
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython", plan)
    assert not re.search(r"Window \[.*windowspecdefinition\((0, )?specifiedwindowframe", plan)
