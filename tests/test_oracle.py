"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import pytest

import compare
from __spark_entry__ import entry
from qaloom.plans.registry import ORACLE, QUERIES

# queries that call a Python function: a caller's generator or a per-key state
PYTHON = {"generate", "generate_with_retry"}
# these write a table first, so their plan is the reading of it
EAGER = {"health_stream", "chat_stream", "clean_stream", "stateless_stream", "new_only_stream"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connection(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, sf_dir, con, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 1 and rows[0]["verdict"] in {"EXCELLENT", "GOOD", "MODERATE", "POOR"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    python = any(node in plan for node in ("MapIn", "ArrowEvalPython", "BatchEvalPython"))
    assert python == (name in PYTHON)
