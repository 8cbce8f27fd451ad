"""Every registered query against DuckDB, and what its plan may not hold."""

import importlib.util
import os
from pathlib import Path

import oracle
import pytest

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
PATH = Path(__file__).resolve().parents[1] / "__spark_entry__.py"
SPEC = importlib.util.spec_from_file_location("spark_entry", PATH)
ENTRY = importlib.util.module_from_spec(SPEC)
SPEC.loader.exec_module(ENTRY)
OWN = sorted(set(ENTRY.queries()) - set(ENTRY.LLM_QUERIES))

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, connection, name):
    df = ENTRY.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "MapInPandas" not in plan
    assert "Exchange SinglePartition" not in plan or "agg" in plan.lower()
    assert oracle.difference(df, connection, ENTRY.oracle_sql()[name]) is None


def test_every_query_has_an_oracle():
    assert set(OWN) == set(ENTRY.oracle_sql()) - set(ENTRY.LLM_ORACLES)


def test_entry(spark):
    assert ENTRY.entry(spark).count() > 0
