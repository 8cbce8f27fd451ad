"""Registered queries that SQL can express, against DuckDB."""

import os

import oracle
import pytest

from oreflow.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert oracle.difference(QUERIES[name](spark, FOLDER), oracle.connect(FOLDER), ORACLES[name]) is None
