"""Corpus queries against their SQL in DuckDB."""

import importlib.util
from pathlib import Path

import pytest

from gaugeworks.llm import queries

_SPEC = importlib.util.spec_from_file_location("oracle", Path(__file__).parent.parent / "oracle.py")
oracle = importlib.util.module_from_spec(_SPEC)
_SPEC.loader.exec_module(oracle)

DIRECTORY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, DIRECTORY)
    assert oracle.compare(oracle.connect(DIRECTORY), df, queries.SQL[name]) is None
