"""Queries that SQL can express, against DuckDB."""

import pytest

import oracle
from netfeat.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, sf, name):
    problems, n_spark, n_duck = oracle.compare(spark, oracle.duck(sf), name, QUERIES[name], ORACLE_SQL[name], sf)
    assert not problems, problems
    assert n_spark == n_duck
