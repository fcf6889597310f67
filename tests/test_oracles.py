"""Every registered query against its DuckDB oracle, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle

SF = os.environ.get("NETFEAT_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF)


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, n_spark, n_duck = oracle.compare(
        spark, con, name, entry.QUERIES[name], entry.oracle_sql()[name], SF
    )
    assert not problems, problems
    assert n_spark == n_duck


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["EXT_ENTITYID", "VINTAGE_DT"]
    assert len(df.columns) == 2 + 8 * 3
