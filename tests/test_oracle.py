"""Every query with an oracle matches DuckDB on sf0.001; the rest run."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from essayspark.plans import catalogue
from oracle_harness import compare, duck

NAMES = sorted(catalogue.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    line = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF001)
    assert line.startswith("OK") or line.startswith("ROWS-ONLY"), line


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "essay_set" in df.columns
