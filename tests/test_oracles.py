"""Every registered query against its DuckDB oracle, on the smallest driver tables."""

from pathlib import Path

import pytest

from check_oracles import compare, connect
from __spark_entry__ import corpus_queries, entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


#: Queries of the optional subpackage have tests of their own.
OWN = [n for n in queries() if n not in corpus_queries()[0]]


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", OWN)
def test_query_agrees_with_its_oracle(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) == ""


def test_entry(spark):
    assert entry(spark).count() > 0
