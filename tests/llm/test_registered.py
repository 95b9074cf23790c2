"""Registered queries next to their DuckDB SQL, on the smallest tables."""

import pytest
from check_oracles import compare, connect

from tripmill.llm.oracle_sql import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_its_oracle(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) == ""
