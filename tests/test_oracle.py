"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

from checks.compare import compare, connect
from checks.oracle import oracle_sql
from checks.registry import QUERIES

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, connection, sf_dir, name):
    assert compare(spark, connection, sf_dir, name, ORACLE[name]).startswith("ok")
