"""Every registered query against its SQL, at the smallest scale."""

import pytest
from check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    same, text = compare(spark, con, SF, name)
    assert same, text


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    # 1000 events, two of them replaced by a later one of the same user and minute
    assert df.count() == 998
    assert "nom_ville" in df.columns
