"""Every registered catalogue query equals its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from cinemetric import registry
from tests.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.all_queries())


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF, con)
    assert ok, msg


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(entry.oracle_sql())
    assert not missing


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["movie_id", "title", "released_date", "popularity", "runtime", "overview", "avg_rating",
                          "num_ratings", "genres"]
