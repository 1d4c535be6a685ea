"""Every registered query on whole small tables against DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from conftest import SF
from workload import runs

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(SQL) & set(runs.queries())))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF, QUERIES[name], SQL[name]) == ""


def test_random_samples_have_the_granted_rows(spark):
    assert sorted(set(runs.queries()) - set(SQL)) == [
        "block_sample", "random_sample", "random_sample_scaled",
    ]
    assert QUERIES["random_sample"](spark, SF).count() == 288
    assert QUERIES["random_sample_scaled"](spark, SF).count() == 2304
    assert 0 < QUERIES["block_sample"](spark, SF).count() <= 288


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["table_id", "row_id", "row_part", "row_digest"]
