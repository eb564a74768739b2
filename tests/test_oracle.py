"""Every registered query against its SQL in DuckDB, and the check against itself."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_module

from cubeloom.workload import ORACLES, QUERIES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_the_comparison_sees_a_wrong_value(spark, oracle, sf_dir):
    df = QUERIES["mart_entity"](spark, sf_dir)
    assert difference(df.limit(5), oracle, ORACLES["mart_entity"]) is not None
    wrong = ORACLES["mart_entity"].replace("SUM(", "1 + SUM(", 1)
    assert difference(df, oracle, wrong) is not None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, oracle, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, oracle, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
