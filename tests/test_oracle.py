"""Every query with an oracle against DuckDB, exact to type and value."""

import pytest

import __spark_entry__ as driver
from oracle import connect, difference
from conftest import TESTDATA

FOLDER = TESTDATA / "sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = driver.queries()[name](spark, str(FOLDER))
    assert difference(df, con, driver.oracle_sql()[name]) is None


def test_every_oracle_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    report = driver.entry(spark)
    assert report.columns[:3] == ["cluster", "segment_name", "size"]
    assert sum(r["size"] for r in report.collect()) == 150
