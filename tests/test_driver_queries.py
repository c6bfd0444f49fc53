"""Every registered query against its DuckDB statement."""

from __future__ import annotations

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_each_query_has_a_statement():
    assert set(driver.QUERIES) <= set(driver.oracle_sql())


def test_flagship(spark):
    rows = driver.entry(spark).collect()
    assert [r["priority_rank"] for r in rows] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, FOLDER)
    columns, expected = duck_rows(con, driver.oracle_sql()[name])
    assert sorted(df.columns) == columns
    assert spark_rows(df) == expected


LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", [n for n in sorted(driver.QUERIES) if n.startswith(("live_", "stream_"))])
def test_stream_query_over_more_rows(spark, name):
    """Streams meet repeats of unscored readings, and late ones, only in larger tables."""
    columns, expected = duck_rows(duck(LARGER), driver.oracle_sql()[name])
    assert spark_rows(driver.queries()[name](spark, LARGER)) == expected
