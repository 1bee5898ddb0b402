"""Every registered query against its SQL text in DuckDB."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from somnolake.checks.oracles import ORACLES as SQL
from somnolake.checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(small):
    with connect(small) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(name, spark, small, duck):
    assert difference(QUERIES[name](spark, small), duck, SQL[name]) is None


def test_entry_is_the_comorbidity_mart(spark):
    rows = driver.entry(spark)
    assert "all_three_rate_pct" in rows.columns
    assert rows.count() == 6
