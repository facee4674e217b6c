"""Every registered query against its SQL, and the shape of the registry."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from lakeops.catalog import ORACLES, QUERIES

WITHOUT_SQL = {"fraud_scores", "churn_risk_bands"}


def test_registry():
    assert set(entry.queries()) >= set(QUERIES)
    assert set(entry.oracle_sql()) >= set(QUERIES) - WITHOUT_SQL


def test_entry_runs(spark, small):
    out = entry.entry(spark)
    assert out.columns == ["region", "year_num", "month_num", "freight"]
    assert out.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    assert differences(QUERIES[name](spark, small), connect(small), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
