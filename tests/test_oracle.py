"""Every registered query with a SQL equivalent agrees with it cell by cell."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from stockweave.plans.oracle import oracle_sql
from stockweave.plans.queries import queries

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_sql_text_belongs_to_a_query():
    assert set(ORACLE) <= set(queries()) <= set(contract.queries())


def test_only_models_lack_sql():
    assert set(queries()) - set(ORACLE) == {
        "demand_forecast", "churn_scores", "churn_accuracy",
        "anomaly_orders", "anomaly_sample",
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, small, con, name):
    assert difference(queries()[name](spark, small), con, ORACLE[name]) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert "value_segment" in df.columns and df.count() == 150
