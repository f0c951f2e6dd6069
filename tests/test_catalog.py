import pytest
from conftest import SF_SMALL

import __spark_entry__ as contract
import catalog.oracle
import catalog.queries
from check_oracle import compare, duck

MODELS = {
    "test_predictions", "feature_importance", "model_comparison", "model_improvement",
    "future_forecast", "arima_forecast", "arima_metrics",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_twin_but_the_models():
    assert set(catalog.queries.queries()) - set(catalog.oracle.oracle_sql()) == MODELS
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracle.oracle_sql()))
def test_equal_to_sql(spark, con, name):
    assert compare(spark, con, name, SF_SMALL) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert "abc_class" in df.columns and df.count() == 25
