"""Every registered query with an oracle agrees with DuckDB on sf0.01."""

import pytest

from tastemap.plans import ORACLES, QUERIES
from tests.conftest import SF_ORACLE
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, con, name):
    res = compare(spark, name, QUERIES[name], ORACLES[name], SF_ORACLE, con)
    assert res["rows_spark"] == res["rows_duck"], res
    assert res["cols_ok"], res
    assert res["hash_ok"], res


def test_every_query_has_an_oracle_or_is_a_model_query():
    model_only = {"als_rmse", "als_predictions", "als_recommend_all", "als_recommend_users",
                  "als_similar_items", "biased_mf_rmse", "biased_mf_predictions",
                  "biased_mf_recommend", "serve_requests", "als_tuning_report",
                  "biased_mf_tuning_report", "sgd_mf_rmse", "sgd_tuning_report"}
    assert set(QUERIES) - set(ORACLES) == model_only
