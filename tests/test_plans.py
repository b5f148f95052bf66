"""Physical-plan properties the scale design relies on."""

import contextlib
import io
import re

import pytest

from tastemap.plans import QUERIES
from tests.conftest import SF_SMALL

MODEL_QUERIES = {"als_rmse", "als_predictions", "als_recommend_all", "als_recommend_users",
                 "als_similar_items", "biased_mf_rmse", "biased_mf_predictions",
                 "biased_mf_recommend", "serve_requests", "als_tuning_report",
                 "biased_mf_tuning_report", "sgd_mf_rmse", "sgd_tuning_report"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(fn(spark, SF_SMALL)) for name, fn in QUERIES.items() if name not in MODEL_QUERIES}


def test_no_cartesian_products(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name


def test_columns_pruned(plans):
    for name in ("top_reviewed", "user_count", "rating_histogram"):
        assert "l_extendedprice" not in plans[name] and "o_totalprice" not in plans[name], name


def test_not_in_has_no_null_aware_broadcast(plans):
    for name, p in plans.items():
        assert not re.search(r"LeftAnti, Build\w+, (false, )?true", p), name
    assert "LeftAnti" in plans["unrated_items_not_in"]


def test_ratings_reduced_per_item_before_join(plans):
    for name in ("top_reviewed", "top_rated", "most_rated_left", "most_rated_inner"):
        assert "partial_count(rating" in plans[name], name
    assert "TakeOrderedAndProject" in plans["top_reviewed"]


def test_per_group_top_k_is_limited_before_the_shuffle(plans):
    assert "WindowGroupLimit" in plans["similar_by_genres"]
    # the scorer's lists are final when they leave its tasks: no ranking follows at all
    assert "Window" not in plans["similar_by_factors"] and "MapInArrow" in plans["similar_by_factors"]


def test_user_history_sorts_without_a_per_user_window(plans):
    assert "Window" not in plans["user_history"]
    assert "Sort [userId" in plans["user_history"]


def test_model_queries_have_no_cartesian_products(spark):
    for name in sorted(MODEL_QUERIES - {"als_tuning_report", "biased_mf_tuning_report", "sgd_tuning_report"}):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name
