"""Registered queries against their SQL checks, every one of them."""

import inspect

import pytest

from tabwork.plans.catalogue import ORACLE, QUERIES
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


def test_anova_over_many_groups(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(QUERIES["anova_many_groups"](spark, sf), connect(sf), ORACLE["anova_many_groups"]) is None


@pytest.mark.parametrize("name", ["anova_over_quartiles", "anova_alike_groups", "tests_without_variance", "ttest_by_group_vs_overall", "describe_approximate_quartiles", "kmeans_fit_planted", "kmeans_elbow_planted"])
def test_whole_results_match_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", ["kmeans_elbow", "kmeans_scaled_vs_raw", "customer_clusters", "kmeans_fit_planted"])
def test_queries_fit_with_all_restarts(name):
    assert "restarts" not in inspect.getsource(QUERIES[name])
