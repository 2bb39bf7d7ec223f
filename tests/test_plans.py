"""The plans the operators should get, and the registered queries against their SQL."""

import re

import pytest

import oracle
from tidemark.operators import clustering, recommend, salary
from tidemark.sources import adapters

DATA = "/root/testdata/sf0.001"
ENTRY = oracle.load_entry()
# These fit models; the other tests cover their operators.
SLOW = {"als_predict", "als_metrics", "kmeans_checks", "kmeans_report_16", "bisecting_report_8", "bisecting_report_16"}


@pytest.fixture(scope="module")
def con():
    return oracle.duck(DATA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in ENTRY.queries() if n not in SLOW])
def test_registered_query(spark, con, name):
    ok, message, _ = oracle.compare(spark, con, DATA, ENTRY.queries()[name], ENTRY.oracle_sql().get(name))
    assert ok, message
    assert "types differ" not in message


def test_every_oracle_has_its_query(spark):
    assert set(ENTRY.oracle_sql()) <= set(ENTRY.queries())
    assert ENTRY.entry(spark).count() > 0


LAZY = ["salary_stats", "salary_count_total", "salary_sum", "valid_salary", "term_counts",
        "bloom_replay", "exact_seen", "reservoir_sample", "reservoir_snapshot", "bloom_probe", "top_tags"]


@pytest.mark.parametrize("name", LAZY)
def test_no_products_and_no_row_python(spark, name):
    text = plan(ENTRY.queries()[name](spark, DATA))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


def test_scans_read_only_what_they_need(spark):
    text = plan(ENTRY.queries()["salary_count_total"](spark, DATA))
    assert "o_orderdate" not in text and "c_acctbal" not in text
    text = plan(adapters.ratings(spark, DATA))
    assert "l_extendedprice" not in text


def test_statistics_take_one_aggregation(spark):
    annual = spark.createDataFrame([("a", 1.0)], "country string, annual double")
    text = plan(salary.salary_stats(annual))
    assert len(re.findall(r"Exchange hashpartitioning\(country", text)) == 1


def test_sums_are_partial_before_they_move(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    text = plan(salary.sum_by_group(df, "k", "v", partitions=3))
    assert "partial_sum" in text


def test_subtraction_is_an_anti_join(spark):
    df = spark.createDataFrame([("a", "b", 1.0)], "user string, item string, rating double")
    assert "LeftAnti" in plan(recommend.subtract_pairs(df, df))


def test_top_terms_are_cut_before_the_shuffle(spark):
    terms = spark.createDataFrame([(0, 1, "x", 1)], "cluster int, doc_id bigint, term string, tf bigint")
    assert plan(clustering.top_terms(terms)).count("WindowGroupLimit") == 2
