"""Physical plans: what must and must not be in them."""

import os

import pytest
from pyspark.sql import functions as F

from cantora.plans import catalog_checks, operator_checks
from cantora.plans.model import Model

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {**catalog_checks.queries(), **operator_checks.queries()}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_rows_without_a_key(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_album_ranking_prunes_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["q17"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["q09", "q12", "q13", "q15", "q16", "q20", "q21", "q22", "q23", "q24"])
def test_top_k_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


def test_scans_read_only_what_is_used(spark):
    text = plan(QUERIES["q08"](spark, SF_DIR))
    assert "o_totalprice" not in text and "c_acctbal" not in text
    assert "PushedFilters: [" in text and "EqualTo(o_orderstatus,F)" in text


def test_a_metric_filter_is_not_evaluated_twice(spark):
    m = Model(spark, SF_DIR)
    text = plan(m.lyrics("readability_score").where(F.col("readability_score") < 50))
    assert text.count("regexp_count") <= 8 and "Generate explode" in text


def test_python_runs_only_for_the_similarity_ratio(spark):
    for name, fn in QUERIES.items():
        uses_python = "Python" in plan(fn(spark, SF_DIR))
        assert uses_python == (name in ("a19_match_audit", "c4_fuzzy", "c5_match")), name
