"""Physical plans that must stay as they are for large tables."""

import os
import re

import pytest

from riskloom import views as v
from riskloom.operators import metrics as m
from riskloom.operators import selection as s
from riskloom.operators.quality import key_problems
from riskloom.plans import exploration as x
from riskloom.queries import QUERIES

DATA = os.environ.get("RISKLOOM_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan(frame).split("== Initial Plan ==")[0]


def test_facts_are_summed_before_the_join(spark):
    text = plan(x.rate_by_card_pair(v.card_partials(spark, DATA), 2, partials=True))
    join = text.index("Join")
    assert text.index("partial_count(1)") > join  # below the join in the tree
    assert "user_id" in text[text.index("Exchange hashpartitioning(user_id") :]


def test_a_report_reads_only_its_columns(spark):
    text = plan(x.rate_by_category(v.transactions(spark, DATA), 2))
    schema = text[text.index("ReadSchema: ") :].splitlines()[0]
    assert "user_id" not in schema and "ts:" not in schema


def test_daily_report_shuffles_days_not_rows(spark):
    text = plan(x.daily_rate(v.sales(spark, DATA), 2))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text


def test_top_n_is_one_ordered_take(spark):
    assert "TakeOrderedAndProject" in plan(x.top_domains_by_rate(v.transactions(spark, DATA), 2))


def test_a_missing_key_filter_reaches_the_scan(spark):
    text = plan(x.top_domains_by_rate(v.sales_by_order(spark, DATA, []), 2, 1, partials=True))
    assert "IsNotNull(l_orderkey)" in text


@pytest.mark.parametrize("buckets", [None, 8])
def test_areas_use_one_stored_histogram(spark, buckets):
    """The source is read for the histogram alone; only totals, one row per range, meet in one task."""
    text = final_plan(m.ranking_metrics(v.scores(spark, DATA), buckets=buckets))
    assert "FileScan" not in text and "hashpartitioning(bucket" in text
    windows = re.findall(r" Window .*", text)
    inside = [window for window in windows if re.search(r"\], \[bucket#\d+\], \[score", window)]
    starts = [window for window in windows if "total_tp" in window]
    assert len(windows) == 2 and len(inside) == 1 and len(starts) == 1


def test_exact_profile_scans_once(spark):
    documents = v.table(spark, DATA, "documents").select("lang", "source", "n_chars")
    text = final_plan(s.profile_features(documents, exclude=(), distinct="exact"))
    assert text.count("FileScan") == 1


def test_samples_need_no_shuffle_of_rows(spark):
    text = plan(QUERIES["balanced_sample"](spark, DATA))
    assert "hashpartitioning" not in text


def test_folds_are_a_projection(spark):
    assert "Exchange" not in plan(QUERIES["fold_assignment"](spark, DATA))


def test_audit_counts_keys_once_before_comparing_them(spark):
    """For parents too big to broadcast; a broadcast parent may be compared with the rows themselves."""
    children = v.table(spark, DATA, "events").select("user_id")
    parents = v.table(spark, DATA, "customer").withColumnRenamed("c_custkey", "user_id").select("user_id")
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in settings:
        spark.conf.set(name, "-1")
    try:
        text = final_plan(key_problems(children, "user_id", parents))
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "LeftAnti" in text and "ReusedExchange" in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_of_rows(spark, name):
    if name in ("gbt_predictions", "rf_predictions", "training_metrics", "cv_log", "importances", "encoded_vectors",
                "encoded_dimensions", "scored_rows", "boosted_rows", "reloaded_model_rows", "tuning_structure", "forest_training_metrics"):
        pytest.skip("fits models")
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "PythonUDF" not in text
