"""Profiles, the decision ladder, pruning and preparation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import profile as p
from riskloom.operators import selection as s

# Published profile rows, at least one per decision.
PUBLISHED = [
    ("addr1", "numeric", "double", 0.240438, 114, None, None, "high", True, "include_numeric"),
    ("dist2", "numeric", "double", 0.87806, 476, None, None, "high", True, "include_numeric"),
    ("v1", "numeric", "double", 0.585535, 1, None, None, "constant", False, "drop_constant_or_empty"),
    ("productcd", "string", "string", 0.0, 5, 0.591029, 1.0, "low", True, "include_string"),
    ("card4", "string", "string", 0.002643, 4, 0.650955, 1.0, "low", True, "include_string"),
    ("p_emaildomain", "string", "string", 0.144576, 58, 0.508739, 0.951711, "high", True, "include_string_topk"),
    ("id_11", "string", "string", 0.610953, 109, 0.94718, 0.980427, "high", True, "include_string_topk"),
    ("id_31", "string", "string", 0.612865, 111, 0.141459, 0.656637, "high", False, "drop_high_cardinality_low_coverage"),
    ("id_02", "string", "string", 0.611057, 11681, 0.000268, 0.002056, "high", False, "drop_high_cardinality_low_coverage"),
    ("id_33", "string", "string", 0.855459, 82, 0.184508, 0.756074, "high", True, "include_string_topk"),
    ("m1", "string", "string", 0.573748, 2, 0.999918, 1.0, "low", False, "drop_dominant_value"),
    ("id_07", "string", "string", 0.985223, 56, None, None, "high", False, "drop_high_null"),
    ("id_27", "string", "string", 0.985188, 2, None, None, "low", False, "drop_high_null"),
]
STATS = "feature_name string, source_type string, spark_type string, null_ratio double, distinct_non_null long, dominant_ratio double, top_category_coverage double"


def test_published_decisions(spark):
    stats = spark.createDataFrame([row[:7] for row in PUBLISHED], STATS)
    got = {row["feature_name"]: row for row in s.decide(stats).collect()}
    for row in PUBLISHED:
        mine = got[row[0]]
        assert (mine["cardinality_bucket"], mine["included"], mine["inclusion_decision"]) == row[7:]


def test_limits_are_strict(spark):
    edge = [
        ("null", "numeric", "double", 0.95, 5, None, None),
        ("dominant", "string", "string", 0.0, 5, 0.995, 1.0),
        ("coverage", "string", "string", 0.0, 101, 0.1, 0.80),
        ("distinct", "string", "string", 0.0, 100, 0.1, 0.1),
        ("plain", "string", "string", 0.0, 30, 0.1, 0.1),
        ("other", "other", "map<string,int>", 0.99, 0, None, None),
    ]
    got = {r["feature_name"]: r["inclusion_decision"] for r in s.decide(spark.createDataFrame(edge, STATS)).collect()}
    assert got == {
        "null": "include_numeric", "dominant": "include_string", "coverage": "include_string_topk",
        "distinct": "include_string_topk", "plain": "include_string", "other": "drop_unsupported",
    }


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(1)
    rows = []
    for i in range(2000):
        rows.append(
            (
                i,
                float(i % 2),
                None if i % 4 == 0 else rng.randrange(50) * 1.5,
                None if i % 50 else 1.0,
                7,
                "hot" if i % 3 == 0 else f"c{rng.randrange(60)}",
                "a" if i else "b",
                None if i % 5 == 0 else rng.choice(["x", "y", "z"]),
                f"key{i}",
                None,
            )
        )
    schema = "transactionid long, label double, num double, sparse double, constant int, tail string, dominant string, plain string, ident string, empty double"
    return spark.createDataFrame(rows, schema).withColumn("when", F.current_timestamp())


EXPECTED = {
    "num": "include_numeric", "sparse": "drop_high_null", "constant": "drop_constant_or_empty",
    "tail": "include_string_topk", "dominant": "drop_dominant_value", "plain": "include_string",
    "ident": "drop_high_cardinality_low_coverage", "empty": "drop_high_null", "when": "drop_unsupported",
}


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_profile(frame, mode):
    rows = {r["feature_name"]: r for r in s.profile_features(frame, distinct=mode).collect()}
    assert {name: row["inclusion_decision"] for name, row in rows.items()} == EXPECTED
    assert rows["num"]["null_ratio"] == 0.25
    assert rows["empty"]["null_ratio"] == 1.0 and rows["empty"]["distinct_non_null"] == 0
    assert rows["tail"]["dominant_ratio"] == pytest.approx(667 / 2000, abs=1e-6)
    assert rows["plain"]["top_category_coverage"] == 1.0
    assert rows["num"]["dominant_ratio"] is None and rows["sparse"]["dominant_ratio"] is None


def test_unknown_distinct_mode(frame):
    with pytest.raises(ValueError):
        s.profile_features(frame, distinct="some")


def test_profile_of_an_empty_table(frame):
    rows = s.profile_features(frame.limit(0), distinct="exact").collect()
    assert {r["inclusion_decision"] for r in rows} == {"drop_high_null", "drop_unsupported"}
    assert all(r["null_ratio"] == 1.0 for r in rows)


def test_top_categories_break_ties_by_name(spark):
    rows = [(v,) for v in ["b", "a", "c", "c", "d", "d", None, None, None]]
    got = p.top_categories(spark.createDataFrame(rows, "v string"), ["v"], 3).orderBy("position").collect()
    assert [(r["value"], r["n_rows"], r["position"]) for r in got] == [("c", 2, 1), ("d", 2, 2), ("a", 1, 3)]


def test_exact_distinct_treats_signed_zeros_as_one(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.5,), (None,)], "v double")
    assert p.exact_distinct(df).first()["distinct_non_null"] == 2


def test_limit_is_applied_before_the_shuffle(frame):
    plan = p.top_categories(frame, ["ident"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_source_scores_and_pruning(spark):
    importances = spark.createDataFrame(
        [("num_imputed", "0.4"), ("plain_ohe_x", "0.1"), ("plain_ohe_y", "0.25"), ("tail_ohe_hot", "0.3"), ("", "9"), ("bad", "")],
        "feature_name string, importance string",
    )
    scores = {r["feature_name"]: r["score"] for r in s.source_importances(importances).collect()}
    assert scores == pytest.approx({"num": 0.4, "plain": 0.35, "tail": 0.3})


def test_feature_plan_and_preparation(spark, frame):
    profile = s.profile_features(frame, distinct="exact")
    plan = s.fit_feature_plan(frame, profile)
    assert (list(plan.numeric), list(plan.strings)) == (["num"], ["plain", "tail"])
    assert len(plan.kept["tail"]) == 10 and plan.kept["tail"][0] == "hot"
    scores = spark.createDataFrame([("tail", 2.0), ("plain", 1.0)], "feature_name string, score double")
    assert list(s.fit_feature_plan(frame, profile, scores=scores, max_string=1).strings) == ["tail"]
    none = spark.createDataFrame([], "feature_name string, score double")
    assert list(s.fit_feature_plan(frame, profile, scores=none, max_string=1).strings) == ["plain", "tail"]

    prepared = s.prepare_features(frame, plan, {0: 0.5, 1: 2.0})
    values = {r[0] for r in prepared.select("tail").distinct().collect()}
    assert values == {*plan.kept["tail"], "__OTHER__"}
    assert prepared.where("plain IS NULL").count() == 0
    assert prepared.where("plain = '__MISSING__'").count() == 400
    weights = {r[0]: r[1] for r in prepared.select("label", "class_weight").distinct().collect()}
    assert weights == {0.0: 0.5, 1.0: 2.0}


def test_width_estimate(spark):
    profile = spark.createDataFrame(
        [("include_numeric", 9), ("include_numeric", 400), ("include_string_topk", 58), ("include_string", 5), ("drop_high_null", 3)],
        "inclusion_decision string, distinct_non_null long",
    )
    row = s.encoded_width(profile).first()
    assert tuple(row) == (2, 2, 2 + 12 + 6)


def test_hundreds_of_columns_profile_in_one_small_plan(spark):
    """A wide table must not need a wide aggregate."""
    wide = spark.range(300).select(*[((F.col("id") * (i + 1)) % (i + 2)).alias(f"v{i}") for i in range(430)])
    rows = {r["feature_name"]: r for r in s.profile_features(wide).collect()}
    assert len(rows) == 430
    assert rows["v0"]["inclusion_decision"] == "include_numeric"
    exact = len({(i * 100) % 101 for i in range(300)})
    assert math.isclose(rows["v99"]["distinct_non_null"], exact, rel_tol=0.2)


def test_long_values_are_counted_by_their_digest(spark):
    long = ["x" * 1000 + str(i % 3) for i in range(9)]
    df = spark.createDataFrame([(v,) for v in [*long, "short", None]], "v string")
    counts = p.value_counts(df, ["v"], digest=True).collect()
    assert sorted(r["n_rows"] for r in counts) == [1, 1, 3, 3, 3]
    assert max(len(r["value"] or "") for r in counts) == 64
    assert p.exact_distinct(df).first()["distinct_non_null"] == 4
    assert {r["value"] for r in p.top_categories(df, ["v"], 3).collect()} == set(long)


def test_awkward_column_names(spark):
    names = ["it's", "tick`ed", "dot.ted", "back\\slash", "Ünï"]
    df = spark.createDataFrame([("a", "b", "c", "d", None), ("a", "x", None, "d", None)], "a string, b string, c string, d string, e string").toDF(*names)
    rows = {r["feature_name"]: r["distinct_non_null"] for r in p.exact_distinct(df).collect()}
    assert rows == dict(zip(names, [1, 2, 1, 1, 0]))
    assert {r["feature_name"] for r in s.profile_features(df, exclude=()).collect()} == set(names)
    assert {r["feature_name"]: r["n_null"] for r in p.null_profile(df).collect()}["Ünï"] == 2


def test_profile_of_text_columns_only(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "x")], "s string, t string")
    rows = {row["feature_name"]: row for row in s.profile_features(df).collect()}
    assert (rows["s"]["distinct_non_null"], rows["t"]["distinct_non_null"]) == (2, 1)
    assert rows["s"]["source_type"] == "string" and rows["t"]["inclusion_decision"] == "drop_constant_or_empty"
