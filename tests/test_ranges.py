"""Running totals, medians and exact ranking metrics against brute force and Spark ML."""

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from riskloom.operators.metrics import f1_accuracy, ranking_metrics, roc_points, score_points
from riskloom.operators.ranges import exact_medians, range_edges, running_totals, value_histogram


def brute_totals(rows, descending):
    sums = {}
    for value, n in rows:
        if value is not None:
            sums[value] = sums.get(value, 0) + n
    out, total = {}, 0
    for value in sorted(sums, reverse=descending):
        total += sums[value]
        out[value] = (sums[value], total)
    return out


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(3)
    rows = [(0.5, 1)] * 700  # a third of everything on one value
    rows += [(round(rng.gauss(0, 50), 2), rng.randrange(1, 4)) for _ in range(1400)]
    return rows + [(None, 5), (-0.0, 1), (0.0, 1)]


@pytest.mark.parametrize("buckets", [None, 1, 2, 7, 64, 65, 300])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, skewed, buckets, descending):
    df = spark.createDataFrame(skewed, "v double, n long").repartition(5)
    got = running_totals(df, "v", ["n"], descending=descending, buckets=buckets).collect()
    assert len(got) == len({row["v"] for row in got})
    assert {row["v"]: (row["n"], row["cum_n"]) for row in got} == brute_totals(skewed, descending)


def test_ranges_spread_distinct_values(spark, skewed):
    df = spark.createDataFrame(skewed, "v double, n long").where("v IS NOT NULL")
    edges = range_edges(df, "v", buckets=32)[None]
    assert 15 <= len(edges) <= 31 and list(edges) == sorted(set(edges))
    values = sorted({v for v, _ in skewed if v is not None})
    sizes = [sum(1 for v in values if sum(e < v for e in edges) == b) for b in range(len(edges) + 1)]
    assert max(sizes) <= len(values) // 5


@pytest.mark.parametrize("hot", [(0.5,), (0.25, 0.5, 0.75)])
def test_hot_values_do_not_eat_the_edges(spark, hot):
    """Nine rows of ten on few values: ranges still hold about the same number of distinct values."""
    tail = spark.range(20_000).select(((F.col("id") + 1) / 20_001).alias("v"), F.lit(1).alias("n"))
    heap = spark.range(180_000).select(F.element_at(F.lit(list(hot)), (F.col("id") % len(hot) + 1).cast("int")).alias("v"), F.lit(1).alias("n"))
    hist = value_histogram(tail.unionByName(heap), "v", ["n"])
    edges = range_edges(hist, "v", buckets=25)[None]
    assert len(edges) == 24
    place = sum((F.col("v") > edge).cast("int") for edge in edges)
    sizes = [row["count"] for row in hist.groupBy(place.alias("range")).count().collect()]
    assert len(sizes) == 25 and max(sizes) <= 2 * sum(sizes) / 25


@pytest.mark.parametrize("seed", range(4))
def test_medians_by_narrowing(spark, seed):
    """Hot values inside and at the bounds, signs, infinities; as if a hundred rows were too many to sort."""
    rng = random.Random(seed)
    hot = rng.choice([0.0, 3.0, -7.5])
    a = [hot if rng.random() < 0.4 else rng.gauss(0, 10) for _ in range(3000)]
    b = [rng.choice([float("inf"), float("-inf"), rng.random()]) for _ in range(3000)]
    c = [float(i) for i in range(3000)]
    d = [rng.choice([1.0, 2.0]) for _ in range(3000)]
    df = spark.createDataFrame(list(zip(a, b, c, d)), "a double, `b.x` double, c double, d double").repartition(4)
    names = ["a", "b.x", "c", "d"]
    got = {row["feature_name"]: row["median"] for row in exact_medians(df, names, buckets=8, rows=100).collect()}
    assert got == {name: sorted(cells)[1499] for name, cells in zip(names, (a, b, c, d))}


def test_empty_input(spark):
    df = spark.createDataFrame([], "v double, n long")
    assert running_totals(df, "v", ["n"]).collect() == []
    assert ranking_metrics(spark.createDataFrame([], "score double, label int")).first()["auc_roc"] is None


def test_infinite_and_nan_scores(spark):
    rows = [(float("-inf"), 1), (float("nan"), 1), (float("inf"), 1), (1.0, 1), (2.0, 1)]
    got = running_totals(spark.createDataFrame(rows, "v double, n long"), "v", ["n"], buckets=4).collect()
    by_total = [row["v"] for row in sorted(got, key=lambda row: row["cum_n"])]
    assert by_total[:4] == [float("-inf"), 1.0, 2.0, float("inf")] and math.isnan(by_total[4])


@pytest.mark.parametrize("buckets", [None, 3, 80])
def test_medians(spark, buckets):
    rng = random.Random(5)
    a = [rng.randrange(40) * 1.0 for _ in range(501)]
    b = [None if i % 3 else rng.random() for i in range(501)]
    c = [float("nan") if i % 2 else 4.0 for i in range(501)]
    df = spark.createDataFrame(list(zip(a, b, c, [None] * 501)), "a double, b double, c double, d double")
    got = {row["feature_name"]: row["median"] for row in exact_medians(df, ["a", "b", "c", "d"], buckets).collect()}
    present = sorted(x for x in b if x is not None)
    assert got == {"a": sorted(a)[250], "b": present[(len(present) - 1) // 2], "c": 4.0}


def test_median_of_an_even_count_is_the_lower_one(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "v int")
    assert exact_medians(df, ["v"]).first()["median"] == 2.0


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(4000):
        label = int(rng.random() < 0.2)
        score = 0.25 if rng.random() < 0.35 else round(rng.gauss(0.3 + 0.2 * label, 0.2), 4)
        rows.append((score, float(label), float(score > 0.45), float(label)))
    return spark.createDataFrame(rows, "score double, label double, prediction double, wanted double").cache()


@pytest.mark.parametrize("buckets", [None, 10, 100])
def test_areas_equal_the_evaluator_without_bins(scored, buckets):
    row = ranking_metrics(scored, buckets=buckets).first()
    for metric, name in (("areaUnderROC", "auc_roc"), ("areaUnderPR", "auc_pr")):
        exact = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol="label", metricName=metric, numBins=0
        ).evaluate(scored)
        assert row[name] == pytest.approx(exact, abs=1e-12)


def test_areas_do_not_depend_on_partitions(scored):
    rows = {tuple(ranking_metrics(scored.repartition(n), buckets=b).first()) for n, b in ((1, 4), (7, 9), (3, None))}
    assert len(rows) == 1


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")
    row = ranking_metrics(df).first()
    assert (row["n_positive"], row["n_negative"], row["auc_roc"], row["auc_pr"]) == (2, 0, None, 1.0)


def test_perfect_and_tied_scores(spark):
    perfect = spark.createDataFrame([(i / 10, int(i >= 5)) for i in range(10)], "score double, label int")
    tied = spark.createDataFrame([(0.5, i % 2) for i in range(10)], "score double, label int")
    assert ranking_metrics(perfect).first()["auc_roc"] == 1.0
    assert ranking_metrics(tied).first()["auc_roc"] == 0.5


def test_points_end_at_one(scored):
    points = roc_points(scored).orderBy("score").collect()
    assert (points[0]["tpr"], points[0]["fpr"]) == (1.0, 1.0)
    assert len(points) == score_points(scored).count()


def test_confusion_metrics_equal_the_evaluator(scored):
    row = f1_accuracy(scored).first()
    for metric in ("f1", "accuracy"):
        expected = MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="prediction", metricName=metric
        ).evaluate(scored)
        assert row[metric] == pytest.approx(expected, abs=1e-12)


def test_f1_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    expected = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1").evaluate(df)
    assert f1_accuracy(df).first()["f1"] == pytest.approx(expected)
    assert f1_accuracy(df.select(F.col("label").cast("int").alias("label"), "prediction")).first()["accuracy"] == pytest.approx(2 / 3)
