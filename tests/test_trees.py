"""Compiled ensembles against the fitted ones."""

import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import trees


@pytest.fixture(scope="module")
def vectors(spark):
    """Two numbers, one of them with NaN, and a feature of four categories."""
    rows = spark.range(0, 1500, numPartitions=3).select(
        "id",
        F.when(F.pmod(F.hash("id"), F.lit(7)) < 3, 1.0).otherwise(0.0).alias("label"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000 + (F.pmod(F.hash("id"), F.lit(7)) < 3).cast("double") * 0.3).alias("a"),
        F.when(F.col("id") % 50 == 0, float("nan")).otherwise(F.pmod(F.hash(F.col("id") * 3), F.lit(13)) * 1.0).alias("b"),
        F.pmod(F.hash("id"), F.lit(4)).cast("double").alias("c"),
    )
    table = VectorAssembler(inputCols=["a", "b", "c"], outputCol="raw", handleInvalid="keep").transform(rows)
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=4).fit(table).transform(table).drop("raw")


@pytest.mark.parametrize("family, settings", [
    (RandomForestClassifier, {"numTrees": 7, "maxDepth": 5}), (RandomForestClassifier, {"numTrees": 3, "maxDepth": 0}),
    (GBTClassifier, {"maxIter": 6, "maxDepth": 3}),
])
def test_equal_to_transform_on_every_row(spark, vectors, family, settings):
    model = family(seed=3, **settings).fit(vectors.where("NOT isnan(b)"))
    nodes = trees.ensemble_nodes(spark, model)
    assert len(nodes.roots) == len(model.trees) and len(nodes.feature) == model.totalNumNodes
    if nodes.depth:
        assert max(nodes.mask) > 0 and min(nodes.mask) == -1
    exact = 0.0 if not nodes.boosted else 1e-12
    mine = trees.score_columns(vectors.select("id", "features"), nodes, vector_to_array("features"))
    theirs = model.transform(vectors).select(
        "id", vector_to_array("rawPrediction")[1].alias("s"), vector_to_array("probability")[1].alias("p"), F.col("prediction").alias("q")
    )
    both = mine.join(theirs, "id")
    assert both.count() == 1500
    off = (F.abs(F.col("score") - F.col("s")) > exact) | (F.abs(F.col("probability") - F.col("p")) > exact) | (F.col("prediction") != F.col("q"))
    assert both.where(off).count() == 0
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
