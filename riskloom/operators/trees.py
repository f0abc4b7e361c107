"""Fitted tree ensembles as expressions: arrays of nodes that the JVM walks, no vectors and no model object in the tasks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.models import save_model
from riskloom.session import scratch_path

#: Categories of one feature that a bit mask of a long holds.
MOST_CATEGORIES = 63


@dataclass(frozen=True)
class Nodes:
    """All nodes of an ensemble, one tree after the other; a leaf has feature -1.

    ``mask`` has the categories that go left, -1 for a numeric split. ``negative``
    and ``positive`` are a leaf's class shares for a forest; boosting has the
    leaf's weighted prediction in ``positive``.
    """

    roots: list[int]
    feature: list[int]
    threshold: list[float]
    mask: list[int]
    left: list[int]
    right: list[int]
    negative: list[float]
    positive: list[float]
    depth: int
    boosted: bool


def ensemble_nodes(spark: SparkSession, model) -> Nodes:
    """The nodes of a fitted binary forest or boosting model, read from the table that saving it writes.

    Brings one row per node to the driver, whose number the model's own settings bound.
    """
    path = scratch_path(spark, "trees")
    save_model(model, path)
    boosted = isinstance(model, GBTClassificationModel)
    table = spark.read.parquet(f"{path}/data")
    rows = table.select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    weights = list(model.treeWeights)
    roots, columns = [], {name: [] for name in ("feature", "threshold", "mask", "left", "right", "negative", "positive")}
    tree = offset = None
    for at, row in enumerate(rows):
        if row["treeID"] != tree:
            tree, offset = row["treeID"], at
            roots.append(at)
        split, leaf = row["split"], row["leftChild"] < 0
        categories = split["numCategories"]
        if categories > MOST_CATEGORIES:
            raise ValueError(f"feature {split['featureIndex']} has more than {MOST_CATEGORIES} categories")
        values = list(split["leftCategoriesOrThreshold"])
        numeric = categories < 0
        total = sum(row["impurityStats"])
        shares = [x / total if total else 0.0 for x in row["impurityStats"]]
        cells = {
            "feature": -1 if leaf else split["featureIndex"],
            "threshold": values[0] if numeric and not leaf else 0.0,
            "mask": -1 if numeric or leaf else sum(1 << int(x) for x in values),
            "left": at if leaf else offset + row["leftChild"],
            "right": at if leaf else offset + row["rightChild"],
            "negative": 0.0 if boosted else shares[0],
            "positive": row["prediction"] * weights[tree] if boosted else shares[1],
        }
        for name, cell in cells.items():
            columns[name].append(cell)
    depth = 0
    level = set(roots)
    while level := {columns[side][at] for at in level if columns["feature"][at] >= 0 for side in ("left", "right")}:
        depth += 1
    return Nodes(roots, **columns, depth=depth, boosted=boosted)


def _literal(values: list, kind: str) -> Column:
    """An array literal, parsed in one go."""
    cells = [f"double('{value!r}')" if kind == "double" else f"{value}L" if kind == "bigint" else str(value) for value in values]
    return F.expr(f"array({', '.join(cells)})").cast(f"array<{kind}>")


def leaves(nodes: Nodes, features: Column) -> Column:
    """The leaf that every tree sends an array of feature values to. NaN goes right, as in the fitted trees."""
    feature, left, right = (_literal(getattr(nodes, name), "int") for name in ("feature", "left", "right"))
    threshold, mask = _literal(nodes.threshold, "double"), _literal(nodes.mask, "bigint")

    def step(node: Column, _: Column) -> Column:
        value, categories = F.get(features, F.get(feature, node)), F.get(mask, node)
        among = F.call_function("shiftright", categories, value.cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1
        goes_left = F.when(categories < 0, value <= F.get(threshold, node)).otherwise(among)
        return F.when(F.get(feature, node) < 0, node).when(goes_left, F.get(left, node)).otherwise(F.get(right, node))

    if not nodes.depth:
        return _literal(nodes.roots, "int")
    levels = F.sequence(F.lit(1), F.lit(nodes.depth))
    return F.transform(_literal(nodes.roots, "int"), lambda root: F.aggregate(levels, root, step))


def compiled_score(nodes: Nodes, features: Column) -> Column:
    """Struct of ``score`` (raw prediction), ``probability`` of the positive class and ``prediction``.

    The numbers of ``transform``: those of a forest to the last bit, those of
    boosting up to the order in which a sum of products is taken.
    """

    def total(name: str, found: Column) -> Column:
        values = _literal(getattr(nodes, name), "double")
        return F.aggregate(found, F.lit(0.0), lambda sum_, leaf: sum_ + F.get(values, leaf))

    def answer(found: Column) -> Column:
        positive = total("positive", found)
        if nodes.boosted:
            return F.struct(positive.alias("score"), (1 / (1 + F.exp(-2 * positive))).alias("probability"), (positive > 0).cast("double").alias("prediction"))
        negative = total("negative", found)
        return F.struct(positive.alias("score"), (positive / (negative + positive)).alias("probability"), (positive > negative).cast("double").alias("prediction"))

    # the leaves are found once and used twice
    return F.element_at(F.transform(F.array(leaves(nodes, features)), answer), 1)


def score_columns(df: DataFrame, nodes: Nodes, features: Column) -> DataFrame:
    """``df`` with the columns score, probability and prediction."""
    return df.withColumn("_answer", compiled_score(nodes, features)).select(*df.columns, "_answer.*")

