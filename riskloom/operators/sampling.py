"""Class balance, samples, splits and folds that do not depend on partitioning.

Every choice is a function of the row's key and a salt: a map-only filter that
gives the same rows for any number of partitions and after any retry. ``keys``
should identify a row; rows sharing a key are kept or dropped together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.keys import (
    PORTABLE_RANGE,
    WIDE_RANGE,
    fold_id,
    keep_fraction,
    key_bucket,
    portable_bucket,
)

Keys = str | Sequence[str]


def class_counts(df: DataFrame, label: str = "label") -> dict[int, int]:
    """Rows per class. Runs one aggregate."""
    row = df.agg(
        F.count_if(F.col(label) == 0).alias("n"), F.count_if(F.col(label) == 1).alias("p")
    ).first()
    return {0: row["n"], 1: row["p"]}


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """label, n_rows, class_weight = total / (2 x n_rows) for the classes that occur; lazy."""
    rows = F.array(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1))
    counted = df.agg(rows.alias("rows"))
    total = F.get("rows", F.lit(0)) + F.get("rows", F.lit(1))
    return (
        counted.select(total.alias("total"), F.posexplode("rows").alias("label", "n_rows"))
        .where(F.col("n_rows") > 0)
        .select("label", "n_rows", (F.col("total") / (F.col("n_rows") * 2)).alias("class_weight"))
    )


def fit_class_weights(df: DataFrame, label: str = "label") -> dict[int, float]:
    """Weights of both classes on the driver; an error unless both occur. Runs one aggregate."""
    return weights_of(class_counts(df, label))


def weights_of(counts: Mapping[int, int]) -> dict[int, float]:
    """Weights from the rows per class; an error unless both occur."""
    if not counts[0] or not counts[1]:
        raise ValueError(f"expected both classes, found {counts}")
    total = counts[0] + counts[1]
    return {value: total / (2.0 * count) for value, count in counts.items()}


def negative_fraction(df: DataFrame, label: str = "label", ratio: float = 1.0) -> DataFrame:
    """One row: n_positive, n_negative and the share of negatives to keep; lazy.

    The share is 1 where a class is missing: there is nothing to balance.
    """
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("n_positive"),
        F.count_if(F.col(label) == 0).alias("n_negative"),
    )
    share = F.col("n_positive") * F.lit(float(ratio)) / F.col("n_negative")
    both = (F.col("n_positive") > 0) & (F.col("n_negative") > 0)
    return counts.select(
        "n_positive",
        "n_negative",
        F.when(both, F.least(F.lit(1.0), share)).otherwise(F.lit(1.0)).alias("fraction"),
    )


def balanced_sample(
    df: DataFrame,
    keys: Keys,
    label: str = "label",
    ratio: float = 1.0,
    salt: str = "",
    portable: bool = False,
) -> DataFrame:
    """All positives and about ``ratio`` times as many negatives; lazy, one extra count over the labels."""
    fraction = negative_fraction(df, label, ratio).select("fraction").scalar()
    return df.where((F.col(label) == 1) | ((F.col(label) == 0) & keep_fraction(keys, fraction, salt, portable)))


def balance(
    df: DataFrame,
    keys: Keys,
    label: str = "label",
    ratio: float = 1.0,
    *,
    mode: str = "full",
    balanced: bool = True,
    fraction: float = 0.35,
    min_positive: int = 0,
    salt: str = "",
) -> DataFrame:
    """Training-size reduction with its fallbacks. Runs one aggregate.

    Unchanged in smoke mode, where a class is missing and, unbalanced, for a
    fraction of 0.999 or more. ``min_positive`` leaves a frame as it is whose
    sample would have fewer positives; it is off by default, since it turns one
    positive more or less into another training set. Balanced samples carry ``class_weight`` 1.0; unbalanced mode
    keeps ``fraction`` of both classes.
    """
    if mode == "smoke" or (not balanced and fraction >= 0.999):
        return df
    known = df.where(F.col(label).isin(0, 1))
    kept = keep_fraction(keys, fraction, salt)
    counts = class_counts(df if balanced else known.where(kept), label)
    if balanced and (not counts[0] or not counts[1]):
        return df
    if not balanced and not counts[0] + counts[1]:
        raise ValueError("the training sample is empty")
    if counts[1] < min_positive:
        return df
    if not balanced:
        return known.where(kept)
    share = min(1.0, counts[1] * ratio / counts[0])
    negative = (F.col(label) == 0) & keep_fraction(keys, share, salt)
    return df.where((F.col(label) == 1) | negative).withColumn("class_weight", F.lit(1.0))


def stratified_sample(
    df: DataFrame,
    keys: Keys,
    fractions: Mapping[int, float],
    label: str = "label",
    salt: str = "",
    portable: bool = False,
) -> DataFrame:
    """A fraction of each listed class; other labels are dropped."""
    rule: Column = F.lit(False)
    for value, fraction in fractions.items():
        rule = rule | ((F.col(label) == value) & keep_fraction(keys, fraction, salt, portable))
    return df.where(rule)


def smoke_sample(
    df: DataFrame, keys: Keys, fraction: float = 0.02, label: str = "label", salt: str = ""
) -> DataFrame:
    """The same fraction of both classes; an error if a class is lost. Runs one aggregate."""
    sample = stratified_sample(df, keys, {0: fraction, 1: fraction}, label, salt)
    counts = class_counts(sample, label)
    if not counts[0] + counts[1]:
        raise ValueError("the smoke sample is empty")
    if not counts[0] or not counts[1]:
        raise ValueError(f"the smoke sample lost a class: {counts}")
    return sample


def split_part(
    keys: Keys, weights: Sequence[float] = (0.7, 0.3), salt: str = "split", portable: bool = False
) -> Column:
    """Number of the part a row falls into, by its share of the hash range."""
    bucket, size = (
        (portable_bucket(keys, salt), PORTABLE_RANGE)
        if portable
        else (key_bucket(keys, salt), WIDE_RANGE)
    )
    total, edge, part = float(sum(weights)), 0.0, F.lit(len(weights) - 1)
    edges = []
    for weight in weights[:-1]:
        edge += weight
        edges.append(edge / total)
    for number in range(len(edges) - 1, -1, -1):
        part = F.when(bucket < F.lit(edges[number] * size), F.lit(number)).otherwise(part)
    return part


def split(
    df: DataFrame, keys: Keys, weights: Sequence[float] = (0.7, 0.3), salt: str = "split"
) -> list[DataFrame]:
    """Disjoint parts that add up to ``df``."""
    part = split_part(keys, weights, salt)
    return [df.where(part == number) for number in range(len(weights))]


def training_partitions(rows: int) -> int:
    """Partitions for rows that will be read many times, from the number of rows alone.

    Fits depend on partitions, so the cluster has no say. Few thousand rows each
    up to 64 partitions, then a quarter million each: a sample drawn from a huge
    table must not keep that table's partitions, nor a small one sit in a single task.
    """
    return max(1, min(rows // 4_000, 64), rows // 250_000)


def placed_by_key(df: DataFrame, keys: Keys, partitions: int) -> DataFrame:
    """The same rows in the same order in the same partition, wherever they came from."""
    names = [keys] if isinstance(keys, str) else list(keys)
    return df.repartition(partitions, *names).sortWithinPartitions(*names)


def with_folds(df: DataFrame, keys: Keys, folds: int = 3, portable: bool = False) -> DataFrame:
    return df.withColumn("cv_fold", fold_id(keys, folds, portable))
