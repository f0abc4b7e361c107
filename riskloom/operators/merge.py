"""Merging result sets of repeated runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(existing: DataFrame, new: DataFrame, key: str, sequence: str | None = None) -> DataFrame:
    """Rows of both frames, the last one per key; rows without a key are dropped.

    New rows come after existing ones; ``sequence`` orders rows inside a frame
    where a key may repeat there. Rows that are still even are ordered by their
    cells, so the result does not depend on the layout of the data. One
    aggregate that combines before the shuffle, so a key repeated without bound
    is one row per task.
    """
    columns = existing.columns
    both = existing.withColumn("_run", F.lit(0)).unionByName(new.select(*columns).withColumn("_run", F.lit(1)))
    position = F.struct("_run", *([sequence] if sequence else []), *[name for name in columns if name != sequence])
    present = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    latest = F.max_by(F.struct(*columns), position).alias("latest")
    return both.where(present).groupBy(key).agg(latest).select("latest.*").orderBy(key)


def prefer_new(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The new rows if there are any, else the existing ones; decided inside the query."""
    some_new = new.limit(1).agg(F.count(F.lit(1))).scalar()
    return new.unionByName(existing.where(some_new == 0))


def aligned_predictions(
    predictions: DataFrame,
    models: Sequence[str],
    key: str = "transactionid",
    label: str = "label",
) -> DataFrame:
    """One row per key: actual_label and, per model, <model>_probability and <model>_prediction.

    ``predictions`` holds model_name, key, label, probability, prediction. Keys
    missing from a model are left out. One shuffle for any number of models.
    """
    of = {name: F.col("model_name") == name for name in models}
    cells = [F.max(F.when(of[name], F.col("probability"))).alias(f"{name}_probability") for name in models]
    cells += [F.max(F.when(of[name], F.col("prediction").cast("int"))).alias(f"{name}_prediction") for name in models]
    ordered = [f"{name}_{part}" for name in models for part in ("probability", "prediction")]
    wide = (
        predictions.where(F.col("model_name").isin(list(models)))
        .groupBy(key)
        .agg(F.first(F.col(label).cast("int"), ignorenulls=True).alias("actual_label"), *cells)
    )
    return wide.na.drop("any", subset=[f"{name}_prediction" for name in models]).select(
        key, "actual_label", *ordered
    )


def first_by_key(df: DataFrame, key: str) -> DataFrame:
    """The row with the smallest key."""
    return df.orderBy(F.asc(key)).limit(1)
