"""Exact ranking metrics and confusion metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ranges import grouped_running_totals, running_totals


def score_points(
    df: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None
) -> DataFrame:
    """One row per distinct score: tp and fp at it, cum_tp and cum_fp from the highest score down."""
    counted = df.where(F.col(label).isNotNull()).select(
        score,
        (F.col(label) == 1).cast("bigint").alias("tp"),
        (F.col(label) != 1).cast("bigint").alias("fp"),
    )
    return running_totals(counted, score, ["tp", "fp"], descending=True, buckets=buckets)


def ranking_metrics(
    df: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None
) -> DataFrame:
    """One row: n_positive, n_negative, auc_roc, auc_pr over every distinct score.

    The ROC area is a ratio of whole numbers. The precision-recall curve starts
    at recall 0 with the precision of the highest score. A missing class gives NULL.
    """
    return _areas(score_points(df, score, label, buckets), ())


def grouped_ranking_metrics(
    df: DataFrame, by: Sequence[str], score: str = "score", label: str = "label", buckets: int | None = None
) -> DataFrame:
    """:func:`ranking_metrics` of every group of the columns ``by``, such as model and fold, in one go.

    All groups share one stored histogram, so the areas of any number of fits are
    one chain of jobs. A group whose rows have no score or no label has no row.
    """
    counted = df.where(F.col(label).isNotNull()).select(
        *by, score, (F.col(label) == 1).cast("bigint").alias("tp"), (F.col(label) != 1).cast("bigint").alias("fp")
    )
    return _areas(grouped_running_totals(counted, by, score, ["tp", "fp"], descending=True, buckets=buckets), by)


def _areas(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """The columns of :func:`ranking_metrics` per group of :func:`score_points`; one row where there are no groups."""
    tp, fp, cum_tp, cum_fp = (F.col(name) for name in ("tp", "fp", "cum_tp", "cum_fp"))
    seen, before = cum_tp + cum_fp, cum_tp + cum_fp - tp - fp
    precision = cum_tp / seen
    previous = F.when(before > 0, (cum_tp - tp) / before).otherwise(precision)
    wide = "decimal(19,0)"
    return points.groupBy(*by).agg(
        F.sum(tp).alias("n_positive"),
        F.sum(fp).alias("n_negative"),
        F.sum(fp.cast(wide) * (cum_tp * 2 - tp).cast(wide)).alias("roc_area"),
        F.sum((tp * (precision + previous) / 2).cast("decimal(38,18)")).alias("pr_area"),
    ).select(
        *by,
        "n_positive",
        "n_negative",
        (
            F.col("roc_area").cast("double")
            / F.nullif(F.col("n_positive").cast("double") * F.col("n_negative") * 2, F.lit(0.0))
        ).alias("auc_roc"),
        (F.col("pr_area").cast("double") / F.nullif(F.col("n_positive"), F.lit(0))).alias("auc_pr"),
    )


def roc_points(
    df: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None
) -> DataFrame:
    """Curve points: score, tpr (recall), fpr and precision when everything at or above it is flagged."""
    points = score_points(df, score, label, buckets)
    classes = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).agg(
        F.nullif(F.count_if(F.col(label) == 1), F.lit(0)).alias("p"),
        F.nullif(F.count_if(F.col(label) != 1), F.lit(0)).alias("n"),
    )
    both = classes.select(F.struct("p", "n")).scalar()
    return points.select(
        F.col(score).alias("score"),
        (F.col("cum_tp") / both["p"]).alias("tpr"),
        (F.col("cum_fp") / both["n"]).alias("fpr"),
        (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("precision"),
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n_rows"))


def f1_accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: f1 weighted by class frequency, and accuracy; from the confusion counts alone."""
    n = F.col("n_rows")
    hit = F.when(F.col("actual") == F.col("guess"), n).otherwise(0)
    cells = confusion(
        df.select(F.col(label).cast("double").alias("actual"), F.col(prediction).cast("double").alias("guess")),
        "actual",
        "guess",
    )
    classes = (
        cells.select(
            F.inline(
                F.array(
                    F.struct(
                        F.col("actual").alias("class"),
                        n.alias("support"),
                        F.lit(0).cast("bigint").alias("guessed"),
                        hit.alias("hits"),
                    ),
                    F.struct(
                        F.col("guess").alias("class"),
                        F.lit(0).cast("bigint").alias("support"),
                        n.alias("guessed"),
                        F.lit(0).cast("bigint").alias("hits"),
                    ),
                )
            )
        )
        .groupBy("class")
        .agg(*[F.sum(name).alias(name) for name in ("support", "guessed", "hits")])
    )
    f1 = F.col("hits") * 2 / (F.col("support") + F.col("guessed"))
    return classes.agg(
        (F.sum(F.col("support") * f1) / F.sum("support")).alias("f1"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
    )
