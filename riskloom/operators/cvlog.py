"""The cross-validation log as a table: running means, time left, best parameters.

Log columns: timestamp_utc, model_name, combo_index, combo_total, fold_index
(1.. or 'summary'), fold_total, fold_metric_pr, combo_mean_metric_pr,
elapsed_seconds, eta_seconds, params_json.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LOG_SCHEMA = (
    "timestamp_utc timestamp, model_name string, combo_index int, combo_total int, "
    "fold_index string, fold_total int, fold_metric_pr double, combo_mean_metric_pr double, "
    "elapsed_seconds double, eta_seconds double, params_json string"
)


def running_fold_means(folds: DataFrame) -> DataFrame:
    """Add combo_mean_metric_pr: mean of the combo's folds up to this one (a window of a few folds)."""
    upto = (
        W.partitionBy("model_name", "combo_index")
        .orderBy(F.col("fold_index").cast("int"))
        .rowsBetween(W.unboundedPreceding, 0)
    )
    return folds.withColumn("combo_mean_metric_pr", F.avg("fold_metric_pr").over(upto))


def combo_means(folds: DataFrame) -> DataFrame:
    """model_name, combo_index, metric_pr over all folds of a combo."""
    return folds.groupBy("model_name", "combo_index").agg(F.avg("fold_metric_pr").alias("metric_pr"))


def time_left(combos: DataFrame) -> DataFrame:
    """Add elapsed_seconds and eta_seconds: mean combo time so far times the combos to come.

    ``combos`` holds model_name, combo_index, combo_total, combo_seconds; the
    window sees one model's grid.
    """
    upto = (
        W.partitionBy("model_name").orderBy("combo_index").rowsBetween(W.unboundedPreceding, 0)
    )
    return combos.withColumns(
        {
            "elapsed_seconds": F.sum("combo_seconds").over(upto),
            "eta_seconds": F.avg("combo_seconds").over(upto)
            * (F.col("combo_total") - F.col("combo_index")),
        }
    )


def best_combo(means: DataFrame, metric: str = "metric_pr") -> DataFrame:
    """Best row per model; the earliest combo wins a tie. Combines before the shuffle."""
    best = F.max_by(F.struct(*means.columns), F.struct(F.col(metric), -F.col("combo_index")))
    return means.where(F.col(metric).isNotNull()).groupBy("model_name").agg(best.alias("b")).select("b.*")


def best_logged(log: DataFrame) -> DataFrame:
    """model_name, combo_index, combo_mean_metric_pr, params_json of the best summary row per model."""
    summaries = log.where(F.col("fold_index") == "summary").select(
        "model_name", F.col("combo_index").cast("int").alias("combo_index"),
        F.col("combo_mean_metric_pr").cast("double").alias("combo_mean_metric_pr"), "params_json",
    )
    return best_combo(summaries, "combo_mean_metric_pr")
