"""Report tables: metrics, model ranking, chart data and dashboard tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.amounts import rate_above, rate_percent
from riskloom.functions.categories import best_model_text, strip_order_prefix

# The test metrics of a model row, in report order.
TEST_METRICS = ("test_auc_pr", "test_auc_roc", "test_f1", "test_accuracy")


def metrics_long(metrics: DataFrame, names: Sequence[str] = TEST_METRICS) -> DataFrame:
    """model_name, metric_name, metric_value."""
    return metrics.select("model_name", *[F.col(name).cast("double").alias(name) for name in names]).unpivot(
        ["model_name"], list(names), "metric_name", "metric_value"
    )


def best_model(metrics: DataFrame, metric: str = "test_auc_pr") -> DataFrame:
    """One row with the best model, the alphabetically first of equals, and its display text."""
    top = (
        metrics.select("model_name", F.col(metric).cast("double").alias("value"))
        .orderBy(F.desc("value"), F.asc("model_name"))
        .limit(1)
    )
    return top.select(
        "model_name",
        F.lit(metric).alias("best_metric_name"),
        F.col("value").alias("best_metric_value"),
        best_model_text(F.col("model_name"), F.col("value")).alias("display_text"),
    )


def model_ranking(metrics: DataFrame, metric: str = "test_auc_pr") -> DataFrame:
    """Model rows with their position. One row per model, so one window over all is small."""
    order = W.orderBy(F.desc(metric), F.asc("model_name"))
    return metrics.withColumn("position", F.row_number().over(order))


def model_comparison(
    metrics: DataFrame, mode: str = "full", seed: int = 20, metric: str = "test_auc_pr"
) -> DataFrame:
    """One JSON document: constants, the best model and all models best first."""
    row = F.struct(*[F.col(name) for name in sorted(metrics.columns)])
    entry = F.struct((-F.col(metric).cast("double")).alias("rank"), F.col("model_name"), row.alias("row"))
    models = F.transform(F.array_sort(F.collect_list(entry)), lambda item: item["row"])
    return metrics.agg(models.alias("models")).select(
        F.to_json(
            F.struct(
                F.get(F.col("models"), F.lit(0))["model_name"].alias("best_model_by_test_auc_pr"),
                F.lit(mode).alias("execution_mode"),
                F.lit("isFraud").alias("label_proxy"),
                F.col("models"),
                F.lit(seed).alias("seed"),
                F.lit("areaUnderPR").alias("selection_metric"),
            )
        ).alias("comparison_json")
    )


def rank_importances(importances: DataFrame, top: int | None = None) -> DataFrame:
    """Importances by size, then name; ``top`` keeps the first ones."""
    ordered = importances.orderBy(F.desc("importance"), F.asc("feature_name"))
    return ordered if top is None else ordered.limit(top)


def bar_chart(report: DataFrame, label: str) -> DataFrame:
    """label, rate_pct, highlighted, lowest rate first (horizontal bars grow upwards)."""
    rate = F.col("fraud_rate")
    return report.select(
        F.col(label).alias("label"),
        rate_percent(rate).alias("rate_pct"),
        rate_above(rate).alias("highlighted"),
    ).orderBy("rate_pct", "label")


def band_chart(report: DataFrame) -> DataFrame:
    """label without its ordering prefix, total, rate_pct, in band order."""
    return report.orderBy("amount_band").select(
        strip_order_prefix(F.col("amount_band")).alias("label"),
        F.coalesce(F.col("total_transactions").cast("double"), F.lit(0.0)).alias("total"),
        rate_percent(F.col("fraud_rate")).alias("rate_pct"),
    )


def daily_chart(report: DataFrame) -> DataFrame:
    return report.orderBy("transaction_day").select(
        F.col("transaction_day").cast("double").alias("day"),
        F.coalesce(F.col("total_transactions").cast("double"), F.lit(0.0)).alias("total"),
        rate_percent(F.col("fraud_rate")).alias("rate_pct"),
    )


def axis_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order."""
    return df.select(column).distinct().orderBy(column)


def pair_matrix(report: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """One row per ``rows`` value, one percent column per listed value, 0.0 where a pair is missing."""
    cells = report.select(rows, columns, rate_percent(F.col("fraud_rate")).alias("pct"))
    return (
        cells.groupBy(rows)
        .pivot(columns, list(values))
        .agg(F.first("pct"))
        .na.fill(0.0, list(values))
        .orderBy(rows)
    )


def tile(df: DataFrame, keys: Sequence[str], measure: Column, name: str) -> DataFrame:
    """A dashboard tile: one aggregate per group of a result table."""
    return df.groupBy(*keys).agg(measure.alias(name))


def average_rate_tile(report: DataFrame, keys: Sequence[str]) -> DataFrame:
    return tile(report, keys, F.avg("fraud_rate"), "avg_fraud_rate")


def daily_volume_tile(report: DataFrame) -> DataFrame:
    return tile(report, ["transaction_day"], F.sum("total_transactions"), "sum_transactions")


def metric_tile(long: DataFrame) -> DataFrame:
    return tile(long, ["metric_name", "model_name"], F.avg("metric_value"), "avg_metric_value")


def decision_tile(counts: DataFrame) -> DataFrame:
    return tile(counts, ["inclusion_decision"], F.sum("feature_count"), "sum_feature_count")
