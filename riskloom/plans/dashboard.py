"""The report flow: result tables in, dashboard tables out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from riskloom.operators.report import (
    average_rate_tile,
    best_model,
    daily_volume_tile,
    decision_tile,
    metric_tile,
    metrics_long,
    rank_importances,
)
from riskloom.operators.selection import decision_counts
from riskloom.sources.reports import cast_report_columns
from riskloom.sources.tables import require_tables

# Dashboard tables that are typed copies of results.
SOURCE_TABLES = (
    "q1_product_risk",
    "q2_amount_band_risk",
    "q3_card_risk",
    "q4_email_domain_risk",
    "q5_daily_risk",
    "model_evaluation",
    "feature_importance_gbt",
    "feature_importance_rf",
    "feature_profile",
)
TOP_IMPORTANCES = 20


def dashboard_tables(results: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Typed result tables plus the three helper tables."""
    require_tables(results, SOURCE_TABLES)
    tables = {name: cast_report_columns(results[name]) for name in SOURCE_TABLES}
    tables["model_metrics_long"] = metrics_long(tables["model_evaluation"])
    tables["best_model_summary"] = best_model(tables["model_evaluation"])
    tables["feature_profile_summary"] = decision_counts(tables["feature_profile"])
    return tables


def dashboard_tiles(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What each tile of the dashboard shows."""
    return {
        "rate_by_product": average_rate_tile(tables["q1_product_risk"], ["productcd"]),
        "rate_by_band": average_rate_tile(tables["q2_amount_band_risk"], ["amount_band"]),
        "rate_by_card": average_rate_tile(tables["q3_card_risk"], ["card4", "card6"]),
        "rate_by_domain": average_rate_tile(tables["q4_email_domain_risk"], ["email_domain"]),
        "rate_by_day": average_rate_tile(tables["q5_daily_risk"], ["transaction_day"]),
        "volume_by_day": daily_volume_tile(tables["q5_daily_risk"]),
        "model_comparison": metric_tile(tables["model_metrics_long"]),
        "best_model": tables["best_model_summary"],
        "top_importances_gbt": rank_importances(tables["feature_importance_gbt"], TOP_IMPORTANCES),
        "top_importances_rf": rank_importances(tables["feature_importance_rf"], TOP_IMPORTANCES),
        "feature_decisions": decision_tile(tables["feature_profile_summary"]),
    }
