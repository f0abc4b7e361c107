"""Category clean-up, feature names and display text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-ins for absent and infrequent categories.
MISSING = "__MISSING__"
OTHER = "__OTHER__"
UNKNOWN = "unknown"


def fill_missing_string(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(MISSING))


def fill_missing_category(value: Column, label: str = UNKNOWN) -> Column:
    """Report-side filling: a NULL category becomes a visible group."""
    return F.coalesce(value.cast("string"), F.lit(label))


def map_top_k(value: Column, kept: Sequence[str]) -> Column:
    """Keep the listed categories, name NULL and everything else."""
    text = value.cast("string")
    return (
        F.when(text.isNull(), F.lit(MISSING))
        .when(text.isin(list(kept)), text)
        .otherwise(F.lit(OTHER))
    )


def weight_by_label(label: Column, weights: Mapping[int, float]) -> Column:
    """The weight of the row's class; NULL for a label that is neither 0 nor 1."""
    return F.when(label == F.lit(1.0), F.lit(float(weights[1]))).when(
        label == F.lit(0.0), F.lit(float(weights[0]))
    )


def cardinality_bucket(distinct: Column, medium_limit: int = 30) -> Column:
    return (
        F.when(distinct <= 1, F.lit("constant"))
        .when(distinct <= 10, F.lit("low"))
        .when(distinct <= medium_limit, F.lit("medium"))
        .otherwise(F.lit("high"))
    )


def source_feature(name: Column) -> Column:
    """Source column behind an encoded feature: text before ``_ohe_``, or without ``_imputed``."""
    return F.when(F.contains(name, F.lit("_ohe_")), F.split_part(name, F.lit("_ohe_"), F.lit(1))).otherwise(
        F.regexp_replace(name, "_imputed$", "")
    )


def strip_order_prefix(label: Column) -> Column:
    """Drop the digits that keep band labels in order."""
    return F.regexp_replace(label, "^[0-9]+_", "")


def trimmed(value: Column) -> Column:
    return F.trim(value)


def best_model_text(model: Column, metric: Column) -> Column:
    return F.format_string("Best model: %s; test AUC-PR: %.3f", model, metric)


def params_json(params: Mapping[str, Column]) -> Column:
    """JSON object with its keys in sorted order."""
    return F.to_json(F.struct(*[params[name].alias(name) for name in sorted(params)]))
