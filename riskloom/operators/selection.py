"""Feature decisions, importance pruning and the prepared frame."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.categories import (
    cardinality_bucket,
    fill_missing_string,
    map_top_k,
    source_feature,
    weight_by_label,
)
from riskloom.operators.longform import names_table, quoted
from riskloom.operators.profile import (
    TOP_CATEGORIES,
    column_stats,
    exact_column_stats,
    feature_columns,
    rank_categories,
    source_type,
    value_counts,
)

EXCLUDED_FEATURES = frozenset({"transactionid", "is_fraud", "label", "class_weight"})


@dataclass(frozen=True)
class Thresholds:
    """Every limit is strict: a value equal to it passes."""

    null_ratio: float = 0.95
    dominant_ratio: float = 0.995
    string_distinct: int = 100
    string_coverage: float = 0.80
    top_cardinality: int = 30
    top_keep: int = TOP_CATEGORIES


def inclusion_decision(limits: Thresholds = Thresholds()) -> Column:
    """The first rule that applies, over the columns of the profile."""
    return (
        F.when(~F.col("source_type").isin("numeric", "string"), "drop_unsupported")
        .when(F.col("null_ratio") > limits.null_ratio, "drop_high_null")
        .when(F.col("distinct_non_null") <= 1, "drop_constant_or_empty")
        .when(F.col("source_type") == "numeric", "include_numeric")
        .when(F.col("dominant_ratio") > limits.dominant_ratio, "drop_dominant_value")
        .when(
            (F.col("distinct_non_null") > limits.string_distinct)
            & (F.col("top_category_coverage") < limits.string_coverage),
            "drop_high_cardinality_low_coverage",
        )
        .when(F.col("distinct_non_null") > limits.top_cardinality, "include_string_topk")
        .otherwise("include_string")
    )


def decide(stats: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Add the cardinality bucket, the decision and whether the feature is kept."""
    decision = inclusion_decision(limits)
    return stats.select(
        "*",
        cardinality_bucket(F.col("distinct_non_null"), limits.top_cardinality).alias("cardinality_bucket"),
        decision.startswith("include").alias("included"),
        decision.alias("inclusion_decision"),
    )


def profile_features(
    df: DataFrame,
    exclude: Collection[str] = EXCLUDED_FEATURES,
    limits: Thresholds = Thresholds(),
    distinct: str = "approx",
) -> DataFrame:
    """One row per column: type, null ratio, distinct values, category shares and the decision.

    Two passes whatever the number of columns: one for nulls and distinct
    sketches of the other columns, one that counts the values of string columns.
    Decisions rest on exact numbers: a sketch only tells one value from several.
    ``distinct="exact"`` counts the values of all columns. Category shares are
    NULL where an earlier rule has decided. Ratios are decided on as they are
    and shown with six places.
    """
    if distinct not in ("approx", "exact"):
        raise ValueError(f"unknown distinct mode: {distinct}")
    types = {field.name: field.dataType for field in df.schema.fields}
    names = feature_columns(df, exclude)
    kinds = [source_type(types[name]) for name in names]
    strings = [name for name, kind in zip(names, kinds) if kind == "string"]
    if distinct == "exact":
        stats = exact_column_stats(df, names, limits.top_keep)
    else:
        none = F.lit(None).cast("double")
        shares = {"dominant_ratio": none, "top_category_coverage": none}
        others = [name for name in names if name not in strings]
        parts = [column_stats(df, others).withColumns(shares)] if others or not strings else []
        parts += [exact_column_stats(df, strings, limits.top_keep)] if strings else []
        stats = reduce(DataFrame.unionByName, parts)
    described = names_table(
        df, names, source_type=kinds, spark_type=[types[name].simpleString() for name in names]
    )
    undecided = (
        (F.col("source_type") == "string")
        & (F.col("null_ratio") <= limits.null_ratio)
        & (F.col("distinct_non_null") > 1)
    )
    stats = stats.join(F.broadcast(described), "feature_name").select(
        "feature_name",
        "source_type",
        "spark_type",
        "null_ratio",
        F.coalesce("distinct_non_null", F.lit(0)).alias("distinct_non_null"),
        F.when(undecided, F.col("dominant_ratio")).alias("dominant_ratio"),
        F.when(undecided, F.col("top_category_coverage")).alias("top_category_coverage"),
    )
    return decide(stats, limits).withColumns(
        {name: F.round(name, 6) for name in ("null_ratio", "dominant_ratio", "top_category_coverage")}
    )


def decision_counts(profile: DataFrame) -> DataFrame:
    """inclusion_decision, feature_count."""
    return (
        profile.groupBy("inclusion_decision")
        .agg(F.count(F.lit(1)).alias("feature_count"))
        .orderBy("inclusion_decision")
    )


def valid_importances(importances: DataFrame) -> DataFrame:
    """Rows with a name and a number; empty cells do not count."""
    value = F.nullif(F.col("importance").cast("string"), F.lit("")).cast("double")
    return importances.select(
        F.nullif(F.col("feature_name"), F.lit("")).alias("feature_name"), value.alias("importance")
    ).na.drop("any")


def source_importances(importances: DataFrame) -> DataFrame:
    """feature_name, score: importance summed to the source column over all models given."""
    return (
        valid_importances(importances)
        .groupBy(source_feature(F.col("feature_name")).alias("feature_name"))
        .agg(F.sum("importance").alias("score"))
    )


def with_scores(profile: DataFrame, scores: DataFrame) -> DataFrame:
    """Profile rows with their score, 0.0 where a feature has none."""
    return profile.join(scores, "feature_name", "left").withColumn(
        "score", F.coalesce("score", F.lit(0.0))
    )


def keep_top_features(scored: DataFrame, max_numeric: int = 100, max_string: int = 16) -> DataFrame:
    """Included features by score, name breaking ties, up to a number per source type."""
    order = W.partitionBy("source_type").orderBy(F.desc("score"), F.asc("feature_name"))
    limit = F.when(F.col("source_type") == "numeric", max_numeric).otherwise(max_string)
    return (
        scored.where("included")
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= limit)
    )


def encoded_width(profile: DataFrame, top_keep: int = TOP_CATEGORIES) -> DataFrame:
    """One row: numeric_features, string_features, estimated_width before the variance filter."""
    decision = F.col("inclusion_decision")
    width = (
        F.when(decision == "include_numeric", F.lit(1))
        .when(decision == "include_string_topk", F.lit(top_keep + 2))
        .when(decision == "include_string", F.col("distinct_non_null") + 1)
        .otherwise(F.lit(0))
    )
    return profile.agg(
        F.count_if(decision == "include_numeric").alias("numeric_features"),
        F.count_if(decision.startswith("include_string")).alias("string_features"),
        F.sum(width).cast("bigint").alias("estimated_width"),
    )


@dataclass(frozen=True)
class FeaturePlan:
    """What training learned about the columns; applied unchanged to any other frame."""

    numeric: Sequence[str]
    strings: Sequence[str]
    kept: Mapping[str, Sequence[str]] = field(default_factory=dict)


def fit_feature_plan(
    df: DataFrame,
    profile: DataFrame,
    limits: Thresholds = Thresholds(),
    scores: DataFrame | None = None,
    max_numeric: int = 100,
    max_string: int = 16,
) -> FeaturePlan:
    """Bring the kept columns and their top categories to the driver.

    ``scores`` (of :func:`source_importances`) prunes to the best features; no
    scores, or none in them, keeps all. Moves one row per column and ``top_keep``
    values per long-tailed string column.
    """
    included = profile.where("included")
    if scores is not None and not scores.isEmpty():
        included = keep_top_features(with_scores(profile, scores), max_numeric, max_string)
    rows = included.select("feature_name", "source_type", "inclusion_decision").collect()
    numeric = sorted(row["feature_name"] for row in rows if row["source_type"] == "numeric")
    strings = sorted(row["feature_name"] for row in rows if row["source_type"] == "string")
    long_tailed = sorted(
        row["feature_name"] for row in rows if row["inclusion_decision"] == "include_string_topk"
    )
    kept: dict[str, list[str]] = {name: [] for name in long_tailed}
    if long_tailed:
        ranked = rank_categories(value_counts(df, long_tailed), limits.top_keep)
        for row in ranked.orderBy("feature_name", "position").collect():
            kept[row["feature_name"]].append(row["value"])
    return FeaturePlan(numeric, strings, kept)


def prepare_features(
    df: DataFrame, plan: FeaturePlan, weights: Mapping[int, float], label: str = "label"
) -> DataFrame:
    """Numbers as doubles, categories without gaps, class_weight by label; one projection."""
    numeric, strings = set(plan.numeric), set(plan.strings)

    def prepared(name: str) -> Column:
        if name in numeric:
            return F.col(quoted(name)).cast("double")
        if name in strings:
            return map_top_k(F.col(quoted(name)), plan.kept[name]) if name in plan.kept else fill_missing_string(F.col(quoted(name)))
        return F.col(quoted(name))

    columns = [prepared(name).alias(name) for name in df.columns if name != "class_weight"]
    return df.select(*columns, weight_by_label(F.col(label), weights).alias("class_weight"))
