"""Column profiles: nulls, distinct values, top categories."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.longform import POSITION, long_cells, named, names_table, quoted

TOP_CATEGORIES = 10
DIGEST_LENGTH = 64


def source_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "numeric"
    return "string" if isinstance(data_type, T.StringType) else "other"


def feature_columns(df: DataFrame, exclude: Collection[str]) -> list[str]:
    return sorted(name for name in df.columns if name not in exclude)


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in df.schema.fields}


def _as_text(name: str, data_type: T.DataType, digest: bool) -> str:
    """SQL of a text form in which equal values look the same (-0.0 and 0.0 are equal)."""
    column = quoted(name)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        column = f"{column} + 0D"
    text = f"CAST({column} AS STRING)"
    if digest and not isinstance(data_type, T.NumericType):
        return f"IF(length({text}) > {DIGEST_LENGTH}, sha2({text}, 256), {text})"
    return text


def _fingerprint(name: str, data_type: T.DataType) -> str:
    """SQL of a present value's hash; a type that cannot be hashed counts as one value."""
    column = quoted(name)
    unhashable = isinstance(data_type, (T.MapType, T.VariantType))
    return f"IF({column} IS NOT NULL, {'1L' if unhashable else f'xxhash64({column})'}, NULL)"


def value_counts(df: DataFrame, columns: Sequence[str], digest: bool = False) -> DataFrame:
    """feature_name, value, n_rows for all the columns at once, NULL values included.

    One pass: columns are turned into rows and counted before the shuffle, so a
    value held by a third of all rows travels as one row per task. With
    ``digest`` a value longer than its SHA-256 is replaced by it: enough where
    only the counts matter, and whole texts stay out of the shuffle.
    """
    types = _types(df)
    counts = (
        long_cells(df, [_as_text(name, types[name], digest) for name in columns])
        .groupBy(POSITION, "value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return named(counts, columns)


def _complete(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, also where the table is empty and nothing was counted."""
    return names_table(df, columns).join(stats, POSITION, "left").drop(POSITION)


def _null_columns() -> list[Column]:
    """n_rows, n_null and null_ratio from the counts of all rows and of present values."""
    rows, present = F.coalesce("n_rows", F.lit(0)), F.coalesce("n_present", F.lit(0))
    return [
        rows.alias("n_rows"),
        (rows - present).alias("n_null"),
        F.when(rows > 0, (rows - present) / rows).otherwise(F.lit(1.0)).alias("null_ratio"),
    ]


def column_stats(df: DataFrame, columns: Sequence[str], rsd: float = 0.05) -> DataFrame:
    """feature_name, n_rows, n_null, null_ratio and the approximate distinct_non_null, in one pass."""
    types = _types(df)
    stats = (
        long_cells(df, [_fingerprint(name, types[name]) for name in columns])
        .groupBy(POSITION)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("value").alias("n_present"),
            F.approx_count_distinct("value", rsd).alias("distinct_non_null"),
        )
    )
    return _complete(df, stats, columns).select(
        "feature_name", *_null_columns(), F.coalesce("distinct_non_null", F.lit(0)).alias("distinct_non_null")
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """feature_name, n_rows, n_null, null_ratio (1.0 for an empty table), by one wide aggregate."""
    names = list(df.columns if columns is None else columns)
    present = [F.expr(f"count({quoted(name)})").alias(f"present_{i}") for i, name in enumerate(names)]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *present).select(
        "n_rows",
        F.posexplode(F.array(*[F.col(f"present_{i}") for i in range(len(names))])).alias(
            POSITION, "n_present"
        ),
    )
    return named(counted, names).select("feature_name", *_null_columns())


def approx_distinct(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """feature_name, distinct_non_null by sketches that combine before the shuffle."""
    names = list(df.columns if columns is None else columns)
    return column_stats(df, names, rsd).select("feature_name", "distinct_non_null")


def exact_distinct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """feature_name, distinct_non_null, exact."""
    names = list(df.columns if columns is None else columns)
    return (
        value_counts(df, names, digest=True)
        .groupBy("feature_name")
        .agg(F.count("value").alias("distinct_non_null"))
    )


def rank_categories(counts: DataFrame, top: int = TOP_CATEGORIES) -> DataFrame:
    """The ``top`` most frequent present values per feature, ties by value, with their position.

    The limit is applied in every task before the shuffle, so a feature with any
    number of values sends ``top`` rows per task. NULL ranks last and is dropped
    after the ranking: a filter before it would sink below the counts and keep
    other uses of the same counts from sharing their shuffle.
    """
    order = W.partitionBy("feature_name").orderBy(
        F.col("value").isNull(), F.desc("n_rows"), F.asc("value")
    )
    return (
        counts.withColumn("position", F.row_number().over(order))
        .where((F.col("position") <= top) & F.col("value").isNotNull())
    )


def top_categories(df: DataFrame, columns: Sequence[str], top: int = TOP_CATEGORIES) -> DataFrame:
    """feature_name, value, n_rows, position for every listed column, in one job."""
    return rank_categories(value_counts(df, columns), top)


def category_coverage(counts: DataFrame, top: int = TOP_CATEGORIES) -> DataFrame:
    """One row per feature of :func:`value_counts`.

    feature_name, n_rows, n_present, distinct_non_null, dominant_ratio (share of
    the most frequent value), top_category_coverage (share of the ``top`` most
    frequent ones). Both shares are 1.0 for a feature without values.
    """
    present = F.when(F.col("value").isNotNull(), F.col("n_rows"))
    totals = counts.groupBy("feature_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.coalesce(F.sum(present), F.lit(0)).alias("n_present"),
        F.count("value").alias("distinct_non_null"),
        F.max(present).alias("top_rows"),
    )
    covered = (
        rank_categories(counts, top).groupBy("feature_name").agg(F.sum("n_rows").alias("covered_rows"))
    )

    def share(rows: str) -> Column:
        return F.when(F.col("n_present") > 0, F.col(rows) / F.col("n_present")).otherwise(F.lit(1.0))

    return totals.join(F.broadcast(covered), "feature_name", "left").select(
        "feature_name",
        "n_rows",
        "n_present",
        "distinct_non_null",
        share("top_rows").alias("dominant_ratio"),
        share("covered_rows").alias("top_category_coverage"),
    )


def exact_column_stats(
    df: DataFrame, columns: Sequence[str], top: int = TOP_CATEGORIES
) -> DataFrame:
    """What :func:`column_stats` gives, exactly, and the category shares; one scan and one row shuffle."""
    shares = category_coverage(value_counts(df, columns, digest=True), top)
    return names_table(df, columns).join(F.broadcast(shares), "feature_name", "left").select(
        "feature_name",
        *_null_columns(),
        F.coalesce("distinct_non_null", F.lit(0)).alias("distinct_non_null"),
        "dominant_ratio",
        "top_category_coverage",
    )
