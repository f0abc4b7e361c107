"""Audits: keys, classes, expected names, exported files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pk_duplicates(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    names = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows without a key."""
    return df.where(F.col(key).isNull())


def fk_orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is set and has no parent.

    Parent keys are made distinct first: a key repeated there costs one row.
    """
    known = parent.select(F.col(parent_key or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return child.where(F.col(key).isNotNull()).join(known, key, "left_anti")


def key_problems(child: DataFrame, key: str, parent: DataFrame | None = None) -> DataFrame:
    """problem, n_rows: rows without a key, keys that repeat and, given a parent, rows without one.

    Everything comes from one count per key, so a key shared by many rows is
    one row before it is compared with the parent's keys.
    """
    n, present = F.col("n_rows"), F.col(key).isNotNull()
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0))

    own = counts.agg(
        total(F.when(~present, n)).alias("null key"), F.count_if(present & (n > 1)).alias("duplicate key")
    ).unpivot([], ["null key", "duplicate key"], "problem", "n_rows")
    if parent is None:
        return own
    known = parent.groupBy(key).agg(F.count(F.lit(1)).alias("n_known")).select(key)
    orphans = counts.join(known, key, "left_anti").agg(total(F.when(present, n)).alias("n_rows"))
    return own.unionByName(orphans.select(F.lit("no parent").alias("problem"), "n_rows"))


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def classes_present(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: rows per class and whether both classes are there."""
    value = F.col(label)
    return df.agg(
        F.count_if(value == 0).alias("n_negative"), F.count_if(value == 1).alias("n_positive")
    ).select(
        "n_negative",
        "n_positive",
        ((F.col("n_negative") > 0) & (F.col("n_positive") > 0)).alias("both_present"),
    )


def expected_names(df: DataFrame, column: str, expected: Iterable[str]) -> DataFrame:
    """Names that differ from the expected set: name, problem (missing or unexpected).

    No rows means the set is exactly as expected. Blank names are ignored.
    """
    name = F.trim(F.col(column))
    found = df.select(name.alias("name")).where(F.col("name") != "").distinct()
    wanted = df.sparkSession.createDataFrame([(value,) for value in expected], "name string").distinct()
    return (
        found.withColumn("found", F.lit(True))
        .join(wanted.withColumn("wanted", F.lit(True)), "name", "full")
        .where(F.col("found").isNull() | F.col("wanted").isNull())
        .select("name", F.when(F.col("found").isNull(), "missing").otherwise("unexpected").alias("problem"))
    )


def check_predictions(df: DataFrame) -> None:
    """Raise unless the frame is exactly label, prediction and has rows (reads one row)."""
    if df.columns != ["label", "prediction"]:
        raise ValueError(f"expected columns label, prediction, found {df.columns}")
    if df.isEmpty():
        raise ValueError("no prediction rows")


# Strict JSON of any depth and length; a repeated name is allowed.
STRICT_JSON = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "maxNestingDepth": "2147483647",
    "maxNumLen": "2147483647",
    "maxStringLen": "2147483647",
}


def is_json(line: Column) -> Column:
    """True where the whole text is one JSON value.

    The parser stops after the first value, so the text is parsed as the only
    element of a list and as the only field of an object: whatever follows the
    first value spoils at least one of them.
    """
    listed = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>", STRICT_JSON)
    field = F.from_json(
        F.concat(F.lit('{"v":'), line, F.lit("}")),
        "v string, spoiled string",
        {**STRICT_JSON, "columnNameOfCorruptRecord": "spoiled"},
    )
    return F.coalesce((F.size(listed) == 1) & field.isNotNull() & field["spoiled"].isNull(), F.lit(False))


def json_line_validity(df: DataFrame, column: str = "value") -> DataFrame:
    """One row: lines and lines that are not JSON (blank ones included)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(~is_json(F.col(column))).alias("n_corrupt"),
    )
