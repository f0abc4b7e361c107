"""Column names, inferred types and casts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.longform import POSITION, long_cells, names_table, quoted

# Declared type -> Spark type; anything else is a string.
DECLARED_TYPES = {
    "BIGINT": T.LongType(),
    "SMALLINT": T.IntegerType(),
    "NUMERIC": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TEXT": T.StringType(),
}
# What counts as a whole number and as a number in a text cell.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
DECIMAL_PATTERN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def normalized_name(name: str) -> str:
    return name.strip().lower().replace("-", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case names with ``_`` for ``-``; two names that meet are an error."""
    names = [normalized_name(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"columns collide after normalising: {clashes}")
    return df.toDF(*names)


def spark_type(declared: str) -> T.DataType:
    return DECLARED_TYPES.get(declared.upper(), T.StringType())


def cast_to_schema(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Cast every listed column in one projection; unlisted columns pass through.

    A cell that does not fit its type becomes NULL instead of stopping the job.
    """
    unknown = set(declared) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.select(
        *[
            F.col(quoted(name)).try_cast(spark_type(declared[name])).alias(name)
            if name in declared
            else F.col(quoted(name))
            for name in df.columns
        ]
    )


def _cell(name: str) -> Column:
    return F.nullif(F.trim(F.col(quoted(name))), F.lit(""))


def infer_schema(
    df: DataFrame,
    sample_rows: int | None = None,
    overrides: Mapping[str, str] | None = None,
    booleans: Iterable[str] = (),
) -> DataFrame:
    """One row per text column: column_name, non_empty, inferred_type.

    All whole numbers that fit a long -> BIGINT, else all numbers -> NUMERIC,
    else TEXT; a column without values is TEXT. All columns go through the same
    small aggregate in one scan. ``sample_rows`` looks at that many rows only; the
    default is the whole table, since a type that later rows do not fit would lose their cells. ``booleans`` names columns that may become BOOLEAN
    when they hold nothing but True and False.
    """
    overrides = dict(overrides or {})
    booleans = set(booleans)
    source = df if sample_rows is None else df.limit(sample_rows)
    cell = F.col("value")
    whole = cell.rlike(INTEGER_PATTERN) & cell.try_cast("bigint").isNotNull()
    seen = (
        long_cells(source, [_cell(name) for name in df.columns])
        .where(cell.isNotNull())
        .groupBy(POSITION)
        .agg(
            F.count(cell).alias("non_empty"),
            F.bool_and(whole).alias("whole"),
            F.bool_and(cell.rlike(DECIMAL_PATTERN)).alias("number"),
            F.bool_and(cell.isin("True", "False")).alias("truth"),
        )
    )
    named_stats = names_table(df, df.columns, "column_name").join(seen, POSITION, "left")
    name = F.col("column_name")
    inferred = F.when(F.lit(False), F.lit(None).cast("string"))
    for column, kind in overrides.items():
        inferred = inferred.when(name == column, F.lit(kind))
    return named_stats.select(
        "column_name",
        F.coalesce("non_empty", F.lit(0)).alias("non_empty"),
        inferred.when(name.isin(*booleans) & F.col("truth"), "BOOLEAN")
        .when(F.col("whole"), "BIGINT")
        .when(F.col("number"), "NUMERIC")
        .otherwise("TEXT")
        .alias("inferred_type"),
    ).orderBy(POSITION)


def declared_types(inferred: DataFrame) -> dict[str, str]:
    """Bring the result of :func:`infer_schema` (one row per column) to the driver."""
    return {row["column_name"]: row["inferred_type"] for row in inferred.collect()}


def struct_type(declared: Mapping[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, spark_type(kind)) for name, kind in declared.items()])
