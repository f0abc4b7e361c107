"""CSV tables, snapshots and table registration."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def check_identifier(name: str) -> str:
    if not IDENTIFIER.fullmatch(name):
        raise ValueError(f"unsafe identifier: {name!r}")
    return name


def validate_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV, from its raw first line.

    Spark renames duplicate columns without a word, so the line is checked
    before the reader sees it. Runs one job that reads one line.
    """
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"{path}: no header line")
    line = first[0]["value"].removeprefix("﻿")
    names = next(csv.reader([line]), [])
    if not names or any(not name.strip() for name in names):
        raise ValueError(f"{path}: a column has no name")
    if len(names) != len(set(names)):
        raise ValueError(f"{path}: two columns share a name")
    return names


def read_table_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    malformed: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Header CSV with empty cells as NULL; all columns are text unless a schema is given.

    Every file's header must match the schema, in order. Cells may hold line breaks;
    ``multi_line=False`` is for files that are known to have none, and lets Spark split them.
    A row with too few or too many cells keeps those that have a column;
    ``malformed`` names a further column with the whole line of such a row, and
    ``strict`` stops at the first one instead.
    """
    if schema is None:
        names = validate_header(spark, path)
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    if malformed is not None:
        if malformed in schema.names:
            raise ValueError(f"{path}: there is a column {malformed!r}")
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .option("columnNameOfCorruptRecord", malformed or "")
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_if_present(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame | None:
    """Parquet files below a path, folders inside included; None where there is no such path."""
    reader = spark.read.option("recursiveFileLookup", True)
    try:
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def missing_tables(available: Iterable[str], expected: Iterable[str]) -> list[str]:
    """Required names that are not there, in the order required."""
    present = set(available)
    return [name for name in expected if name not in present]


def require_tables(available: Iterable[str], expected: Iterable[str]) -> None:
    missing = missing_tables(available, expected)
    if missing:
        raise ValueError(f"required tables are missing: {missing}")


def snapshot_tables(
    frames: Mapping[str, DataFrame], directory: str, codec: str = "snappy"
) -> dict[str, str]:
    """Write each table once, compressed, below ``directory``; returns the paths."""
    paths = {}
    for name, frame in frames.items():
        paths[name] = f"{directory.rstrip('/')}/{check_identifier(name)}"
        frame.write.mode("overwrite").option("compression", codec).parquet(paths[name])
    return paths


def register_tables(spark: SparkSession, directory: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Expose snapshot files as temporary views of the same names."""
    frames = {}
    for name in names:
        frames[name] = spark.read.parquet(f"{directory.rstrip('/')}/{check_identifier(name)}")
        frames[name].createOrReplaceTempView(name)
    return frames


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, rows_count; one union of counts, each answered from file footers."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows_count")).select(
            F.lit(name).alias("table_name"), "rows_count"
        )
        for name, frame in frames.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result
