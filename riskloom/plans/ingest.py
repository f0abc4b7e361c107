"""From CSV files to a typed, audited snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.longform import POSITION, long_cells, named, quoted
from riskloom.operators.quality import key_problems
from riskloom.sources.schema import (
    DECLARED_TYPES,
    cast_to_schema,
    declared_types,
    infer_schema,
    normalize_columns,
    spark_type,
)
from riskloom.sources.sinks import project_with_partition_last, write_partitioned_bucketed
from riskloom.sources.tables import check_identifier, read_table_csv, snapshot_tables


#: Column for the lines of malformed rows while they are counted.
MALFORMED = "_malformed_line"


@dataclass(frozen=True)
class TableSpec:
    """A CSV table: its key, the types that are given, and the table its key refers to."""

    name: str
    path: str
    key: str = "TransactionID"
    declared: Mapping[str, str] | None = None
    parent: str | None = None
    multi_line: bool = True
    strict: bool = False


def spec_types(spark: SparkSession, spec: TableSpec, sample_rows: int | None = None) -> dict[str, str]:
    """Declared types, and inferred ones for the other columns; the key is a long. Runs the inference job."""
    text = read_table_csv(spark, spec.path, multi_line=spec.multi_line, strict=spec.strict)
    return declared_types(infer_schema(text, sample_rows, {spec.key: "BIGINT", **(spec.declared or {})}))


def typed_table(
    spark: SparkSession, spec: TableSpec, sample_rows: int | None = None, types: Mapping[str, str] | None = None
) -> DataFrame:
    """Header checked, types inferred (unless given) and cast, names normalised."""
    check_identifier(spec.name)
    text = read_table_csv(spark, spec.path, multi_line=spec.multi_line, strict=spec.strict)
    return normalize_columns(cast_to_schema(text, types or spec_types(spark, spec, sample_rows)))


def cell_problems(spark: SparkSession, spec: TableSpec, types: Mapping[str, str]) -> DataFrame:
    """problem, n_rows: rows with too few or too many cells, and per column the cells that do not fit their type.

    Only problems that occur have a row. One scan of the text.
    """
    text = read_table_csv(spark, spec.path, multi_line=spec.multi_line, malformed=MALFORMED)
    typed = [name for name, kind in types.items() if kind.upper() in DECLARED_TYPES and kind.upper() != "TEXT"]
    lost = [
        (F.trim(F.col(quoted(name))) != "") & F.col(quoted(name)).try_cast(spark_type(types[name])).isNull()
        for name in typed
    ]
    problems = ["malformed row", *[f"cell of no {types[name]} in {name}" for name in typed]]
    found = long_cells(text, [F.col(MALFORMED).isNotNull(), *lost], "found").where("found")
    counts = found.groupBy(POSITION).agg(F.count(F.lit(1)).alias("n_rows"))
    return named(counts, problems, "problem")


def audit(tables: Mapping[str, DataFrame], specs: Sequence[TableSpec]) -> DataFrame:
    """table_name, problem, n_rows for broken keys; one row per table and kind of problem."""
    parts = []
    for spec in specs:
        parent = tables[spec.parent] if spec.parent else None
        found = key_problems(tables[spec.name], spec.key.lower(), parent)
        parts.append(_in_table(spec.name, found))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _in_table(name: str, problems: DataFrame) -> DataFrame:
    return problems.select(F.lit(name).alias("table_name"), "problem", "n_rows")


def run_ingest(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    directory: str,
    sample_rows: int | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Typed tables as a compressed snapshot below ``directory``, and their audit.

    The audit counts broken keys, malformed rows and cells that were lost to
    their type. A table with ``strict`` stops at its first malformed row.
    """
    types = {spec.name: spec_types(spark, spec, sample_rows) for spec in specs}
    typed = {spec.name: typed_table(spark, spec, types=types[spec.name]) for spec in specs}
    paths = snapshot_tables(typed, directory)
    stored = {name: spark.read.parquet(path) for name, path in paths.items()}
    problems = audit(stored, specs)
    for spec in specs:
        problems = problems.unionByName(_in_table(spec.name, cell_problems(spark, spec, types[spec.name])))
    return stored, problems


def publish_transactions(
    transactions: DataFrame, table: str, label: str = "isfraud", buckets: int = 4, path: str | None = None
) -> DataFrame:
    """The analysis table: label last as ``is_fraud``, split by it, bucketed on the key."""
    shaped = project_with_partition_last(transactions, label, "is_fraud")
    write_partitioned_bucketed(shaped, table, "is_fraud", "transactionid", buckets, path=path)
    return transactions.sparkSession.table(table)
