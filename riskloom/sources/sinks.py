"""Partitioned tables, materialised results and exports."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.longform import quoted


def project_with_partition_last(df: DataFrame, source: str, partition: str) -> DataFrame:
    """All other columns in order, then ``source`` renamed to ``partition``."""
    others = [name for name in df.columns if name != source]
    return df.select(*others, F.col(source).cast("int").alias(partition))


def _placed(df: DataFrame, bucket: Sequence[str], buckets: int, files_per_bucket: int) -> DataFrame:
    """Rows in the task of their bucket and of the hash of all their cells."""
    number = F.pmod(F.hash(*[F.col(quoted(name)) for name in bucket]), F.lit(buckets))
    hashable = [quoted(name) for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    place = F.pmod(F.xxhash64(*hashable), F.lit(files_per_bucket)).cast("int")
    return df.repartitionById(buckets * files_per_bucket, number * files_per_bucket + place)


def write_partitioned_bucketed(
    df: DataFrame,
    table: str,
    partition: str,
    bucket: str,
    buckets: int = 4,
    files_per_bucket: int | None = None,
    path: str | None = None,
) -> None:
    """ORC/Snappy table split by ``partition`` and bucketed on ``bucket``.

    Rows of one bucket meet in ``files_per_bucket`` tasks before the write, so
    the file count is known and few buckets still write with all tasks; the
    default spreads a bucket over the session's shuffle partitions. Tasks are
    numbered directly, and a row's place inside its bucket follows from all its
    cells, so every task has work and rows sharing a hot bucket value are split.
    Inserts into the table replace only the partitions they hold.
    """
    if files_per_bucket is None:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        files_per_bucket = max(1, tasks // buckets)
    spread = _placed(df, [bucket], buckets, files_per_bucket)
    writer = (
        spread.write.mode("overwrite")
        .format("orc")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .bucketBy(buckets, bucket)
        .sortBy(bucket)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def overwrite_partitions(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Replace only the partitions that occur in ``df``; columns are matched by name.

    The table itself is told to replace partitions one by one, so no setting of
    the session changes. Rows of a bucketed table are placed as its first write does.
    """
    details = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES ('partitionOverwriteMode' = 'dynamic')")
    rows = df.select(*[quoted(name) for name in spark.table(table).columns])
    if details.get("Num Buckets"):
        names = re.findall(r"`([^`]+)`", details["Bucket Columns"])
        buckets = int(details["Num Buckets"])
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = _placed(rows, names, buckets, max(1, tasks // buckets))
    rows.write.insertInto(table, overwrite=True)


def materialize_result(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Write a result as an ORC/Snappy table and read it back.

    A table keeps no order; sort again where the order matters.
    """
    writer = df.write.mode("overwrite").format("orc").option("compression", "snappy")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def export_csv(df: DataFrame, path: str, single_file: bool = False, escape: str = "\\") -> None:
    """Header CSV. ``single_file`` is for report-sized results: it writes through one task.

    Quotes are escaped by a backslash, as readers of the reports expect;
    :func:`export_table_csv` writes what the table reader reads.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", escape).csv(path)


def export_table_csv(df: DataFrame, path: str) -> None:
    """Header CSV in the dialect of the table reader: quotes doubled, every text in quotes.

    A quoted cell keeps its quotes, backslashes, line breaks and white space at its ends.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("escapeQuotes", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, written in parallel; NULL fields are kept out."""
    df.write.mode("overwrite").json(path)
