"""Column profiles that are stored by batch and merge: only a new batch is ever scanned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.hitters import TRACKED, frequent
from riskloom.operators.longform import POSITION, names_table, quoted
from riskloom.operators.profile import TOP_CATEGORIES, _fingerprint, _null_columns, _types, source_type

#: Registers of a distinct-count sketch are two to this power: a relative deviation of about 0.8 percent.
PRECISION = 14
BATCH = "batch"


def column_summary(df: DataFrame, columns: Sequence[str], tracked: int = TRACKED) -> DataFrame:
    """One row per column: feature_name, source_type, spark_type, n_rows, n_present, distinct, tops, all of which merge.

    ``distinct`` is a HyperLogLog sketch, ``tops`` a frequent-items summary (long
    texts by their digest) of bounded size. One scan; one row per task is
    shuffled. An empty table has summaries of nothing.
    """
    types = _types(df)
    names = list(columns)
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(names):
        measures += [
            F.expr(f"count({quoted(name)})").alias(f"n_{i}"),
            F.expr(f"hll_sketch_agg({_fingerprint(name, types[name])}, {PRECISION})").alias(f"d_{i}"),
            F.expr(frequent(name, types[name], tracked, merged=True)).alias(f"t_{i}"),
        ]
    cells = [F.struct(F.col(f"n_{i}").alias("n_present"), F.col(f"d_{i}").alias("distinct"), F.col(f"t_{i}").alias("tops")) for i in range(len(names))]
    found = df.agg(*measures).select("n_rows", F.posexplode(F.array(*cells)).alias(POSITION, "cell"))
    kinds = {"source_type": [source_type(types[n]) for n in names], "spark_type": [types[n].simpleString() for n in names]}
    return names_table(df, names, **kinds).join(found, POSITION).select(
        "feature_name", "source_type", "spark_type", "n_rows", "cell.n_present", "cell.distinct", "cell.tops"
    )


def store_summary(df: DataFrame, columns: Sequence[str], path: str, batch: str, tracked: int = TRACKED) -> None:
    """Summarise one batch of rows below ``path``; a batch that comes again replaces its own summary only."""
    rows = column_summary(df, columns, tracked).withColumn(BATCH, F.lit(batch))
    rows.coalesce(1).write.mode("overwrite").partitionBy(BATCH).option("partitionOverwriteMode", "dynamic").parquet(path)


def stored_profile(spark: SparkSession, path: str, top: int = TOP_CATEGORIES, tracked: int = TRACKED) -> DataFrame:
    """The profile of all stored batches together, without any of their rows.

    feature_name, source_type, spark_type, n_rows, n_null, null_ratio (exact),
    distinct_non_null (a sketch's estimate), dominant_ratio and
    top_category_coverage (upper bounds by the error of the summaries; 1.0 where
    there are no values). A column that some batches lack counts in the others; a
    column whose type changed has a row per type. One row per batch and column is read.
    """
    stored = spark.read.parquet(path)
    merged = stored.groupBy("feature_name", "source_type", "spark_type").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_present").alias("n_present"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_non_null"),
        F.expr(f"approx_top_k_combine(tops, {int(tracked)})").alias("tops"),
    )
    counts = F.transform(F.expr(f"approx_top_k_estimate(tops, {int(top)})"), lambda x: x["count"])
    merged = merged.withColumn("counts", counts)

    def share(rows: Column) -> Column:
        return F.when(F.col("n_present") > 0, F.least(rows / F.col("n_present"), F.lit(1.0))).otherwise(F.lit(1.0))

    return merged.select(
        "feature_name",
        "source_type",
        "spark_type",
        *_null_columns(),
        "distinct_non_null",
        share(F.coalesce(F.array_max("counts"), F.lit(0))).alias("dominant_ratio"),
        share(F.aggregate("counts", F.lit(0).cast("long"), lambda total, n: total + n)).alias("top_category_coverage"),
    )
