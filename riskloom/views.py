"""The column roles of the analysis, filled from the driver tables.

Each view is as narrow as its query: attributes of a dimension are joined by the
query, after the facts have been summed to the join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.rates import rate_partials

MONEY_SCALE = 2
SALES_BAND_EDGES = (10_000, 25_000, 50_000, 80_000)
SALES_BAND_LABELS = (
    "00_under_10000",
    "01_10000_24999",
    "02_25000_49999",
    "03_50000_79999",
    "04_80000_plus",
)
SALES_MIN_ROWS = 50
SALES_START = "1992-01-01"
EVENTS_START = "2024-01-01"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, directory: str) -> DataFrame:
    """``txn`` without card columns: events as transactions, user_id kept for the card join."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    return table(spark, directory, "events").select(
        F.col("event_id").alias("transactionid"),
        F.timestamp_diff("SECOND", F.lit(EVENTS_START).cast("timestamp_ntz"), F.col("ts")).alias(
            "transactiondt"
        ),
        k.alias("k"),
        F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("transactionamt"),
        F.when(k < 20, 1).otherwise(0).alias("is_fraud"),
        F.col("event_type").alias("productcd"),
        F.when(F.col("user_id") % 7 != 0, F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string"))).alias(
            "p_emaildomain"
        ),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("src"), (k % 20).cast("string"))).alias("r_emaildomain"),
        "user_id",
    )


def cards(spark: SparkSession, directory: str) -> DataFrame:
    """user_id with card4 (market segment) and card6 (sign of the balance)."""
    return table(spark, directory, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("card4"),
        F.when(F.col("c_acctbal") < 0, "overdrawn").otherwise("credit").alias("card6"),
    )


def transactions_with_cards(spark: SparkSession, directory: str) -> DataFrame:
    """``txn``: every transaction with its card columns."""
    return transactions(spark, directory).join(cards(spark, directory), "user_id", "left").drop("user_id")


def card_partials(spark: SparkSession, directory: str) -> DataFrame:
    """Rate sums per user with the user's card columns."""
    sums = rate_partials(
        transactions(spark, directory),
        ["user_id"],
        F.col("is_fraud"),
        F.col("transactionamt"),
        MONEY_SCALE,
    )
    return sums.join(cards(spark, directory), "user_id", "left")


def identity(spark: SparkSession, directory: str) -> DataFrame:
    """``identity``: labels as identity columns, zeros as NULL."""
    return table(spark, directory, "labels").select(
        F.col("doc_id").alias("transactionid"),
        F.nullif("quality", F.lit(0)).alias("id_01"),
        F.nullif("toxic", F.lit(0)).alias("id_02"),
    )


def sales(spark: SparkSession, directory: str) -> DataFrame:
    """Line items as transactions, without attributes of other tables."""
    return table(spark, directory, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.timestamp_diff("SECOND", F.lit(SALES_START).cast("timestamp_ntz"), F.col("l_shipdate")).alias(
            "transactiondt"
        ),
        F.col("l_extendedprice").alias("transactionamt"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_fraud"),
        F.col("l_linestatus").alias("card4"),
    )


def sales_partials(spark: SparkSession, directory: str, keys: list[str]) -> DataFrame:
    return rate_partials(
        sales(spark, directory), keys, F.col("is_fraud"), F.col("transactionamt"), MONEY_SCALE
    )


def sales_by_part(spark: SparkSession, directory: str) -> DataFrame:
    """Rate sums per part with productcd (the part's type)."""
    types = table(spark, directory, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("productcd")
    )
    return sales_partials(spark, directory, ["l_partkey"]).join(types, "l_partkey")


def sales_by_order(spark: SparkSession, directory: str, keys: list[str]) -> DataFrame:
    """Rate sums per order (and ``keys``) with card6 (priority) and p_emaildomain (the customer)."""
    orders = table(spark, directory, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderpriority").alias("card6"),
        F.col("o_custkey").alias("p_emaildomain"),
    )
    return sales_partials(spark, directory, ["l_orderkey", *keys]).join(orders, "l_orderkey")


def documents(spark: SparkSession, directory: str) -> DataFrame:
    """``docs``: documents with their quality as label, NULL where unlabelled."""
    labels = table(spark, directory, "labels").select("doc_id", F.col("quality").alias("label"))
    return (
        table(spark, directory, "documents")
        .select("doc_id", "lang", "source", "n_chars")
        .join(labels, "doc_id", "left")
    )


def scores(spark: SparkSession, directory: str) -> DataFrame:
    """``scores``: a score, a label and a prediction per transaction with an amount."""
    amount = F.col("transactionamt")
    return (
        transactions(spark, directory)
        .where(amount.isNotNull())
        .select(
            "transactionid",
            (amount / 500).alias("score"),
            F.col("is_fraud").alias("label"),
            F.when(amount >= 25, 1).otherwise(0).alias("prediction"),
        )
    )


def vectors(spark: SparkSession, directory: str) -> DataFrame:
    """``emb``: vec_id, a binary label and the embedding."""
    return table(spark, directory, "embeddings").select(
        "vec_id", F.when(F.col("label") < 5, 1).otherwise(0).alias("label"), "embedding"
    )
