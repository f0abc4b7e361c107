"""Class counts, balance, samples, splits and folds; hashes in their portable form."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import views as v
from riskloom.functions.categories import weight_by_label
from riskloom.operators import quality as q
from riskloom.operators import sampling as s
from riskloom.queries.registry import DOCS, TXN, md5_bucket, query

RANGE = 4294967296.0


def salted(salt: str, key: str = "transactionid") -> str:
    return md5_bucket(f"'{salt}|' || CAST({key} AS VARCHAR)")


@query("label_counts", f"WITH {TXN} SELECT is_fraud, count(*) AS n_rows FROM txn GROUP BY is_fraud")
def label_counts(spark, sf_dir):
    return q.label_counts(v.transactions(spark, sf_dir), "is_fraud")


@query("classes_present",
       f"WITH {DOCS} SELECT count(*) FILTER (label = 0) AS n_negative, count(*) FILTER (label = 1) AS n_positive, "
       "count(*) FILTER (label = 0) > 0 AND count(*) FILTER (label = 1) > 0 AS both_present FROM docs")
def classes_present(spark, sf_dir):
    return q.classes_present(v.documents(spark, sf_dir))


@query("class_weights",
       f"WITH {DOCS}, c AS (SELECT CAST(label AS INT) AS label, count(*) AS n_rows FROM docs WHERE label IN (0, 1) GROUP BY 1) "
       "SELECT label, n_rows, CAST((SELECT sum(n_rows) FROM c) AS DOUBLE) / (2 * n_rows) AS class_weight FROM c")
def class_weights(spark, sf_dir):
    return s.class_weights(v.documents(spark, sf_dir))


@query("balance_fraction",
       f"WITH {TXN} SELECT count(*) FILTER (is_fraud = 1) AS n_positive, count(*) FILTER (is_fraud = 0) AS n_negative, "
       "least(1.0, CAST(count(*) FILTER (is_fraud = 1) AS DOUBLE) / count(*) FILTER (is_fraud = 0)) AS fraction FROM txn")
def balance_fraction(spark, sf_dir):
    return s.negative_fraction(v.transactions(spark, sf_dir), "is_fraud")


@query("balanced_sample",
       f"WITH {TXN}, f AS (SELECT least(1.0, CAST(count(*) FILTER (is_fraud = 1) AS DOUBLE) / count(*) FILTER (is_fraud = 0)) AS fraction FROM txn) "
       f"SELECT transactionid, is_fraud FROM txn, f WHERE is_fraud = 1 OR {salted('balance')} < fraction * {RANGE}")
def balanced_sample(spark, sf_dir):
    return s.balanced_sample(
        v.transactions(spark, sf_dir), "transactionid", "is_fraud", salt="balance", portable=True
    ).select("transactionid", "is_fraud")


@query("balanced_documents",
       f"WITH {DOCS}, f AS (SELECT least(1.0, CAST(count(*) FILTER (label = 1) AS DOUBLE) / count(*) FILTER (label = 0)) AS fraction FROM docs) "
       f"SELECT label, count(*) AS n_rows FROM docs, f WHERE label = 1 OR (label = 0 AND {salted('balance', 'doc_id')} < fraction * {RANGE}) GROUP BY label")
def balanced_documents(spark, sf_dir):
    """More positives than negatives: nothing to take away, unlabelled rows go."""
    sample = s.balanced_sample(v.documents(spark, sf_dir), "doc_id", salt="balance", portable=True)
    return q.label_counts(sample)


@query("stratified_sample",
       f"WITH {TXN} SELECT transactionid, is_fraud FROM txn WHERE (is_fraud = 0 AND {salted('smoke')} < 0.02::DOUBLE * {RANGE}) "
       f"OR (is_fraud = 1 AND {salted('smoke')} < 0.05::DOUBLE * {RANGE})")
def stratified_sample(spark, sf_dir):
    """A sampling operator: its rows are those whose key hash falls below the class's share."""
    return s.stratified_sample(
        v.transactions(spark, sf_dir),
        "transactionid",
        {0: 0.02, 1: 0.05},
        "is_fraud",
        salt="smoke",
        portable=True,
    ).select("transactionid", "is_fraud")


@query("split_parts",
       f"WITH {TXN} SELECT CASE WHEN {salted('split')} < 0.7::DOUBLE * {RANGE} THEN 0 ELSE 1 END AS part, is_fraud, count(*) AS n_rows "
       "FROM txn GROUP BY 1, 2")
def split_parts(spark, sf_dir):
    part = s.split_part("transactionid", (0.7, 0.3), portable=True)
    return (
        v.transactions(spark, sf_dir)
        .groupBy(part.alias("part"), "is_fraud")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


FOLD = f"{md5_bucket('CAST(transactionid AS VARCHAR)')} % 3"


@query("fold_counts", f"WITH {TXN} SELECT {FOLD} AS cv_fold, count(*) AS n_rows FROM txn GROUP BY 1")
def fold_counts(spark, sf_dir):
    folds = s.with_folds(v.transactions(spark, sf_dir), "transactionid", 3, portable=True)
    return folds.groupBy("cv_fold").agg(F.count(F.lit(1)).alias("n_rows"))


@query("fold_assignment", f"WITH {TXN} SELECT transactionid, {FOLD} AS cv_fold FROM txn")
def fold_assignment(spark, sf_dir):
    folds = s.with_folds(v.transactions(spark, sf_dir), "transactionid", 3, portable=True)
    return folds.select("transactionid", "cv_fold")


@query("weighted_rows",
       f"WITH {TXN}, c AS (SELECT is_fraud AS label, count(*) AS n FROM txn GROUP BY 1) "
       "SELECT transactionid, CAST((SELECT sum(n) FROM c) AS DOUBLE) / (2 * n) AS class_weight FROM txn JOIN c ON is_fraud = label")
def weighted_rows(spark, sf_dir):
    """Every row with the weight of its class; the two weights come to the driver."""
    txn = v.transactions(spark, sf_dir)
    weights = s.fit_class_weights(txn, "is_fraud")
    return txn.select("transactionid", weight_by_label(F.col("is_fraud"), weights).alias("class_weight"))


@query("training_fold_counts",
       f"WITH {TXN}, f AS (SELECT least(1.0, CAST(count(*) FILTER (is_fraud = 1) AS DOUBLE) / count(*) FILTER (is_fraud = 0)) AS fraction FROM txn), "
       f"kept AS (SELECT * FROM txn, f WHERE is_fraud = 1 OR {salted('balance')} < fraction * {RANGE}) "
       f"SELECT {FOLD} AS cv_fold, is_fraud, count(*) AS n_rows FROM kept WHERE {salted('split')} < 0.7::DOUBLE * {RANGE} GROUP BY 1, 2")
def training_fold_counts(spark, sf_dir):
    """Balance, training part and folds in a row: three filters and one small count."""
    kept = s.balanced_sample(
        v.transactions(spark, sf_dir), "transactionid", "is_fraud", salt="balance", portable=True
    )
    train = kept.where(s.split_part("transactionid", portable=True) == 0)
    folds = s.with_folds(train, "transactionid", 3, portable=True)
    return folds.groupBy("cv_fold", "is_fraud").agg(F.count(F.lit(1)).alias("n_rows"))


@query("balance_branches",
       f"WITH {TXN}, n AS (SELECT count(*) AS rows, count(*) FILTER (is_fraud = 1) AS positives FROM txn) "
       "SELECT 'smoke' AS branch, positives AS n_positive, rows AS n_rows FROM n "
       "UNION ALL SELECT 'whole fraction', positives, rows FROM n "
       "UNION ALL SELECT 'few positives', positives, rows FROM n "
       "UNION ALL SELECT 'one class', 0, rows - positives FROM n "
       "UNION ALL SELECT 'balanced', positives, NULL FROM n")
def balance_branches(spark, sf_dir):
    """Every way the training-size reduction can go; balanced, its negatives are a sample and not counted here."""
    frame = v.transactions(spark, sf_dir).select("transactionid", F.col("is_fraud").alias("label"))
    key = "transactionid"
    branches = {
        "smoke": s.balance(frame, key, mode="smoke"),
        "whole fraction": s.balance(frame, key, balanced=False, fraction=1.0),
        "few positives": s.balance(frame, key, min_positive=2**40),
        "one class": s.balance(frame.where(F.col("label") == 0), key),
        "balanced": s.balance(frame, key),
    }
    counted = [
        rows.agg(
            F.lit(name).alias("branch"),
            F.count_if(F.col("label") == 1).alias("n_positive"),
            (F.lit(None).cast("bigint") if name == "balanced" else F.count(F.lit(1))).alias("n_rows"),
        )
        for name, rows in branches.items()
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result
