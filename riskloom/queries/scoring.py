"""Exact ranking metrics, confusion metrics and the cross-validation log."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import views as v
from riskloom.functions.amounts import minor_units
from riskloom.operators import cvlog as c
from riskloom.operators import metrics as m
from riskloom.operators.sampling import with_folds
from riskloom.queries.frame import six, sql_six
from riskloom.queries.registry import SCORES, TXN, cents, md5_bucket, query

POINTS = f"""WITH {SCORES}, hist AS (
  SELECT score, count(*) FILTER (label = 1) AS tp, count(*) FILTER (label <> 1) AS fp FROM scores GROUP BY score
), points AS (
  SELECT score, tp, fp, CAST(sum(tp) OVER w AS BIGINT) AS cum_tp, CAST(sum(fp) OVER w AS BIGINT) AS cum_fp FROM hist
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
)"""
AUC_SQL = f"""{POINTS}, steps AS (
  SELECT tp, fp, cum_tp, cum_fp, CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp) AS p,
         lag(CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp)) OVER (ORDER BY score DESC) AS q FROM points
) SELECT CAST(sum(tp) AS BIGINT) AS n_positive, CAST(sum(fp) AS BIGINT) AS n_negative,
  {sql_six("sum(CAST(fp AS DOUBLE) * (2 * cum_tp - tp)) / (2.0 * sum(tp) * sum(fp))")} AS auc_roc,
  {sql_six("sum(tp * (p + coalesce(q, p)) / 2) / sum(tp)")} AS auc_pr FROM steps"""


def _auc(frame, *groups):
    return frame.select(
        *groups, "n_positive", "n_negative", six(F.col("auc_roc")).alias("auc_roc"), six(F.col("auc_pr")).alias("auc_pr")
    )


@query("auc_exact", AUC_SQL)
def auc_exact(spark, sf_dir):
    return _auc(m.ranking_metrics(v.scores(spark, sf_dir)))


@query("auc_exact_ranged", AUC_SQL)
def auc_exact_ranged(spark, sf_dir):
    """The same through 16 score ranges, as a large table would take it."""
    return _auc(m.ranking_metrics(v.scores(spark, sf_dir), buckets=16))


@query("auc_by_group", f"""WITH {TXN}, scored AS (
  SELECT 'amount' AS model, k % 3 AS fold, transactionamt AS score, is_fraud AS label FROM txn
  UNION ALL SELECT 'time', k % 3, transactiondt % 86400, is_fraud FROM txn
  UNION ALL SELECT 'key', k % 3, k, is_fraud FROM txn
), hist AS (
  SELECT model, fold, score, count(*) FILTER (label = 1) AS tp, count(*) FILTER (label <> 1) AS fp FROM scored WHERE score IS NOT NULL GROUP BY ALL
), points AS (
  SELECT *, sum(tp) OVER w AS cum_tp, sum(fp) OVER w AS cum_fp FROM hist
  WINDOW w AS (PARTITION BY model, fold ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
), steps AS (
  SELECT model, fold, tp, fp, cum_tp, cum_fp, CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp) AS p,
         lag(CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp)) OVER (PARTITION BY model, fold ORDER BY score DESC) AS q FROM points
) SELECT model, fold, CAST(sum(tp) AS BIGINT) AS n_positive, CAST(sum(fp) AS BIGINT) AS n_negative,
  """ + sql_six("sum(CAST(fp AS DOUBLE) * (2 * cum_tp - tp)) / nullif(2.0 * sum(tp) * sum(fp), 0)") + " AS auc_roc, "
       + sql_six("sum(tp * (p + coalesce(q, p)) / 2) / nullif(sum(tp), 0)") + " AS auc_pr FROM steps GROUP BY model, fold")
def auc_by_group(spark, sf_dir):
    """Areas of three score columns in three folds by one chain of jobs."""
    txn = v.transactions(spark, sf_dir)
    columns = {"amount": "transactionamt", "time": "CAST(transactiondt % 86400 AS DOUBLE)", "key": "CAST(k AS DOUBLE)"}
    scores = ", ".join(f"'{model}', {score}" for model, score in columns.items())
    scored = txn.select((F.col("k") % 3).alias("fold"), F.expr(f"stack(3, {scores}) AS (model, score)"), F.col("is_fraud").alias("label"))
    return _auc(m.grouped_ranking_metrics(scored, ["model", "fold"], buckets=8), "model", "fold")


@query("score_points", f"{POINTS} SELECT * FROM points")
def score_points(spark, sf_dir):
    return m.score_points(v.scores(spark, sf_dir), buckets=200)


@query("roc_points",
       f"{POINTS} SELECT score, CAST(cum_tp AS DOUBLE) / (SELECT sum(tp) FROM hist) AS tpr, "
       "CAST(cum_fp AS DOUBLE) / (SELECT sum(fp) FROM hist) AS fpr, CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp) AS \"precision\" FROM points")
def roc_points(spark, sf_dir):
    return m.roc_points(v.scores(spark, sf_dir))


@query("sales_auc_exact", """WITH hist AS (
  SELECT l_extendedprice AS score, count(*) FILTER (l_returnflag = 'R') AS tp, count(*) FILTER (l_returnflag <> 'R') AS fp
  FROM lineitem GROUP BY 1
), points AS (
  SELECT score, tp, fp, sum(tp) OVER w AS cum_tp, sum(fp) OVER w AS cum_fp FROM hist
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
), steps AS (
  SELECT tp, fp, cum_tp, cum_fp, CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp) AS p,
         lag(CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp)) OVER (ORDER BY score DESC) AS q FROM points
) SELECT CAST(sum(tp) AS BIGINT) AS n_positive, CAST(sum(fp) AS BIGINT) AS n_negative,
  """ + sql_six("sum(CAST(fp AS DOUBLE) * (2 * cum_tp - tp)) / (2.0 * sum(tp) * sum(fp))") + " AS auc_roc, "
       + sql_six("sum(tp * (p + coalesce(q, p)) / 2) / sum(tp)") + " AS auc_pr FROM steps")
def sales_auc_exact(spark, sf_dir):
    items = v.table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("score"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
    )
    return _auc(m.ranking_metrics(items))


@query("confusion", f"WITH {SCORES} SELECT label, prediction, count(*) AS n_rows FROM scores GROUP BY 1, 2")
def confusion(spark, sf_dir):
    return m.confusion(v.scores(spark, sf_dir))


@query("f1_accuracy", f"""WITH {SCORES}, classes AS (
  SELECT c AS class, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS guessed,
         count(*) FILTER (label = c AND prediction = c) AS hits FROM scores, (VALUES (0), (1)) t(c) GROUP BY c
) SELECT {sql_six("sum(support * (2.0 * hits / (support + guessed))) / sum(support)")} AS f1,
  CAST(sum(hits) AS DOUBLE) / sum(support) AS accuracy FROM classes""")
def f1_accuracy(spark, sf_dir):
    result = m.f1_accuracy(v.scores(spark, sf_dir))
    return result.select(six(F.col("f1")).alias("f1"), "accuracy")


FOLDS = f"""WITH {TXN}, folds AS (
  SELECT productcd AS model_name, 1 + k % 9 AS combo_index,
         1 + {md5_bucket('CAST(transactionid AS VARCHAR)')} % 3 AS fold_index,
         CAST(sum(is_fraud) AS DOUBLE) / count(*) AS fold_metric_pr FROM txn GROUP BY 1, 2, 3
)"""


def _nine(column):
    return column.cast("decimal(18,9)").cast("double")


def cv_folds(spark, sf_dir):
    """A log derived from the data: flag rate per category, remainder of k and key fold."""
    rate = (F.sum("is_fraud") / F.count(F.lit(1))).alias("fold_metric_pr")
    return (
        with_folds(v.transactions(spark, sf_dir), "transactionid", 3, portable=True)
        .groupBy(
            F.col("productcd").alias("model_name"),
            (F.col("k") % 9 + 1).alias("combo_index"),
            (F.col("cv_fold") + 1).alias("fold_index"),
        )
        .agg(rate)
    )


@query("cv_running_mean",
       f"{FOLDS} SELECT model_name, combo_index, fold_index, CAST(CAST(avg(fold_metric_pr) OVER (PARTITION BY model_name, combo_index "
       "ORDER BY fold_index ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,9)) AS DOUBLE) AS combo_mean_metric_pr FROM folds")
def cv_running_mean(spark, sf_dir):
    running = c.running_fold_means(cv_folds(spark, sf_dir))
    return running.select(
        "model_name", "combo_index", "fold_index", _nine(F.col("combo_mean_metric_pr")).alias("combo_mean_metric_pr")
    )


MEANS = f"{FOLDS}, means AS (SELECT model_name, combo_index, CAST(CAST(avg(fold_metric_pr) AS DECIMAL(18,9)) AS DOUBLE) AS metric_pr FROM folds GROUP BY 1, 2)"


def cv_means(spark, sf_dir):
    means = c.combo_means(cv_folds(spark, sf_dir))
    return means.withColumn("metric_pr", _nine(F.col("metric_pr")))


@query("cv_combo_means", f"{MEANS} SELECT * FROM means")
def combo_means(spark, sf_dir):
    return cv_means(spark, sf_dir)


@query("best_combo",
       f"{MEANS} SELECT model_name, combo_index, metric_pr FROM (SELECT *, row_number() OVER "
       "(PARTITION BY model_name ORDER BY metric_pr DESC, combo_index) AS r FROM means) WHERE r = 1")
def best_combo(spark, sf_dir):
    return c.best_combo(cv_means(spark, sf_dir))


@query("best_logged",
       f"{MEANS} SELECT model_name, CAST(combo_index AS INT) AS combo_index, metric_pr AS combo_mean_metric_pr, "
       "concat('combo ', combo_index) AS params_json FROM (SELECT *, row_number() OVER "
       "(PARTITION BY model_name ORDER BY metric_pr DESC, combo_index) AS r FROM means) WHERE r = 1")
def best_logged(spark, sf_dir):
    """The best summary row of a log that holds fold rows as well."""
    folds = cv_folds(spark, sf_dir).select(
        "model_name",
        "combo_index",
        F.col("fold_index").cast("string").alias("fold_index"),
        F.col("fold_metric_pr").alias("combo_mean_metric_pr"),
    )
    summaries = cv_means(spark, sf_dir).select(
        "model_name", "combo_index", F.lit("summary").alias("fold_index"), F.col("metric_pr").alias("combo_mean_metric_pr")
    )
    text = F.concat(F.lit("combo "), F.col("combo_index").cast("string")).alias("params_json")
    return c.best_logged(folds.unionByName(summaries).select("*", text))


@query("cv_eta", f"""WITH {TXN}, combos AS (
  SELECT productcd AS model_name, 1 + k % 9 AS combo_index, 9 AS combo_total, sum({cents('transactionamt')}) AS units
  FROM txn GROUP BY 1, 2
) SELECT model_name, combo_index, CAST(sum(units) OVER w AS DOUBLE) / 100 AS elapsed_seconds,
  {sql_six("CAST(sum(units) OVER w AS DOUBLE) / 100 / count(*) OVER w * (combo_total - combo_index)")} AS eta_seconds FROM combos
WINDOW w AS (PARTITION BY model_name ORDER BY combo_index ROWS UNBOUNDED PRECEDING)""")
def cv_eta(spark, sf_dir):
    combos = (
        v.transactions(spark, sf_dir)
        .groupBy(F.col("productcd").alias("model_name"), (F.col("k") % 9 + 1).alias("combo_index"))
        .agg(
            F.lit(9).alias("combo_total"),
            F.sum(minor_units(F.col("transactionamt"), v.MONEY_SCALE)).alias("combo_seconds"),
        )
    )
    timed = c.time_left(combos)
    return timed.select(
        "model_name",
        "combo_index",
        (F.col("elapsed_seconds") / 100).alias("elapsed_seconds"),
        six(F.col("eta_seconds") / 100).alias("eta_seconds"),
    )
