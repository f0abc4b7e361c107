"""Fitted pipelines and models. There is no SQL for a tree; what must hold around it has some."""

from __future__ import annotations

import functools
import operator
from dataclasses import replace

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskloom import views as v
from riskloom.operators import models as m
from riskloom.operators import trees
from riskloom.operators.cvlog import best_logged
from riskloom.operators.encode import build_pipeline, feature_names
from riskloom.operators.longform import names_table
from riskloom.operators.metrics import f1_accuracy
from riskloom.operators.quality import check_predictions
from riskloom.operators.sampling import fit_class_weights, split, split_part, with_folds
from riskloom.operators.selection import prepare_features, profile_features, fit_feature_plan
from riskloom.plans.modeling import modeling_frame
from riskloom.plans.training import encode_split, prediction_rows, train_models
from riskloom.queries.registry import TXN, md5_bucket, query
from riskloom.session import scratch_path

FULL = m.TrainingSettings(parallelism=4)
SMOKE = m.TrainingSettings(mode="smoke", smoke_fraction=1.0)


def training_frame(spark, sf_dir):
    """The modelling frame without ``k``, which decides the label."""
    transactions = v.transactions_with_cards(spark, sf_dir).drop("k")
    return modeling_frame(transactions, v.identity(spark, sf_dir))


def training_vectors(spark, sf_dir):
    return v.vectors(spark, sf_dir).select(
        F.col("vec_id").alias("transactionid"),
        F.col("label").cast("double").alias("label"),
        F.lit(1.0).alias("class_weight"),
        array_to_vector("embedding").alias("features"),
    )


def _predictions(spark, sf_dir, name):
    """Fit on 70 % of the vectors, score the rest."""
    train, test = split(training_vectors(spark, sf_dir), "transactionid")
    model = m.build_estimator(name, FULL).fit(train)
    scored = m.score(model, test)
    return prediction_rows({name: scored})


@query("gbt_predictions")
def gbt_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir, "gbt")


@query("rf_predictions")
def rf_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir, "rf")


# What the encoder must come to: every number of the frame varies, every category is kept.
NUMBERS = (
    "email_domain_match", "event_day", "event_hour_cos", "event_hour_sin", "event_minute_cos", "event_minute_sin",
    "event_second_cos", "event_second_sin", "identity_present", "log_transactionamt", "transactionamt", "transactiondt",
)
CATEGORIES = ("card4", "card6", "p_emaildomain", "productcd", "r_emaildomain")
DIMENSIONS = f"""WITH {TXN}, numbers AS (
  SELECT unnest({list(NUMBERS)}) || '_imputed' AS dimension, unnest(range({len(NUMBERS)})) AS position
), categories AS (
  {" UNION ALL ".join(f"SELECT {i} AS source, '{name}' AS name, coalesce({name}, '__MISSING__') AS value, count(*) AS n FROM txn GROUP BY 3" for i, name in enumerate(CATEGORIES))}
), dimensions AS (
  SELECT * FROM numbers UNION ALL SELECT concat(name, '_ohe_', value),
    {len(NUMBERS)} - 1 + row_number() OVER (ORDER BY source, n DESC, value) FROM categories
)"""


def _encoded(spark, sf_dir):
    """The fitted preprocessing pipeline over the whole modelling frame, and its dimension names."""
    frame = training_frame(spark, sf_dir)
    plan = fit_feature_plan(frame, profile_features(frame))
    prepared = prepare_features(frame, plan, fit_class_weights(frame))
    pipeline, inputs = build_pipeline(plan.numeric, plan.strings)
    vectors = pipeline.fit(prepared).transform(prepared)
    size = vectors.select("features").first()["features"].size
    return vectors, feature_names(vectors, size, inputs)


@query("encoded_vectors",
       f"{DIMENSIONS} SELECT transactionid, CAST(is_fraud AS DOUBLE) AS label, CAST((SELECT count(*) FROM dimensions) AS INT) AS n_dimensions, "
       f"{len(CATEGORIES)}::DOUBLE AS n_categories FROM txn")
def encoded_vectors(spark, sf_dir):
    """Vector size, and how many categories each row carries: one per text column."""
    vectors, names = _encoded(spark, sf_dir)
    values = vector_to_array("features")
    carried = F.aggregate(
        F.slice(values, len(NUMBERS) + 1, len(names) - len(NUMBERS)), F.lit(0.0), lambda total, v: total + v
    )
    return vectors.select(
        "transactionid", "label", F.size(values).alias("n_dimensions"), carried.alias("n_categories")
    )


@query("encoded_dimensions", f"{DIMENSIONS} SELECT CAST(position AS INT) AS position, dimension FROM dimensions")
def encoded_dimensions(spark, sf_dir):
    """Names and order of the encoded dimensions, constant ones left out."""
    vectors, names = _encoded(spark, sf_dir)
    return names_table(vectors, names, "dimension")


def _held_out(truth):
    """The held-out vectors by the portable split, and that something holds for every one."""
    return (
        f"SELECT vec_id AS transactionid, CASE WHEN label < 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, true AS {truth} "
        f"FROM embeddings WHERE {md5_bucket("'split|' || CAST(vec_id AS VARCHAR)")} >= 0.7::DOUBLE * 4294967296.0"
    )


def _fitted(spark, sf_dir, name):
    """A model of the portable training part, and the part held out."""
    rows = training_vectors(spark, sf_dir)
    part = split_part("transactionid", portable=True)
    return m.build_estimator(name, FULL).fit(rows.where(part == 0)), rows.where(part == 1)


def _consistent(scored):
    probability = m.positive_probability(F.col("probability"))
    consistent = (F.col("prediction") == (probability > 0.5).cast("double")) | (probability == 0.5)
    return scored.select("transactionid", "label", consistent.alias("consistent"))


@query("scored_rows", _held_out("consistent"))
def scored_rows(spark, sf_dir):
    """A forest's answers for the held-out rows: probability and prediction must agree."""
    return _consistent(m.score(*_fitted(spark, sf_dir, "rf")))


@query("boosted_rows", _held_out("consistent"))
def boosted_rows(spark, sf_dir):
    """The same of all fifty boosting rounds."""
    return _consistent(m.score(*_fitted(spark, sf_dir, "gbt")))


@query("reloaded_model_rows", _held_out("same"))
def reloaded_model_rows(spark, sf_dir):
    """A stored and loaded forest answers as the fitted one did."""
    model, held = _fitted(spark, sf_dir, "rf")
    path = scratch_path(spark, "forest")
    m.save_model(model, path)
    again = m.score(m.LOADERS["rf"].load(path), held).select("transactionid", F.col("probability").alias("loaded"))
    both = m.score(model, held).join(again, "transactionid")
    return both.select("transactionid", "label", (F.col("probability") == F.col("loaded")).alias("same"))


def _compiled(spark, sf_dir, name):
    """Whether the expression of a fitted ensemble gives what its ``transform`` gives, row by row."""
    model, held = _fitted(spark, sf_dir, name)
    scored = m.score(model, held).select("transactionid", m.positive_probability(F.col("probability")).alias("p"), F.col("prediction").alias("q"))
    compiled = trees.score_columns(held.select("transactionid", "label", "features"), trees.ensemble_nodes(spark, model), vector_to_array("features"))
    same = (F.abs(F.col("probability") - F.col("p")) < 1e-12) & (F.col("prediction") == F.col("q"))
    return compiled.join(scored, "transactionid").select("transactionid", "label", same.alias("same"))


@query("compiled_forest_rows", _held_out("same"))
def compiled_forest_rows(spark, sf_dir):
    """A forest as an expression over feature values, against the fitted forest."""
    return _compiled(spark, sf_dir, "rf")


@query("compiled_boosted_rows", _held_out("same"))
def compiled_boosted_rows(spark, sf_dir):
    """The same of fifty boosting rounds."""
    return _compiled(spark, sf_dir, "gbt")


@query("importances")
def importances(spark, sf_dir):
    """Forest importances with the names of the encoded dimensions."""
    train, test = split(training_frame(spark, sf_dir), "transactionid")
    encoded = encode_split(train, test, FULL)
    model = m.build_estimator("rf", FULL).fit(encoded.train)
    encoded.train.unpersist(), encoded.test.unpersist(), encoded.profile.unpersist()
    return m.importance_rows(spark, encoded.names, model)


@query("cv_log")
def cv_log(spark, sf_dir):
    """Cross-validation of the whole forest grid with its per-fold log."""
    estimator = m.build_estimator("rf", FULL)
    vectors, grid = training_vectors(spark, sf_dir), m.param_grid("rf", estimator)
    return m.grid_search_cv("rf", estimator, grid, vectors, parallelism=FULL.parallelism).log_frame(spark)


@query("tuning_structure",
       """WITH grid AS (SELECT CAST(row_number() OVER (ORDER BY trees, depth) AS INT) AS combo_index,
         concat('{"maxDepth": ', depth, ', "numTrees": ', trees, '}') AS params_json
       FROM (VALUES (20), (40), (60)) a(trees), (VALUES (4), (6), (8)) b(depth))
       SELECT combo_index, params_json, CAST(3 AS BIGINT) AS n_folds, CAST(1 AS BIGINT) AS n_summaries, true AS mean_of_folds,
         CAST(1 AS BIGINT) AS n_best FROM grid""")
def tuning_structure(spark, sf_dir):
    """The forest log by combination: its folds, its mean, and one best combination in all."""
    log = cv_log(spark, sf_dir)
    summary = F.col("fold_index") == "summary"
    mean = F.max(F.when(summary, F.col("combo_mean_metric_pr")))
    best = best_logged(log).agg(F.count(F.lit(1))).scalar()
    return log.groupBy("combo_index", "params_json").agg(
        F.count_if(~summary).alias("n_folds"),
        F.count_if(summary).alias("n_summaries"),
        (F.abs(mean - F.avg("fold_metric_pr")) < 1e-12).alias("mean_of_folds"),
    ).select("*", best.alias("n_best"))


@query("training_metrics")
def training_metrics(spark, sf_dir):
    """The training flow over all rows with both models, each with the one combination of the smoke mode."""
    result = train_models(training_frame(spark, sf_dir), SMOKE)
    result.release()
    return result.metrics


@query("forest_training_metrics")
def forest_training_metrics(spark, sf_dir):
    """The training flow in full: balanced rows, the forest's whole grid."""
    result = train_models(training_frame(spark, sf_dir), replace(FULL, models=("rf",)))
    result.release()
    return result.metrics


@query("checked_predictions",
       f"SELECT count(*) AS n_rows, true AS as_expected, 3 AS refused FROM embeddings "
       f"WHERE {md5_bucket("'split|' || CAST(vec_id AS VARCHAR)")} >= 0.7::DOUBLE * 4294967296.0")
def checked_predictions(spark, sf_dir):
    """A forest's exported predictions pass the check; without a column, with one more or without rows they do not."""
    model, held = _fitted(spark, sf_dir, "rf")
    predictions = m.score(model, held).select("label", "prediction")
    check_predictions(predictions)
    refused = 0
    for wrong in (predictions.select("label"), predictions.withColumn("more", F.lit(1)), predictions.where("false")):
        try:
            check_predictions(wrong)
        except ValueError:
            refused += 1
    return predictions.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(True).alias("as_expected"), F.lit(refused).alias("refused"))


@query("metric_bounds", "SELECT 'rf' AS model_name, true AS areas_within, true AS as_predicted")
def metric_bounds(spark, sf_dir):
    """The metric row of the full forest flow: areas within 0 and 1, F1 and accuracy those of its stored predictions."""
    result = train_models(training_frame(spark, sf_dir), replace(FULL, models=("rf",)))
    again = f1_accuracy(result.predictions["rf"].select("label", "prediction")).first()
    within = [F.col(name).between(0.0, 1.0) for name in ("test_auc_pr", "test_auc_roc", "test_f1", "test_accuracy")]
    same = [F.abs(F.col(name) - F.lit(value)) < 1e-9 for name, value in (("test_f1", again["f1"]), ("test_accuracy", again["accuracy"]))]
    rows = result.metrics.select("model_name", functools.reduce(operator.and_, within).alias("areas_within"), (same[0] & same[1]).alias("as_predicted"))
    result.release()
    return rows


@query("importance_sum", f"{DIMENSIONS} SELECT count(*) AS n_dimensions, true AS sums_to_one, true AS none_negative FROM dimensions")
def importance_sum(spark, sf_dir):
    """Importances of a forest over the whole frame: one per encoded dimension, none negative, one in all."""
    vectors, names = _encoded(spark, sf_dir)
    model = m.build_estimator("rf", FULL).fit(vectors.select("transactionid", "label", "class_weight", "features"))
    value = F.col("importance")
    return m.importance_rows(spark, names, model).agg(
        F.count(F.lit(1)).alias("n_dimensions"), (F.abs(F.sum(value) - 1.0) < 1e-9).alias("sums_to_one"), F.bool_and(value >= 0).alias("none_negative")
    )


@query("hash_folds")
def hash_folds(spark, sf_dir):
    """Folds by Spark's own hash, as cross-validation uses them."""
    folds = with_folds(v.transactions(spark, sf_dir), "transactionid")
    return folds.groupBy("cv_fold").agg(F.count(F.lit(1)).alias("n_rows"))


@query("hash_fold_shares",
       "SELECT CAST(3 AS BIGINT) AS n_folds, count(*) AS n_rows, true AS near_thirds FROM events")
def hash_fold_shares(spark, sf_dir):
    """The folds add up to the table, and each is within five standard deviations of a third."""
    n, whole = F.col("n_rows"), F.sum("n_rows")
    spread = 5 * F.sqrt(whole * 2 / 9)
    return hash_folds(spark, sf_dir).agg(
        F.count(n).alias("n_folds"),
        whole.alias("n_rows"),
        ((F.max(n) - whole / 3 <= spread) & (whole / 3 - F.min(n) <= spread)).alias("near_thirds"),
    )
