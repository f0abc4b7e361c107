"""Encoding, cross-validation, model storage and the whole training flow."""

import dataclasses
import json
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, StringIndexer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskloom.operators import cvlog as c
from riskloom.operators import encode as e
from riskloom.operators import metrics
from riskloom.operators import models as m
from riskloom.operators.quality import check_predictions, expected_names
from riskloom.operators.selection import source_importances
from riskloom.plans.modeling import modeling_frame
from riskloom.plans.training import balanced_split, encode_split, save_training, train_models

# Published log: combo, mean metric, elapsed seconds, seconds left.
GBT_SUMMARY = [
    (1, 0.8868280971102503, 88.94, 711.55), (2, 0.8977077498993048, 172.36, 603.26),
    (3, 0.9077512277834128, 252.17, 504.33), (4, 0.902640290523511, 372.75, 465.93),
    (5, 0.9138387854749919, 498.11, 398.49), (6, 0.9208096026755878, 623.86, 311.93),
    (7, 0.9103524900924257, 839.31, 239.8), (8, 0.9185529442163546, 1050.58, 131.32),
    (9, 0.9256071576860977, 1234.73, 0.0),
]
GBT_FOLDS = [
    (1, 1, 0.8904238120855892, 0.8904238120855892), (1, 2, 0.8871722755648145, 0.8887980438252019),
    (1, 3, 0.8828882036803473, 0.8868280971102503), (2, 1, 0.9011733510288416, 0.9011733510288416),
    (2, 2, 0.8979339216559775, 0.8995536363424095), (2, 3, 0.8940159770130953, 0.8977077498993048),
]


def test_running_means_of_the_published_folds(spark):
    folds = spark.createDataFrame(
        [("gbt", combo, fold, metric) for combo, fold, metric, _ in GBT_FOLDS],
        "model_name string, combo_index int, fold_index int, fold_metric_pr double",
    )
    got = {(r["combo_index"], r["fold_index"]): r["combo_mean_metric_pr"] for r in c.running_fold_means(folds).collect()}
    for combo, fold, _, mean in GBT_FOLDS:
        assert got[combo, fold] == pytest.approx(mean, abs=1e-15)
    means = {r["combo_index"]: r["metric_pr"] for r in c.combo_means(folds).collect()}
    assert means[2] == pytest.approx(0.8977077498993048, abs=1e-15)


def test_time_left_of_the_published_log(spark):
    seconds, previous = [], 0.0
    for combo, _, elapsed, _ in GBT_SUMMARY:
        seconds.append(("gbt", combo, 9, elapsed - previous))
        previous = elapsed
    combos = spark.createDataFrame(seconds, "model_name string, combo_index int, combo_total int, combo_seconds double")
    for row in c.time_left(combos).collect():
        _, _, elapsed, left = GBT_SUMMARY[row["combo_index"] - 1]
        assert row["elapsed_seconds"] == pytest.approx(elapsed)
        assert row["eta_seconds"] == pytest.approx(left, abs=0.1)


def test_best_combo_of_the_published_log_and_ties(spark):
    rows = [("gbt", n, metric, "summary", f"p{n}") for n, metric, _, _ in GBT_SUMMARY]
    rows += [("rf", 1, 0.5, "summary", "first"), ("rf", 2, 0.5, "summary", "second"), ("rf", 3, None, "summary", "x"), ("rf", 3, 0.9, "2", "fold")]
    log = spark.createDataFrame(rows, "model_name string, combo_index int, combo_mean_metric_pr double, fold_index string, params_json string")
    best = {r["model_name"]: r for r in c.best_logged(log).collect()}
    assert (best["gbt"]["combo_index"], best["gbt"]["combo_mean_metric_pr"]) == (9, 0.9256071576860977)
    assert best["rf"]["params_json"] == "first"


@pytest.fixture(scope="module")
def raw(spark):
    rng = random.Random(2)
    rows, identity = [], []
    for i in range(2400):
        fraud = int(rng.random() < 0.3)
        rows.append(
            (
                i, i * 977, None if i % 11 == 0 else round(rng.uniform(1, 300) + 150 * fraud, 2), fraud if i % 300 else None,
                rng.choice("WCHRS"), rng.choice(["gmail.com", "mail.com", None]), rng.choice(["gmail.com", None]),
                "web", rng.choice(["a", "b"]) if not fraud else "b", None, rng.gauss(fraud, 1.0),
            )
        )
        if i % 3 == 0:
            identity.append((i, None if i % 2 else float(i % 9), None if i % 2 else rng.choice(["mobile", "desktop"])))
    transactions = spark.createDataFrame(
        rows,
        "TransactionID long, TransactionDT long, TransactionAmt double, is_fraud int, ProductCD string, "
        "P_emaildomain string, R_emaildomain string, channel string, card6 string, empty double, V1 double",
    )
    return transactions, spark.createDataFrame(identity, "TransactionID long, `id-01` double, DeviceType string")


@pytest.fixture(scope="module")
def frame(raw):
    return modeling_frame(*raw).cache()


def test_modeling_frame(frame):
    assert frame.count() == 2400 - 8
    rows = {r["transactionid"]: r for r in frame.where("transactionid in (1, 3, 6)").collect()}
    assert rows[6]["identity_present"] == 1.0 and rows[6]["id_01"] == 6.0
    assert rows[3]["identity_present"] == 0.0  # matched, but without any value
    assert rows[1]["identity_present"] == 0.0
    assert "event_hour_sin" in frame.columns and "event_hour_part" not in frame.columns


def test_frame_without_identity_columns(raw):
    transactions, identity = raw
    built = modeling_frame(transactions, identity.select("TransactionID"))
    assert built.select("identity_present").distinct().collect()[0][0] == 0.0


def test_index_equals_string_indexer(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.choice("aabbcde"),) for _ in range(60)] + [("z",), ("y",)], "v string")
    labels = StringIndexer(inputCol="v", outputCol="i").fit(df).labels
    ours = [r["value"] for r in e.string_index(df, ["v"]).orderBy("index").collect()]
    assert ours == labels


def test_exact_imputation_equals_the_imputer_on_small_data(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,), (float("nan"),)], "v double")
    ours = [r["v_imputed"] for r in e.impute_exact(df, ["v"]).collect()]
    theirs = [r["v_imputed"] for r in Imputer(strategy="median", inputCols=["v"], outputCols=["v_imputed"]).fit(df).transform(df).collect()]
    assert ours == theirs == [1.0, 2.0, 3.0, 4.0, 2.0, 2.0]
    with pytest.raises(ValueError):
        e.impute_exact(df.withColumn("n", F.lit(None).cast("double")), ["v", "n"])


def test_kept_dimensions_equal_the_fitted_pipeline(spark):
    rows = [(1.0, 5.0, "a", "k"), (2.0, 5.0, "b", "k"), (3.0, 5.0, "a", "k"), (4.0, 5.0, "c", "k")]
    df = spark.createDataFrame(rows, "x double, flat double, s string, one string")
    pipeline, inputs = e.build_pipeline(["x", "flat"], ["s", "one"])
    out = pipeline.fit(df).transform(df)
    size = out.first()["features"].size
    fitted = e.feature_names(out, size, inputs)
    ours = {r["dimension"]: r["kept"] for r in e.varying_dimensions(df, ["x", "flat"], ["s", "one"]).collect()}
    assert ours == {
        "x": True, "flat": False, "s_ohe_a": True, "s_ohe_b": True, "s_ohe_c": True, "s_ohe___unknown": False,
        "one_ohe_k": False, "one_ohe___unknown": False,
    }
    assert size == sum(ours.values()) == len(fitted)


def test_unseen_category_is_an_empty_block(spark):
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, s string")
    pipeline, _ = e.build_pipeline(["x"], ["s"])
    model = pipeline.fit(train)
    out = model.transform(spark.createDataFrame([(1.0, "never")], "x double, s string")).first()["features"]
    assert out.toArray().tolist() == [1.0, 0.0, 0.0]


def test_names_are_padded_and_cut(spark):
    plain = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)], ["features"])
    assert e.feature_names(plain, 3, ["a"]) == ["a", "feature_1", "feature_2"]
    assert e.feature_names(plain, 1, ["a", "b"]) == ["a"]


def test_pipeline_settings_are_checked():
    for wrong in ({"strategy": "mode"}, {"batch": 0}):
        with pytest.raises(ValueError):
            e.build_pipeline(["x"], [], **wrong)
    with pytest.raises(ValueError):
        e.build_pipeline([], [])


@pytest.mark.parametrize(
    "wrong",
    [{"mode": "fast"}, {"strategy": "mode"}, {"models": ()}, {"models": ("svm",)}, {"null_ratio_drop": 1.1},
     {"string_coverage_min": -0.1}, {"imputer_batch": 0}, {"max_numeric": 0}, {"string_distinct_drop": 0}],
)
def test_settings_are_checked(wrong):
    with pytest.raises(ValueError):
        m.TrainingSettings(**wrong)


def test_grids():
    for name, first in (("gbt", {"maxDepth": 3, "stepSize": 0.05}), ("rf", {"maxDepth": 4, "numTrees": 20})):
        estimator = m.build_estimator(name)
        grid = m.param_grid(name, estimator)
        assert len(grid) == 9 and len(m.param_grid(name, estimator, True)) == 1
        assert json.loads(m.params_text(grid[0])) == first
    assert m.build_estimator("gbt").getMaxIter() == 50
    assert m.build_estimator("gbt", m.TrainingSettings(mode="smoke")).getMaxIter() == 10


def test_a_forest_keeps_the_nodes_of_its_rows(spark):
    """A level does not walk the trees from their roots; the trees are those of a forest that does."""
    r = random.Random(4)
    rows = [(float(r.random() < 0.4), float(k % 3 + 1), Vectors.dense([r.random(), r.randrange(5), r.random()])) for k in range(300)]
    frame = spark.createDataFrame(rows, ["label", "class_weight", "features"]).coalesce(1)
    estimator = m.build_estimator("rf")
    assert estimator.getCacheNodeIds()
    chosen = {estimator.numTrees: 5, estimator.maxDepth: 6}
    trees = [x.toDebugString.split("\n", 1)[1] for x in (estimator.fit(frame, chosen), estimator.fit(frame, {**chosen, estimator.cacheNodeIds: False}))]
    assert trees[0] == trees[1] and "Else" in trees[0]


def test_splits_are_reproducible(frame):
    settings = m.TrainingSettings(min_positive=10)
    first, again = balanced_split(frame, settings), balanced_split(frame.repartition(5), settings)
    for a, b in zip(first, again):
        assert {r[0] for r in a.select("transactionid").collect()} == {r[0] for r in b.select("transactionid").collect()}


@pytest.fixture(scope="module")
def result(frame):
    settings = m.TrainingSettings(mode="smoke", smoke_fraction=1.0, smoke_gbt_iterations=3)
    done = train_models(frame, settings)
    yield done
    done.release()


def test_training_flow(spark, result):
    rows = {r["model_name"]: r for r in result.metrics.collect()}
    assert set(rows) == {"gbt", "rf"}
    for row in rows.values():
        assert 0.5 < row["test_auc_pr"] <= 1.0 and 0.6 < row["test_auc_roc"] <= 1.0
    assert expected_names(result.metrics, "model_name", ["gbt", "rf"]).isEmpty()
    document = json.loads(result.comparison.first()[0])
    assert [item["model_name"] for item in document["models"]] == sorted(rows, key=lambda n: -rows[n]["test_auc_pr"])
    assert document["best_model_by_test_auc_pr"] == document["models"][0]["model_name"]
    assert "class_weight" not in {r["feature_name"] for r in result.encoded.profile.collect()}
    assert "empty" not in result.encoded.plan.numeric


def test_training_log(result):
    log = result.logs["rf"].collect()
    assert [r["fold_index"] for r in log] == ["1", "2", "3", "summary"]
    assert log[3]["combo_mean_metric_pr"] == pytest.approx(sum(r["fold_metric_pr"] for r in log[:3]) / 3)
    assert log[3]["eta_seconds"] == 0.0 and log[0]["eta_seconds"] is None
    best = c.best_logged(result.logs["rf"]).first()
    assert best["combo_mean_metric_pr"] == result.metrics.where("model_name = 'rf'").first()["cv_metric_pr"]


def test_importances_name_every_dimension(result):
    rows = result.importances["gbt"].collect()
    assert len(rows) == len(result.encoded.names) == result.encoded.train.first()["features"].size
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True)
    sources = {r["feature_name"] for r in source_importances(result.importances["rf"]).collect()}
    assert {"v1", "productcd"} <= sources


def test_prediction_sample_is_the_first_test_key(result):
    row = result.sample.first()
    assert row["transactionid"] == result.encoded.test.agg(F.min("transactionid")).first()[0]
    assert set(result.sample.columns) == {
        "transactionid", "actual_label", "gbt_probability", "gbt_prediction", "rf_probability", "rf_prediction"
    }


def test_saved_models_are_reused(spark, frame, result, folder):
    save_training(result, folder)
    log = spark.read.parquet(f"{folder}/logs/rf")
    stored = m.reuse_model("rf", f"{folder}/models/rf", log)
    assert m.reuse_model("gbt", f"{folder}/models/gbt", log) is None
    settings = m.TrainingSettings(mode="smoke", smoke_fraction=1.0, models=("rf",))
    again = train_models(frame, settings, stored={"rf": stored})
    before = result.metrics.where("model_name = 'rf'").first()
    after = again.metrics.first()
    assert after["cv_metric_pr"] == before["cv_metric_pr"] and after["best_params_json"] == before["best_params_json"]
    assert after["test_auc_pr"] == pytest.approx(before["test_auc_pr"])
    assert again.logs == {}
    again.release()
    predictions = spark.read.option("header", True).option("inferSchema", True).csv(f"{folder}/predictions/rf")
    check_predictions(predictions)
    assert predictions.count() == result.encoded.test.count()
    document = json.loads(spark.read.text(f"{folder}/model_comparison").first()[0])
    assert document["seed"] == 20


def test_a_later_run_keeps_earlier_models(result, folder):
    save_training(result, folder)
    one = dataclasses.replace(result, metrics=result.metrics.where("model_name = 'rf'").withColumn("test_f1", F.lit(0.5)))
    save_training(one, folder)
    spark = result.metrics.sparkSession
    rows = {row["model_name"]: row for row in spark.read.parquet(f"{folder}/metrics").collect()}
    assert set(rows) == {"gbt", "rf"} and rows["rf"]["test_f1"] == 0.5
    document = json.loads(spark.read.text(f"{folder}/model_comparison").first()[0])
    assert {item["model_name"] for item in document["models"]} == {"gbt", "rf"}


def test_metrics_equal_the_evaluators_without_bins(result):
    for predictions in result.predictions.values():
        got = m.evaluate(predictions)
        for metric, name in (("areaUnderROC", "test_auc_roc"), ("areaUnderPR", "test_auc_pr")):
            known = BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(predictions)
            assert got[name] == pytest.approx(known, abs=1e-9)
        for metric, name in (("f1", "test_f1"), ("accuracy", "test_accuracy")):
            assert got[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(predictions))


def test_tuning_goes_on_from_its_log(spark, result, folder):
    """Stored fits are taken, a missing one is fitted, those of other parameters are not taken."""
    train, estimator = result.encoded.train, m.build_estimator("rf")
    grid, path = m.param_grid("rf", estimator)[:2], f"{folder}/log"
    whole = m.grid_search_cv("rf", estimator, grid, train, log_path=path)
    stamps = {row["fold_index"]: row["timestamp_utc"] for row in whole.log.where("combo_index = 1").collect()}
    first = spark.read.parquet(f"{path}/fit_1_1").select("timestamp_utc").first()[0]
    spark.createDataFrame([(first, 1, 2, 3, 0.0, 0.0, "{}")], m.FIT_SCHEMA).write.mode("overwrite").parquet(f"{path}/fit_1_2")
    again = m.grid_search_cv("rf", estimator, grid, train, log_path=path)
    assert again.best_metric == whole.best_metric and again.best_params == whole.best_params
    later = {row["fold_index"]: row["timestamp_utc"] for row in again.log.where("combo_index = 1").collect()}
    assert later["1"] == first and later["3"] == spark.read.parquet(f"{path}/fit_1_3").first()["timestamp_utc"]
    assert later["2"] > stamps["2"]


def test_pruning_by_importance_narrows_the_plan(spark, frame):
    scores = spark.createDataFrame([("v1", 3.0), ("productcd", 2.0)], "feature_name string, score double")
    settings = m.TrainingSettings(prune_by_importance=True, max_numeric=1, max_string=1)
    encoded = encode_split(frame, frame.limit(0), settings, scores)
    assert (list(encoded.plan.numeric), list(encoded.plan.strings)) == (["v1"], ["productcd"])
    for part in (encoded.train, encoded.test, encoded.profile):
        part.unpersist()


def test_prediction_check(spark):
    good = spark.createDataFrame([(0, 1)], "label int, prediction int")
    check_predictions(good)
    for bad in (good.limit(0), good.select("prediction", "label"), good.withColumn("x", F.lit(1))):
        with pytest.raises(ValueError):
            check_predictions(bad)


def test_partitions_follow_the_rows():
    from riskloom.operators.sampling import training_partitions

    assert training_partitions(0) == 1
    assert training_partitions(28_000) == 7
    assert training_partitions(1_000_000) == 64
    assert training_partitions(10**9) == 4000


def test_training_does_not_depend_on_source_partitions(frame):
    settings = m.TrainingSettings(partitions=3)
    encoded = [encode_split(part, part.limit(0), settings) for part in (frame, frame.repartition(9))]
    models = [m.build_estimator("rf", m.TrainingSettings(mode="smoke")).fit(e.train) for e in encoded]
    importances = [model.featureImportances.toArray().tolist() for model in models]
    assert encoded[0].names == encoded[1].names and importances[0] == importances[1]
    for e_ in encoded:
        for part in (e_.train, e_.test, e_.profile):
            part.unpersist()


def test_exact_median_stage_is_saved_with_its_medians(spark, folder):
    rows = [(float(k % 17) if k % 5 else None, float("nan") if k % 3 else k / 7, k) for k in range(400)]
    df = spark.createDataFrame(rows, "x double, `y-z` double, n long")
    stage = e.ExactMedianImputer(inputCols=["x", "y-z", "n"], outputCols=["x_imputed", "y_imputed", "n_imputed"])
    model = Pipeline(stages=[stage]).fit(df.repartition(3))
    medians = {row["feature_name"]: row["median"] for row in e.exact_medians(df, ["x", "y-z", "n"]).collect()}
    assert model.stages[0].getMedians() == [medians[name] for name in ("x", "y-z", "n")]
    model.write().overwrite().save(f"{folder}/p")
    loaded = PipelineModel.load(f"{folder}/p")
    results = [fitted.transform(df).select("x_imputed", "y_imputed", "n_imputed").collect() for fitted in (loaded, model)]
    assert sorted(results[0]) == sorted(results[1])
    filled = loaded.transform(df).where("x is null").select("x_imputed").distinct().collect()
    assert [row[0] for row in filled] == [medians["x"]]
    with pytest.raises(ValueError, match="none"):
        e.ExactMedianImputer(inputCols=["none"], outputCols=["o"]).fit(df.withColumn("none", F.lit(None).cast("double")))


def test_training_pipeline_imputes_exactly(spark):
    df = spark.createDataFrame([(float(k), "a") for k in range(5000)] + [(None, "b")], "x double, s string")
    pipeline, _ = e.build_pipeline(["x"], ["s"])
    assert pipeline.fit(df).transform(df).where("x is null").first()["x_imputed"] == 2499.0


def test_grouped_areas_equal_those_of_each_group(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(3), None if rng.random() < 0.1 else rng.randrange(40) / 8, float(rng.random() < 0.3)) for _ in range(3000)]
    rows += [("lone", 0, 1.0, 1.0), ("lone", 0, 2.0, 1.0), ("empty", 0, None, 1.0)]
    df = spark.createDataFrame(rows, "model string, fold int, score double, label double")
    for buckets in (None, 7):
        found = {(r["model"], r["fold"]): tuple(r)[2:] for r in metrics.grouped_ranking_metrics(df, ["model", "fold"], buckets=buckets).collect()}
        assert len(found) == 10 and ("empty", 0) not in found
        for (model, fold), areas in found.items():
            one = df.where(F.col("model").eqNullSafe(F.lit(model)) & (F.col("fold") == fold))
            assert areas == pytest.approx(tuple(metrics.ranking_metrics(one).first()))
