"""The training flow: balance, split, profile, prepare, encode, tune, evaluate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.encode import build_pipeline, feature_names, vectorize
from riskloom.operators.merge import aligned_predictions, first_by_key, upsert
from riskloom.operators.models import (
    TrainingSettings,
    build_estimator,
    evaluate,
    grid_search_cv,
    importance_rows,
    param_grid,
    params_text,
    positive_probability,
    prediction_export,
    save_model,
    score,
)
from riskloom.operators.report import model_comparison
from riskloom.operators.sampling import (
    balance,
    class_counts,
    placed_by_key,
    smoke_sample,
    split,
    training_partitions,
    weights_of,
)
from riskloom.operators.selection import (
    FeaturePlan,
    Thresholds,
    fit_feature_plan,
    prepare_features,
    profile_features,
)
from riskloom.session import checkpointed
from riskloom.sources.sinks import export_csv, export_jsonl
from riskloom.sources.tables import read_if_present

KEY = "transactionid"
METRIC_SCHEMA = (
    "model_name string, cv_metric_pr double, test_auc_roc double, test_auc_pr double, "
    "test_f1 double, test_accuracy double, best_params_json string"
)


@dataclass
class EncodedSplit:
    """Vectors of both parts and what was learnt on the training part."""

    train: DataFrame
    test: DataFrame
    profile: DataFrame
    plan: FeaturePlan
    pipeline: PipelineModel
    names: list[str]


@dataclass
class TrainingResult:
    encoded: EncodedSplit
    metrics: DataFrame
    comparison: DataFrame
    sample: DataFrame
    models: dict = field(default_factory=dict)
    predictions: dict[str, DataFrame] = field(default_factory=dict)
    importances: dict[str, DataFrame] = field(default_factory=dict)
    logs: dict[str, DataFrame] = field(default_factory=dict)
    settings: TrainingSettings = field(default_factory=TrainingSettings)

    def release(self) -> None:
        """Give up the cached vectors and predictions."""
        for frame in (self.encoded.train, self.encoded.test, self.encoded.profile, *self.predictions.values()):
            frame.unpersist()


def thresholds(settings: TrainingSettings) -> Thresholds:
    return Thresholds(
        settings.null_ratio_drop,
        settings.dominant_ratio_drop,
        settings.string_distinct_drop,
        settings.string_coverage_min,
        settings.top_cardinality,
        settings.top_keep,
    )


def balanced_split(
    frame: DataFrame, settings: TrainingSettings, key: str = KEY
) -> tuple[DataFrame, DataFrame]:
    """Training and test part of the reduced frame; filters on the key's hash, nothing is stored."""
    salt = str(settings.seed)
    if settings.smoke:
        frame = smoke_sample(frame, key, settings.smoke_fraction, salt=f"smoke{salt}")
    reduced = balance(
        frame,
        key,
        ratio=settings.ratio,
        mode=settings.mode,
        balanced=settings.balanced,
        fraction=settings.tree_fraction,
        min_positive=settings.min_positive,
        salt=f"balance{salt}",
    )
    train, test = split(
        reduced, key, (settings.train_weight, 1 - settings.train_weight), f"split{salt}"
    )
    return train, test


def encode_split(
    train: DataFrame,
    test: DataFrame,
    settings: TrainingSettings = TrainingSettings(),
    scores: DataFrame | None = None,
) -> EncodedSplit:
    """Learn columns, categories, weights and encoders on ``train`` alone; apply them to both.

    Both parts are placed by their key, so a fit sees the same partitions
    whatever the source's, and checkpointed: fits read them many times, and a
    lost executor must not send them back to the sources. The vectors and the
    profile stay cached until released.
    """
    counts = class_counts(train)
    weights = weights_of(counts)
    partitions = settings.partitions or training_partitions(sum(counts.values()))
    train = checkpointed(placed_by_key(train, KEY, partitions))
    test = checkpointed(placed_by_key(test, KEY, partitions))
    profile = profile_features(train, limits=thresholds(settings)).persist()
    plan = fit_feature_plan(
        train,
        profile,
        thresholds(settings),
        scores if settings.prune_by_importance else None,
        settings.max_numeric,
        settings.max_string,
    )
    prepared = prepare_features(train, plan, weights)
    pipeline, inputs = build_pipeline(
        plan.numeric, plan.strings, settings.strategy, settings.imputer_batch
    )
    model = pipeline.fit(prepared)
    train_vectors = vectorize(model, prepared).persist(StorageLevel.MEMORY_AND_DISK)
    test_vectors = vectorize(model, prepare_features(test, plan, weights)).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    train_vectors.count()
    size = train_vectors.select("features").first()["features"].size
    names = feature_names(train_vectors, size, inputs)
    return EncodedSplit(train_vectors, test_vectors, profile, plan, model, names)


def prediction_rows(predictions: dict[str, DataFrame]) -> DataFrame:
    """Predictions of all models in one frame, as :func:`aligned_predictions` takes them."""
    frames = [
        frame.select(
            F.lit(name).alias("model_name"),
            "transactionid",
            "label",
            positive_probability(F.col("probability")).alias("probability"),
            "prediction",
        )
        for name, frame in sorted(predictions.items())
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def prediction_sample(test: DataFrame, predictions: dict[str, DataFrame]) -> DataFrame:
    """The smallest test key with every model's answer, one row.

    The key is looked up first and filters the predictions before they are aligned.
    """
    first = first_by_key(test.select("transactionid"), "transactionid").scalar()
    rows = prediction_rows(predictions).where(F.col("transactionid") == first)
    return aligned_predictions(rows, sorted(predictions))


def train_models(
    frame: DataFrame,
    settings: TrainingSettings = TrainingSettings(),
    scores: DataFrame | None = None,
    stored: dict[str, tuple] | None = None,
    log_directory: str | None = None,
) -> TrainingResult:
    """The whole flow over a modelling frame. Runs every fit; call ``release`` when done.

    ``stored`` gives models of an earlier run, as ``reuse_model`` returns them;
    they are evaluated without tuning again. Below ``log_directory`` every fit
    leaves its row as it ends; a run that was cut short goes on from there.
    """
    spark = frame.sparkSession
    train, test = balanced_split(frame, settings)
    encoded = encode_split(train, test, settings, scores)
    rows, models, predictions, importances, logs = [], {}, {}, {}, {}
    for name in settings.models:
        if stored and name in stored:
            models[name], cv_metric, chosen = stored[name]
        else:
            estimator = build_estimator(name, settings)
            tuned = grid_search_cv(
                name,
                estimator,
                param_grid(name, estimator, settings.smoke),
                encoded.train,
                folds=settings.folds,
                parallelism=settings.parallelism,
                log_path=f"{log_directory.rstrip('/')}/{name}" if log_directory else None,
            )
            models[name], cv_metric = tuned.best_model, tuned.best_metric
            chosen = params_text(tuned.best_params)
            logs[name] = tuned.log_frame(spark)
        predictions[name] = score(models[name], encoded.test).persist(StorageLevel.MEMORY_AND_DISK)
        importances[name] = importance_rows(spark, encoded.names, models[name])
        measured = evaluate(predictions[name])
        rows.append(
            (
                name,
                cv_metric,
                measured["test_auc_roc"],
                measured["test_auc_pr"],
                measured["test_f1"],
                measured["test_accuracy"],
                chosen,
            )
        )
    metrics = spark.createDataFrame(rows, METRIC_SCHEMA)
    return TrainingResult(
        encoded,
        metrics,
        model_comparison(metrics, settings.mode, settings.seed),
        prediction_sample(encoded.test, predictions),
        models,
        predictions,
        importances,
        logs,
        settings,
    )


def save_training(result: TrainingResult, directory: str) -> None:
    """Write models, predictions, importances, logs, profile and metrics below ``directory``.

    Models of earlier runs stay: their files lie beside, and their metrics are
    merged with the new ones before the comparison is made. The merged metrics,
    one row per model, pass through the driver, since they replace what they are made of.
    """
    root = directory.rstrip("/")
    spark = result.metrics.sparkSession
    metrics, earlier = result.metrics, read_if_present(spark, f"{root}/metrics", METRIC_SCHEMA)
    if earlier is not None:
        metrics = spark.createDataFrame(upsert(earlier, metrics, "model_name").collect(), METRIC_SCHEMA)
    result.encoded.pipeline.write().overwrite().save(f"{root}/preprocessing")
    for name, model in result.models.items():
        save_model(model, f"{root}/models/{name}")
        export_csv(prediction_export(result.predictions[name]), f"{root}/predictions/{name}")
        export_csv(result.importances[name], f"{root}/importances/{name}", single_file=True)
    for name, log in result.logs.items():
        log.write.mode("overwrite").parquet(f"{root}/logs/{name}")
    result.encoded.profile.write.mode("overwrite").parquet(f"{root}/feature_profile")
    metrics.write.mode("overwrite").parquet(f"{root}/metrics")
    export_csv(result.sample, f"{root}/prediction_sample", single_file=True)
    comparison = model_comparison(metrics, result.settings.mode, result.settings.seed)
    comparison.write.mode("overwrite").text(f"{root}/model_comparison")


def export_split(train: DataFrame, test: DataFrame, directory: str) -> None:
    """Both parts as JSON lines."""
    export_jsonl(train, f"{directory.rstrip('/')}/train")
    export_jsonl(test, f"{directory.rstrip('/')}/test")
