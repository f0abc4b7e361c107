"""Imputing, indexing and assembling features: a Spark ML pipeline and its exact parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StringIndexer,
    VarianceThresholdSelector,
    VectorAssembler,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.operators.longform import POSITION, long_cells, named, names_table, quoted
from riskloom.operators.profile import value_counts
from riskloom.operators.ranges import exact_medians

IMPUTE_BATCH = 32


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """What the exact imputer and its model share."""

    def _pairs(self) -> list[tuple[str, str]]:
        names, outputs = self.getInputCols(), self.getOutputCols()
        if len(names) != len(outputs):
            raise ValueError("as many outputs as inputs are needed")
        return list(zip(names, outputs))


class ExactMedianImputer(Estimator, _Columns):
    """Pipeline stage that learns the exact median of every input column, all columns together.

    The medians are those of :func:`exact_medians`: a few counting passes for any
    number of columns, and the same for any layout of the rows. A column without
    values is an error that names it.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ExactMedianModel:
        names = [name for name, _ in self._pairs()]
        found = {row["feature_name"]: row["median"] for row in exact_medians(dataset, names).collect()}
        absent = [name for name in names if name not in found]
        if absent:
            raise ValueError(f"columns without values cannot be imputed: {absent}")
        model = ExactMedianModel(inputCols=names, outputCols=self.getOutputCols(), medians=[float(found[name]) for name in names])
        return model._resetUid(self.uid)


class ExactMedianModel(Model, _Columns):
    """The value of every input column as a double, or its stored median for NULL and NaN."""

    medians = Param(Params._dummy(), "medians", "median of each input column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, medians=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def getMedians(self) -> list[float]:
        return self.getOrDefault(self.medians)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        nothing = F.lit(None).cast("double")
        return dataset.withColumns(
            {
                output: F.coalesce(F.nanvl(F.col(quoted(name)).cast("double"), nothing), F.lit(median))
                for (name, output), median in zip(self._pairs(), self.getMedians())
            }
        )


def impute_exact(df: DataFrame, columns: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Add ``<name>_imputed``: the value, or the exact median for NULL and NaN.

    Brings one number per column to the driver.
    """
    medians = {row["feature_name"]: row["median"] for row in exact_medians(df, columns, buckets).collect()}
    absent = [name for name in columns if name not in medians]
    if absent:
        raise ValueError(f"columns without values cannot be imputed: {absent}")
    return df.withColumns(
        {
            f"{name}_imputed": F.coalesce(
                F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")), F.lit(medians[name])
            )
            for name in columns
        }
    )


def string_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature_name, value, n_rows, index: most frequent first, ties by value.

    For prepared columns, which hold a few dozen values each; the numbering
    window sees one row per value.
    """
    order = W.partitionBy("feature_name").orderBy(F.desc("n_rows"), F.asc("value"))
    return (
        value_counts(df, columns)
        .where(F.col("value").isNotNull())
        .withColumn("index", (F.row_number().over(order) - 1).cast("double"))
    )


def varying_dimensions(df: DataFrame, numeric: Sequence[str], strings: Sequence[str]) -> DataFrame:
    """dimension, kept for every encoded dimension of a prepared frame.

    A number varies if its smallest and largest values differ; a category's
    indicator varies unless all rows or none carry it. The index kept for
    unseen categories is empty on the rows it was learnt from, so it never stays.
    """
    parts = []
    if numeric:
        spans = (
            long_cells(df, [F.col(name).cast("double") for name in numeric])
            .groupBy(POSITION)
            .agg(F.coalesce(F.min("value") != F.max("value"), F.lit(False)).alias("kept"))
        )
        parts.append(named(spans, numeric, "dimension"))
    if strings:
        total = df.agg(F.count(F.lit(1))).scalar()
        counts = value_counts(df, strings).where(F.col("value").isNotNull())
        parts.append(
            counts.select(
                F.concat("feature_name", F.lit("_ohe_"), "value").alias("dimension"),
                (F.col("n_rows") < total).alias("kept"),
            )
        )
        unseen = names_table(df, [f"{name}_ohe___unknown" for name in strings], "dimension")
        parts.append(unseen.select("dimension", F.lit(False).alias("kept")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def build_pipeline(
    numeric: Sequence[str], strings: Sequence[str], strategy: str = "median", batch: int = IMPUTE_BATCH
) -> tuple[Pipeline, list[str]]:
    """Impute, index, one-hot, assemble, drop constant dimensions; also the assembler's inputs.

    Medians are exact and learnt for all columns together; imputers by the mean
    take ``batch`` columns each, which bounds the size of one fit. A numeric
    column without any value must be dropped before.
    """
    if strategy not in ("median", "mean"):
        raise ValueError(f"unsupported impute strategy: {strategy}")
    if batch <= 0:
        raise ValueError("the imputer batch must be positive")
    if not numeric and not strings:
        raise ValueError("no features left to encode")
    stages, inputs = [], []
    inputs += [f"{name}_imputed" for name in numeric]
    if numeric and strategy == "median":
        stages.append(ExactMedianImputer(inputCols=list(numeric), outputCols=list(inputs)))
    elif numeric:
        for start in range(0, len(numeric), batch):
            names, outputs = list(numeric[start : start + batch]), inputs[start : start + batch]
            stages.append(Imputer(strategy=strategy, inputCols=names, outputCols=outputs))
    if strings:
        indexed = [f"{name}_idx" for name in strings]
        encoded = [f"{name}_ohe" for name in strings]
        stages.append(
            StringIndexer(inputCols=list(strings), outputCols=indexed, handleInvalid="keep")
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=False))
        inputs += encoded
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features_raw", handleInvalid="keep"))
    stages.append(
        VarianceThresholdSelector(
            featuresCol="features_raw", outputCol="features", varianceThreshold=0.0
        )
    )
    return Pipeline(stages=stages), inputs


def vectorize(
    model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("transactionid", "label", "class_weight")
) -> DataFrame:
    return model.transform(df).select(*keep, "features")


def feature_names(
    vectors: DataFrame, size: int, fallback: Sequence[str] = (), column: str = "features"
) -> list[str]:
    """Dimension names from the vector's metadata, padded or cut to ``size``."""
    groups = vectors.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    attributes = [attribute for group in groups.values() for attribute in group]
    names = [a["name"] for a in sorted(attributes, key=lambda a: a["idx"])] or list(fallback)
    return [names[i] if i < len(names) else f"feature_{i}" for i in range(size)]
