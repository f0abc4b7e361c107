"""Day buckets, clock parts and cyclic encodings of a seconds offset."""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_SECONDS = 86400
# Clock part -> units per turn.
CLOCK_PERIODS = {"hour": 24.0, "minute": 60.0, "second": 60.0}


def day_bucket(seconds: Column) -> Column:
    return F.floor(seconds / F.lit(DAY_SECONDS)).cast("bigint")


def time_parts(seconds: Column) -> dict[str, Column]:
    """Day number and clock parts as doubles; offsets before zero wrap correctly."""
    return {
        "day": day_bucket(seconds).cast("double"),
        "hour": F.floor(F.pmod(seconds, F.lit(DAY_SECONDS)) / 3600).cast("double"),
        "minute": F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("double"),
        "second": F.pmod(seconds, F.lit(60)).cast("double"),
    }


def cyclic_pair(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of one turn per ``period`` units."""
    angle = value.cast("double") * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


class CyclicTimeEncoder(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage around :func:`cyclic_pair`; its settings are saved with the pipeline."""

    period = Param(Params._dummy(), "period", "units per turn", TypeConverters.toFloat)
    sinCol = Param(Params._dummy(), "sinCol", "sine output", TypeConverters.toString)
    cosCol = Param(Params._dummy(), "cosCol", "cosine output", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, period=None, sinCol=None, cosCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = F.col(self.getInputCol())
        sine, cosine = cyclic_pair(value, self.getOrDefault(self.period))
        return dataset.withColumns(
            {self.getOrDefault(self.sinCol): sine, self.getOrDefault(self.cosCol): cosine}
        )
