"""Amount bands, exact money sums, rates and percentages."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edges (exclusive) and labels of the two published band ladders.
RATE_BAND_EDGES = (25, 100, 250, 500)
RATE_BAND_LABELS = ("00_under_25", "01_25_99", "02_100_249", "03_250_499", "04_500_plus")
PERCENT_BAND_EDGES = (10, 50, 100, 500, 1000)
PERCENT_BAND_LABELS = (
    "01_lt10",
    "02_10to50",
    "03_50to100",
    "04_100to500",
    "05_500to1000",
    "06_ge1000",
)


def band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first edge above ``value``; the last label takes the rest, NULL included."""
    if len(labels) != len(edges) + 1:
        raise ValueError("a ladder needs one label more than it has edges")
    ladder = F.when(value < F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:]):
        ladder = ladder.when(value < F.lit(edge), F.lit(label))
    return ladder.otherwise(F.lit(labels[-1]))


def minor_units(value: Column, scale: int) -> Column:
    """Amount as a whole number of its smallest unit (scale 2: cents).

    Sums of these are exact and do not depend on the order in which partitions
    arrive, and a long sum stays in generated code.
    """
    return F.round(value.cast("double") * F.lit(float(10**scale))).cast("bigint")


def exact_total(units: Column, scale: int) -> Column:
    return units.cast("double") / F.lit(float(10**scale))


def exact_average(units: Column, count: Column, scale: int) -> Column:
    """NULL where nothing was counted."""
    return F.when(count > 0, exact_total(units, scale) / count)


def percent_rounded(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, rounded half up to two places on decimals."""
    share = part.cast("decimal(20,0)") * F.lit(Decimal("100.0")) / whole.cast("decimal(20,0)")
    return F.round(share, 2).cast("double")


def rounded_average(units: Column, count: Column, scale: int) -> Column:
    """Average of ``units`` smallest units, rounded half up to two places on decimals."""
    total = units.cast("decimal(20,0)") / F.lit(Decimal(10**scale))
    return F.when(count > 0, F.round(total / count.cast("decimal(20,0)"), 2).cast("double"))


def log_amount(value: Column) -> Column:
    """``ln(1 + value)``; NULL stays NULL."""
    return F.log1p(value.cast("double"))


def rate_percent(rate: Column) -> Column:
    """A 0-1 rate in percent for display, a missing rate shown as zero."""
    return F.coalesce(rate.cast("double"), F.lit(0.0)) * F.lit(100.0)


def rate_above(rate: Column, percent: float = 5.0) -> Column:
    """Whether a rate is worth an accent on a chart."""
    return rate_percent(rate) > F.lit(percent)
