"""Running totals and medians over an ordered value without sending all rows to one task.

Edges taken from a quantile sketch cut the distinct values into ranges of a
set size; totals per range give each range its starting point, and only inside
a range are values sorted. Edges decide how evenly the work spreads, never a
result, and they are fixed numbers by the time rows are assigned, so a
recomputed task puts its rows where they were.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.operators.longform import POSITION, long_cells, named, quoted
from riskloom.session import checkpointed

#: Distinct values that are sorted together, at any size of the table.
RANGE_VALUES = 250_000
#: Rows among which a median is looked up by sorting, and the marks of one narrowing step.
MEDIAN_ROWS = 100_000
MEDIAN_MARKS = 1024


def _number(value: Column) -> Column:
    """The value as a double, with one zero."""
    return value.cast("double") + F.lit(0.0)


def _array(numbers: Iterable[float]) -> Column:
    """Literal array, parsed in one go rather than built element by element."""
    cells = (f"{number!r}D" if math.isfinite(number) else f"double('{number!r}')" for number in numbers)
    return F.expr(f"array({', '.join(cells)})")


def range_edges(
    df: DataFrame, value: str, by: str | None = None, buckets: int | None = None
) -> Mapping[int | None, Sequence[float]]:
    """Edges per group that cut the rows of ``df`` into ``buckets`` ranges of about the same number of rows.

    Without ``buckets`` a range holds about ``RANGE_VALUES`` distinct values,
    however many there are. Runs one or two small aggregates and brings the edges to the
    driver: eight bytes for each quarter million values.
    """
    group = F.col(by) if by else F.lit(None).cast("int")
    groups = df.groupBy(group.alias("g"))
    if buckets is None:
        sizes = groups.agg(F.approx_count_distinct(value).alias("size"))
        buckets = (sizes.agg(F.max("size")).first()[0] or 0) // RANGE_VALUES + 1
    if buckets < 2:
        return {}
    marks = _array(i / buckets for i in range(1, buckets))
    sketch = F.percentile_approx(_number(F.col(value)), marks, F.lit(max(10_000, 20 * buckets)))
    return {
        row["g"]: sorted({mark for mark in row["marks"] or () if math.isfinite(mark)})
        for row in groups.agg(sketch.alias("marks")).collect()
    }


def _splits(edges: Sequence[float]) -> list[float]:
    """Edges as the bounds of a bucketizer, which needs at least two ranges."""
    return [float("-inf"), *(edges or [0.0]), float("inf")]


def value_histogram(df: DataFrame, value: str, sums: Sequence[str]) -> DataFrame:
    """Sums per distinct present value; a value shared by many rows combines before the shuffle."""
    present = df.where(F.col(value).isNotNull())
    return present.groupBy(value).agg(*[F.sum(name).alias(name) for name in sums])


def running_totals(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """One row per distinct value: its sums, and ``cum_<name>`` up to and including it.

    Rows without a value are left out. The histogram is stored once: the edges
    are marks of its distinct values, so a hot value weighs no more than any
    other, and the result reads it again without going back to ``df``. Runs
    the job that stores it and those of :func:`range_edges`.
    """
    hist = checkpointed(value_histogram(df, value, sums))
    edges = range_edges(hist, value, buckets=buckets).get(None, ())
    direction = F.desc if descending else F.asc
    placed = (
        Bucketizer(splits=_splits(edges), inputCol="number", outputCol="range", handleInvalid="keep")
        .transform(hist.withColumn("number", _number(F.col(value))))
        .select(value, *sums, F.coalesce(F.col("range").cast("int"), F.lit(0)).alias("bucket"))
    )
    before = W.orderBy(direction("bucket")).rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("bucket")
        .agg(*[F.sum(name).alias(f"total_{name}") for name in sums])
        .select(
            "bucket",
            *[
                F.coalesce(F.sum(f"total_{name}").over(before), F.lit(0)).alias(f"start_{name}")
                for name in sums
            ],
        )
    )
    inside = W.partitionBy("bucket").orderBy(direction(value)).rowsBetween(W.unboundedPreceding, 0)
    return placed.join(F.broadcast(starts), "bucket").select(
        value,
        *sums,
        *[(F.col(f"start_{name}") + F.sum(name).over(inside)).alias(f"cum_{name}") for name in sums],
    )


def grouped_running_totals(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    sums: Sequence[str],
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """:func:`running_totals` within every group of the columns ``by``, for any number of groups at the price of one.

    One stored histogram and one set of edges, from the distinct values of all
    groups together, serve all: a range holds the values of one group between two
    edges, so a group with a third of the rows is many ranges and a thousand small
    ones are a range or a few each. A NULL in ``by`` is a group of its own.
    """
    present = df.where(F.col(value).isNotNull())
    hist = checkpointed(present.groupBy(*by, value).agg(*[F.sum(name).alias(name) for name in sums]))
    edges = range_edges(hist, value, buckets=buckets).get(None, ())
    direction = F.desc if descending else F.asc
    placed = (
        Bucketizer(splits=_splits(edges), inputCol="number", outputCol="range", handleInvalid="keep")
        .transform(hist.withColumn("number", _number(F.col(value))))
        .select(*by, value, *sums, F.coalesce(F.col("range").cast("int"), F.lit(0)).alias("bucket"))
    )
    before = W.partitionBy(*by).orderBy(direction("bucket")).rowsBetween(W.unboundedPreceding, -1)
    totals = placed.groupBy(*by, "bucket").agg(*[F.sum(name).alias(f"total_{name}") for name in sums])
    starts = totals.select(
        *[F.col(name).alias(f"_{name}") for name in by],
        F.col("bucket").alias("_bucket"),
        *[F.coalesce(F.sum(f"total_{name}").over(before), F.lit(0)).alias(f"start_{name}") for name in sums],
    )
    inside = W.partitionBy(*by, "bucket").orderBy(direction(value)).rowsBetween(W.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(name).over(inside).alias(f"local_{name}") for name in sums])
    same = functools.reduce(operator.and_, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in (*by, "bucket")])
    return local.join(starts, same).select(
        *by, value, *sums, *[(F.col(f"start_{name}") + F.col(f"local_{name}")).alias(f"cum_{name}") for name in sums]
    )


def _median_bounds(
    numbers: DataFrame, columns: int, marks: int, rows: int
) -> dict[int, tuple[float, float, int, int]]:
    """Per column with values: bounds of its median, rows below them, and the median's rank.

    Each step counts, for all open columns in one aggregate, the rows below, at
    and between the bounds, and moves the bounds to the two marks of a sketch
    of the rows between that enclose the rank. Values at a bound are counted
    apart, so a hot value ends the search instead of staying inside. A step
    keeps about two of ``marks`` parts; it ends with ``rows`` rows or fewer.
    """
    bounds = {i: (float("-inf"), float("inf")) for i in range(columns)}
    found: dict[int, tuple[float, float, int, int]] = {}
    value = F.col("value")
    # with few rows the first step ends the search, and no mark is looked at
    few = numbers.limit(rows + 1).count() <= rows
    while bounds:
        spots = sorted(bounds)
        low, high = (F.get(_array(bounds[i][end] for i in spots), F.col(POSITION)) for end in (0, 1))
        between = (value > low) & (value < high)
        shares = _array(i / marks for i in range(1, marks))
        sketch = F.percentile_approx(F.when(between, value), shares, F.lit(max(10_000, 20 * marks)))
        cells = long_cells(numbers, [F.col(f"v{i}") for i in spots])
        counts = (
            cells.where(value.isNotNull() & ~F.isnan(value))
            .groupBy(POSITION)
            .agg(
                F.count(value).alias("total"),
                F.count_if(value < low).alias("below"),
                F.count_if(value == low).alias("at_low"),
                F.count_if(between).alias("between"),
                (F.lit(None) if few else sketch).alias("marks"),
            )
        )
        steps = {spots[row[POSITION]]: row for row in counts.collect()}
        for i in spots:
            step, (left, right) = steps.get(i), bounds.pop(i)
            if step is None:  # no values
                continue
            rank = (step["total"] + 1) // 2
            first = step["below"] + step["at_low"]
            if not step["below"] < rank:
                raise RuntimeError("the sketch missed its error bound")
            if rank <= first:
                found[i] = (left, left, step["below"], rank)
            elif rank > first + step["between"]:
                found[i] = (right, right, first + step["between"], rank)
            elif step["between"] <= rows:
                found[i] = (left, right, step["below"], rank)
            else:
                spot = (rank - first) / step["between"] * marks
                lower, upper = math.floor(spot - 0.5), math.ceil(spot + 0.5)
                bounds[i] = (
                    step["marks"][lower - 1] if lower >= 1 else left,
                    step["marks"][upper - 1] if upper < marks else right,
                )
    return found


def exact_medians(
    df: DataFrame, columns: Sequence[str], buckets: int | None = None, rows: int = MEDIAN_ROWS
) -> DataFrame:
    """feature_name, median: the smallest value with half of the present values at or below it.

    NULL and NaN do not count. A column without values has no row. Counting
    passes narrow the bounds of every column's median (``buckets`` marks a
    step, one step up to ``rows`` rows, two up to about fifty million) until
    few rows lie between them; only those are shuffled and sorted. Runs the
    counting passes.
    """
    numbers = df.select(*[_number(F.col(quoted(name))).alias(f"v{i}") for i, name in enumerate(columns)])
    found = _median_bounds(numbers, len(columns), max(4, buckets or MEDIAN_MARKS), rows)
    if not found:
        return df.sparkSession.createDataFrame([], "feature_name string, median double")
    spots, value = sorted(found), F.col("value")

    def known(part: int) -> Column:
        return F.get(_array(float(found[i][part]) for i in spots), F.col(POSITION))

    def whole(part: int) -> Column:
        return F.get(F.expr(f"array({', '.join(f'{found[i][part]}L' for i in spots)})"), F.col(POSITION))

    upto = W.partitionBy(POSITION).orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    upto_value = whole(2) + F.sum("n").over(upto)
    medians = (
        long_cells(numbers, [F.col(f"v{i}") for i in spots])
        .where((value >= known(0)) & (value <= known(1)))
        .groupBy(POSITION, "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(POSITION, "value", "n", upto_value.alias("upto"), whole(3).alias("rank"))
        .where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
    )
    return named(medians.select(POSITION, value.alias("median")), [columns[i] for i in spots])
