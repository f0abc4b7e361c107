"""Grouped flag rates.

A report is built from partial sums that merge: count, flagged, amounts present
and the amount sum. They merge at any level, so a rate by an attribute of a
dimension table first shrinks the fact table to one partial row per join key and
only then joins; a key that holds a third of the facts is one row by then.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.amounts import (
    exact_average,
    exact_total,
    minor_units,
    percent_rounded,
    rounded_average,
)

Keys = Mapping[str, Column] | Sequence[str]

_ROWS, _FLAGGED, _PRESENT, _AMOUNT = "n_rows", "n_flagged", "n_amounts", "amount_sum"


def _named(keys: Keys) -> list[Column]:
    if isinstance(keys, Mapping):
        return [column.alias(name) for name, column in keys.items()]
    return [F.col(name) for name in keys]


def rate_partials(
    df: DataFrame, keys: Keys, flag: Column, amount: Column | None = None, scale: int | None = None
) -> DataFrame:
    """One row of mergeable sums per key.

    With ``scale`` the amount is summed in whole smallest units, which is exact;
    without, as doubles.
    """
    measures = [
        F.count(F.lit(1)).alias(_ROWS),
        F.sum(flag.cast("bigint")).alias(_FLAGGED),
    ]
    if amount is not None:
        value = amount.cast("double") if scale is None else minor_units(amount, scale)
        measures += [F.count(value).alias(_PRESENT), F.sum(value).alias(_AMOUNT)]
    return df.groupBy(*_named(keys)).agg(*measures)


def merge_partials(partials: DataFrame, keys: Keys) -> DataFrame:
    """Sum partial rows up to coarser keys."""
    sums = [name for name in (_ROWS, _FLAGGED, _PRESENT, _AMOUNT) if name in partials.columns]
    return partials.groupBy(*_named(keys)).agg(*[F.sum(name).alias(name) for name in sums])


def rate_columns(
    partials: DataFrame, keys: Sequence[str], scale: int | None = None, average: bool = True, total: bool = False
) -> DataFrame:
    """total_transactions, fraud_transactions, fraud_rate (0-1) and the amount measures asked for."""
    columns = [
        *[F.col(name) for name in keys],
        F.col(_ROWS).alias("total_transactions"),
        F.col(_FLAGGED).alias("fraud_transactions"),
        (F.col(_FLAGGED) / F.col(_ROWS)).alias("fraud_rate"),
    ]
    if average:
        mean = (
            F.when(F.col(_PRESENT) > 0, F.col(_AMOUNT) / F.col(_PRESENT))
            if scale is None
            else exact_average(F.col(_AMOUNT), F.col(_PRESENT), scale)
        )
        columns.append(mean.alias("avg_amount"))
    if total:
        whole = F.col(_AMOUNT) if scale is None else exact_total(F.col(_AMOUNT), scale)
        columns.append(whole.alias("total_amount"))
    return partials.select(*columns)


def percent_columns(
    partials: DataFrame, keys: Sequence[str], scale: int | None = None, average: bool = False
) -> DataFrame:
    """total_transactions, fraud_count, fraud_rate_pct (two places) and, if asked for, avg_amount."""
    columns = [
        *[F.col(name) for name in keys],
        F.col(_ROWS).alias("total_transactions"),
        F.col(_FLAGGED).alias("fraud_count"),
        percent_rounded(F.col(_FLAGGED), F.col(_ROWS)).alias("fraud_rate_pct"),
    ]
    if average:
        mean = (
            F.round(F.col(_AMOUNT) / F.nullif(F.col(_PRESENT), F.lit(0)), 2)
            if scale is None
            else rounded_average(F.col(_AMOUNT), F.col(_PRESENT), scale)
        )
        columns.append(mean.alias("avg_amount"))
    return partials.select(*columns)


def grouped_rate(
    df: DataFrame,
    keys: Keys,
    flag: Column,
    amount: Column | None = None,
    *,
    style: str = "rate",
    scale: int | None = None,
    average: bool = True,
    total: bool = False,
    where: Column | None = None,
    min_rows: int | None = None,
    order: Sequence[Column] = (),
    limit: int | None = None,
    partials: bool = False,
) -> DataFrame:
    """Flag rate per key: filter, group, keep big enough groups, order, top N.

    ``partials=True`` says that ``df`` already holds rows of
    :func:`rate_partials`, possibly joined to what the keys need. ``limit`` is a
    top-N report and needs an order that ends in the keys, or ties are arbitrary.
    """
    if style not in ("rate", "percent"):
        raise ValueError(f"unknown style: {style}")
    if limit is not None and not order:
        raise ValueError("a top-N report needs an order")
    names = list(keys)
    source = df if where is None else df.where(where)
    sums = merge_partials(source, keys) if partials else rate_partials(source, keys, flag, amount, scale)
    if min_rows is not None:
        sums = sums.where(F.col(_ROWS) >= min_rows)
    has_amount = _AMOUNT in sums.columns
    if style == "rate":
        report = rate_columns(sums, names, scale, average and has_amount, total and has_amount)
    else:
        report = percent_columns(sums, names, scale, average and has_amount)
    if order:
        report = report.orderBy(*order)
    return report if limit is None else report.limit(limit)
