"""The five rate reports, in the 0-1 style and in the percent style.

``df`` needs productcd, card4, card6, p_emaildomain, transactiondt,
transactionamt and is_fraud as far as the report uses them. ``scale`` sums
amounts exactly in 10**-scale units; None sums doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.amounts import (
    PERCENT_BAND_EDGES,
    PERCENT_BAND_LABELS,
    RATE_BAND_EDGES,
    RATE_BAND_LABELS,
    band,
)
from riskloom.functions.times import day_bucket
from riskloom.operators.rates import grouped_rate
from riskloom.sources.sinks import export_csv, materialize_result

MIN_DOMAIN_ROWS = 100
TOP_DOMAINS = 25


def _flag():
    return F.col("is_fraud")


def _amount():
    return F.col("transactionamt")


def _pair_present():
    return F.col("card4").isNotNull() & F.col("card6").isNotNull()


def rate_by_category(df: DataFrame, scale: int | None = None, partials: bool = False) -> DataFrame:
    return grouped_rate(
        df,
        ["productcd"],
        _flag(),
        _amount(),
        scale=scale,
        partials=partials,
        order=[F.desc("fraud_rate"), F.asc("productcd")],
    )


def rate_by_amount_band(
    df: DataFrame,
    scale: int | None = None,
    edges: Sequence[float] = RATE_BAND_EDGES,
    labels: Sequence[str] = RATE_BAND_LABELS,
) -> DataFrame:
    """A row without amount counts in the last band."""
    return grouped_rate(
        df,
        {"amount_band": band(_amount(), edges, labels)},
        _flag(),
        _amount(),
        scale=scale,
        order=[F.asc("amount_band")],
    )


def rate_by_card_pair(df: DataFrame, scale: int | None = None, partials: bool = False) -> DataFrame:
    return grouped_rate(
        df,
        ["card4", "card6"],
        _flag(),
        _amount(),
        scale=scale,
        partials=partials,
        where=_pair_present(),
        order=[F.desc("fraud_rate"), F.asc("card4"), F.asc("card6")],
    )


def top_domains_by_rate(
    df: DataFrame,
    scale: int | None = None,
    min_rows: int = MIN_DOMAIN_ROWS,
    limit: int = TOP_DOMAINS,
    partials: bool = False,
) -> DataFrame:
    return grouped_rate(
        df,
        {"email_domain": F.col("p_emaildomain")},
        _flag(),
        _amount(),
        scale=scale,
        partials=partials,
        where=F.col("p_emaildomain").isNotNull(),
        min_rows=min_rows,
        order=[F.desc("fraud_rate"), F.asc("email_domain")],
        limit=limit,
    )


def daily_rate(df: DataFrame, scale: int | None = None) -> DataFrame:
    return grouped_rate(
        df,
        {"transaction_day": day_bucket(F.col("transactiondt"))},
        _flag(),
        _amount(),
        scale=scale,
        average=False,
        total=True,
        order=[F.asc("transaction_day")],
    )


def percent_by_category(df: DataFrame, partials: bool = False) -> DataFrame:
    return grouped_rate(
        df,
        ["productcd"],
        _flag(),
        style="percent",
        partials=partials,
        average=False,
        order=[F.desc("fraud_rate_pct"), F.asc("productcd")],
    )


def percent_by_amount_band(
    df: DataFrame,
    scale: int | None = None,
    edges: Sequence[float] = PERCENT_BAND_EDGES,
    labels: Sequence[str] = PERCENT_BAND_LABELS,
) -> DataFrame:
    return grouped_rate(
        df,
        {"amount_band": band(_amount(), edges, labels)},
        _flag(),
        _amount(),
        style="percent",
        scale=scale,
        order=[F.asc("amount_band")],
    )


def percent_by_card_pair(df: DataFrame, partials: bool = False) -> DataFrame:
    return grouped_rate(
        df,
        ["card4", "card6"],
        _flag(),
        style="percent",
        partials=partials,
        average=False,
        where=_pair_present(),
        order=[F.desc("fraud_rate_pct"), F.asc("card4"), F.asc("card6")],
    )


def top_domains_by_volume(df: DataFrame, limit: int = TOP_DOMAINS, partials: bool = False) -> DataFrame:
    return grouped_rate(
        df,
        ["p_emaildomain"],
        _flag(),
        style="percent",
        partials=partials,
        average=False,
        where=F.col("p_emaildomain").isNotNull(),
        order=[F.desc("total_transactions"), F.asc("p_emaildomain")],
        limit=limit,
    )


def daily_percent(df: DataFrame, scale: int | None = None) -> DataFrame:
    return grouped_rate(
        df,
        {"day_offset": day_bucket(F.col("transactiondt"))},
        _flag(),
        _amount(),
        style="percent",
        scale=scale,
        order=[F.asc("day_offset")],
    )


# Result table -> (builder, order of its export). The names are those of the published results.
REPORTS = {
    "q1_results": (rate_by_category, ("-fraud_rate", "productcd")),
    "q2_results": (rate_by_amount_band, ("amount_band",)),
    "q3_results": (rate_by_card_pair, ("-fraud_rate", "card4", "card6")),
    "q4_results": (top_domains_by_rate, ("-fraud_rate", "email_domain")),
    "q5_results": (daily_rate, ("transaction_day",)),
}


def _order(columns: Sequence[str]):
    return [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in columns]


def run_exploration(df: DataFrame, directory: str, scale: int | None = None) -> dict[str, DataFrame]:
    """Write every report as an ORC table and as one CSV file; returns the tables.

    A table keeps no order, so the export sorts what it reads back from it.
    """
    root = directory.rstrip("/")
    tables = {}
    for name, (build, order) in REPORTS.items():
        tables[name] = materialize_result(build(df, scale), name, f"{root}/{name}")
        ordered = tables[name].coalesce(1).sortWithinPartitions(*_order(order))
        export_csv(ordered, f"{root}/{name}_csv", single_file=True)
    return tables
