"""Rate reports over events (txn) and over line items (sales)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom import views as v
from riskloom.functions.amounts import (
    PERCENT_BAND_EDGES,
    PERCENT_BAND_LABELS,
    RATE_BAND_EDGES,
    RATE_BAND_LABELS,
    band,
)
from riskloom.functions.categories import fill_missing_category
from riskloom.operators import report as r
from riskloom.operators.rates import grouped_rate
from riskloom.plans import exploration as x
from riskloom.queries.registry import SALES, TXN, band_sql, percent_sql, query, rate_sql
from riskloom.session import scratch_path
from riskloom.sources import versions

CENTS = v.MONEY_SCALE
DAY = "transactiondt // 86400"
PAIR = "card4 IS NOT NULL AND card6 IS NOT NULL"
DOMAIN = "p_emaildomain IS NOT NULL"

TXN_BAND = band_sql(RATE_BAND_EDGES, RATE_BAND_LABELS)
TXN_PCT_BAND = band_sql(PERCENT_BAND_EDGES, PERCENT_BAND_LABELS)
SALES_BAND = band_sql(v.SALES_BAND_EDGES, v.SALES_BAND_LABELS)

CATEGORY_SQL = rate_sql(TXN, "txn", "productcd", order="ORDER BY fraud_rate DESC, productcd")
BAND_SQL = rate_sql(TXN, "txn", f"{TXN_BAND} AS amount_band", names="1", order="ORDER BY amount_band")
PAIR_SQL = rate_sql(TXN, "txn", "card4, card6", where=PAIR)
DOMAIN_SQL = rate_sql(
    TXN, "txn", "p_emaildomain AS email_domain", names="p_emaildomain", where=DOMAIN,
    having="COUNT(*) >= 100", order="ORDER BY fraud_rate DESC, email_domain LIMIT 25",
)
DAILY_SQL = rate_sql(TXN, "txn", f"{DAY} AS transaction_day", names="1", average=False, total=True)


@query("rate_by_category", CATEGORY_SQL)
def rate_by_category(spark, sf_dir):
    return x.rate_by_category(v.transactions(spark, sf_dir), CENTS)


@query("incremental_rates", CATEGORY_SQL)
def incremental_rates(spark, sf_dir):
    """Three batches summed on their own as they come; the second first comes cut short, then whole again."""
    txn = v.transactions(spark, sf_dir)
    table = versions.VersionedTable(spark, scratch_path(spark, "rate_partials"))
    for batch, part in ((0, "true"), (1, "k < 50"), (2, "true"), (1, "true")):
        rows = txn.where(F.pmod("transactionid", F.lit(3)) == batch).where(part)
        versions.publish_partials(table, rows, f"b{batch}", ["productcd"], F.col("is_fraud"), F.col("transactionamt"), CENTS)
    return x.rate_by_category(versions.merged_partials(table, ["productcd"]), CENTS, partials=True)


@query("rate_by_amount_band", BAND_SQL)
def rate_by_amount_band(spark, sf_dir):
    return x.rate_by_amount_band(v.transactions(spark, sf_dir), CENTS)


@query("rate_by_card_pair", PAIR_SQL)
def rate_by_card_pair(spark, sf_dir):
    return x.rate_by_card_pair(v.card_partials(spark, sf_dir), CENTS, partials=True)


@query("top_domains_by_rate", DOMAIN_SQL)
def top_domains_by_rate(spark, sf_dir):
    return x.top_domains_by_rate(v.transactions(spark, sf_dir), CENTS)


@query("daily_rate", DAILY_SQL)
def daily_rate(spark, sf_dir):
    return x.daily_rate(v.transactions(spark, sf_dir), CENTS)


@query("percent_by_category", percent_sql(TXN, "txn", "productcd"))
def percent_by_category(spark, sf_dir):
    return x.percent_by_category(v.transactions(spark, sf_dir))


@query("percent_by_amount_band",
       percent_sql(TXN, "txn", f"{TXN_PCT_BAND} AS amount_band", names="1", average=True))
def percent_by_amount_band(spark, sf_dir):
    return x.percent_by_amount_band(v.transactions(spark, sf_dir), CENTS)


@query("percent_by_card_pair", percent_sql(TXN, "txn", "card4, card6", where=PAIR))
def percent_by_card_pair(spark, sf_dir):
    return x.percent_by_card_pair(v.card_partials(spark, sf_dir), partials=True)


@query("top_domains_by_volume",
       percent_sql(TXN, "txn", "p_emaildomain", where=DOMAIN,
                   order="ORDER BY total_transactions DESC, p_emaildomain LIMIT 25"))
def top_domains_by_volume(spark, sf_dir):
    return x.top_domains_by_volume(v.transactions(spark, sf_dir))


@query("daily_percent", percent_sql(TXN, "txn", f"{DAY} AS day_offset", names="1", average=True))
def daily_percent(spark, sf_dir):
    return x.daily_percent(v.transactions(spark, sf_dir), CENTS)


@query("sales_rate_by_category", rate_sql(SALES, "sales", "productcd"))
def sales_rate_by_category(spark, sf_dir):
    return x.rate_by_category(v.sales_by_part(spark, sf_dir), CENTS, partials=True)


@query("sales_rate_by_amount_band", rate_sql(SALES, "sales", f"{SALES_BAND} AS amount_band", names="1"))
def sales_rate_by_amount_band(spark, sf_dir):
    return x.rate_by_amount_band(
        v.sales(spark, sf_dir), CENTS, v.SALES_BAND_EDGES, v.SALES_BAND_LABELS
    )


@query("sales_rate_by_pair", rate_sql(SALES, "sales", "card4, card6", where=PAIR))
def sales_rate_by_pair(spark, sf_dir):
    return x.rate_by_card_pair(v.sales_by_order(spark, sf_dir, ["card4"]), CENTS, partials=True)


@query("sales_top_customers_by_rate",
       rate_sql(SALES, "sales", "p_emaildomain AS email_domain", names="p_emaildomain", where=DOMAIN,
                having=f"COUNT(*) >= {v.SALES_MIN_ROWS}", order="ORDER BY fraud_rate DESC, email_domain LIMIT 25"))
def sales_top_customers_by_rate(spark, sf_dir):
    return x.top_domains_by_rate(
        v.sales_by_order(spark, sf_dir, []), CENTS, v.SALES_MIN_ROWS, partials=True
    )


@query("sales_daily_rate",
       rate_sql(SALES, "sales", f"{DAY} AS transaction_day", names="1", average=False, total=True))
def sales_daily_rate(spark, sf_dir):
    return x.daily_rate(v.sales(spark, sf_dir), CENTS)


@query("sales_percent_by_category", percent_sql(SALES, "sales", "productcd"))
def sales_percent_by_category(spark, sf_dir):
    return x.percent_by_category(v.sales_by_part(spark, sf_dir), partials=True)


@query("sales_percent_by_amount_band",
       percent_sql(SALES, "sales", f"{SALES_BAND} AS amount_band", names="1", average=True))
def sales_percent_by_amount_band(spark, sf_dir):
    return x.percent_by_amount_band(
        v.sales(spark, sf_dir), CENTS, v.SALES_BAND_EDGES, v.SALES_BAND_LABELS
    )


@query("sales_percent_by_pair", percent_sql(SALES, "sales", "card4, card6", where=PAIR))
def sales_percent_by_pair(spark, sf_dir):
    return x.percent_by_card_pair(v.sales_by_order(spark, sf_dir, ["card4"]), partials=True)


@query("sales_top_customers_by_volume",
       percent_sql(SALES, "sales", "p_emaildomain", where=DOMAIN,
                   order="ORDER BY total_transactions DESC, p_emaildomain LIMIT 25"))
def sales_top_customers_by_volume(spark, sf_dir):
    return x.top_domains_by_volume(v.sales_by_order(spark, sf_dir, []), partials=True)


@query("sales_daily_percent",
       percent_sql(SALES, "sales", f"{DAY} AS day_offset", names="1", average=True))
def sales_daily_percent(spark, sf_dir):
    return x.daily_percent(v.sales(spark, sf_dir), CENTS)


@query("unknown_fill",
       rate_sql(TXN, "txn", "coalesce(p_emaildomain, 'unknown') AS email_domain", names="1"))
def unknown_fill(spark, sf_dir):
    """NULL domains as a group of their own instead of being left out."""
    return grouped_rate(
        v.transactions(spark, sf_dir),
        {"email_domain": fill_missing_category(F.col("p_emaildomain"))},
        F.col("is_fraud"),
        F.col("transactionamt"),
        scale=CENTS,
    )


@query("amount_bands", f"WITH {TXN} SELECT transactionid, {TXN_BAND} AS rate_band, {TXN_PCT_BAND} AS percent_band FROM txn")
def amount_bands(spark, sf_dir):
    amount = F.col("transactionamt")
    return v.transactions(spark, sf_dir).select(
        "transactionid",
        band(amount, RATE_BAND_EDGES, RATE_BAND_LABELS).alias("rate_band"),
        band(amount, PERCENT_BAND_EDGES, PERCENT_BAND_LABELS).alias("percent_band"),
    )


@query("ranked_rates",
       f"WITH rep AS ({CATEGORY_SQL}) SELECT productcd, fraud_rate, "
       "row_number() OVER (ORDER BY fraud_rate DESC, productcd) AS position FROM rep")
def ranked_rates(spark, sf_dir):
    """The report's order made visible: a position per row of the (one row per category) result."""
    report = x.rate_by_category(v.transactions(spark, sf_dir), CENTS)
    order = W.orderBy(F.desc("fraud_rate"), F.asc("productcd"))
    return report.select("productcd", "fraud_rate", F.row_number().over(order).cast("bigint").alias("position"))


@query("chart_categories",
       f"WITH rep AS ({CATEGORY_SQL}) SELECT productcd AS label, fraud_rate * 100 AS rate_pct, "
       "fraud_rate * 100 > 5 AS highlighted FROM rep")
def chart_categories(spark, sf_dir):
    return r.bar_chart(x.rate_by_category(v.transactions(spark, sf_dir), CENTS), "productcd")


@query("chart_domains",
       f"WITH rep AS ({DOMAIN_SQL}) SELECT email_domain AS label, fraud_rate * 100 AS rate_pct, "
       "fraud_rate * 100 > 5 AS highlighted FROM rep")
def chart_domains(spark, sf_dir):
    return r.bar_chart(x.top_domains_by_rate(v.transactions(spark, sf_dir), CENTS), "email_domain")


@query("chart_bands",
       f"WITH rep AS ({BAND_SQL}) SELECT regexp_replace(amount_band, '^[0-9]+_', '') AS label, "
       "CAST(total_transactions AS DOUBLE) AS total, fraud_rate * 100 AS rate_pct FROM rep")
def chart_bands(spark, sf_dir):
    return r.band_chart(x.rate_by_amount_band(v.transactions(spark, sf_dir), CENTS))


@query("chart_pair_matrix",
       f"WITH rep AS ({PAIR_SQL}) SELECT card4, "
       "coalesce(max(CASE WHEN card6 = 'credit' THEN fraud_rate * 100 END), 0.0) AS credit, "
       "coalesce(max(CASE WHEN card6 = 'overdrawn' THEN fraud_rate * 100 END), 0.0) AS overdrawn "
       "FROM rep GROUP BY card4")
def chart_pair_matrix(spark, sf_dir):
    report = x.rate_by_card_pair(v.card_partials(spark, sf_dir), CENTS, partials=True)
    return r.pair_matrix(report, "card4", "card6", ["credit", "overdrawn"])


@query("chart_axis", f"WITH {TXN} SELECT DISTINCT card4 FROM txn WHERE card4 IS NOT NULL")
def chart_axis(spark, sf_dir):
    report = x.rate_by_card_pair(v.card_partials(spark, sf_dir), CENTS, partials=True)
    return r.axis_values(report, "card4")


@query("chart_daily",
       f"WITH rep AS ({DAILY_SQL}) SELECT CAST(transaction_day AS DOUBLE) AS day, "
       "CAST(total_transactions AS DOUBLE) AS total, fraud_rate * 100 AS rate_pct FROM rep")
def chart_daily(spark, sf_dir):
    return r.daily_chart(x.daily_rate(v.transactions(spark, sf_dir), CENTS))


@query("tile_daily_volume",
       f"WITH rep AS ({DAILY_SQL}) SELECT transaction_day, CAST(sum(total_transactions) AS BIGINT) AS sum_transactions "
       "FROM rep GROUP BY transaction_day")
def tile_daily_volume(spark, sf_dir):
    return r.daily_volume_tile(x.daily_rate(v.transactions(spark, sf_dir), CENTS))


@query("tile_pair_rate",
       f"WITH rep AS ({PAIR_SQL}) SELECT card4, card6, avg(fraud_rate) AS avg_fraud_rate FROM rep GROUP BY card4, card6")
def tile_pair_rate(spark, sf_dir):
    report = x.rate_by_card_pair(v.card_partials(spark, sf_dir), CENTS, partials=True)
    return r.average_rate_tile(report, ["card4", "card6"])


def _average(sql: str, keys: str) -> str:
    return f"WITH rep AS ({sql}) SELECT {keys}, avg(fraud_rate) AS avg_fraud_rate FROM rep GROUP BY {keys}"


@query("tile_category_rate", _average(CATEGORY_SQL, "productcd"))
def tile_category_rate(spark, sf_dir):
    return r.average_rate_tile(x.rate_by_category(v.transactions(spark, sf_dir), CENTS), ["productcd"])


@query("tile_band_rate", _average(BAND_SQL, "amount_band"))
def tile_band_rate(spark, sf_dir):
    return r.average_rate_tile(x.rate_by_amount_band(v.transactions(spark, sf_dir), CENTS), ["amount_band"])


@query("tile_domain_rate", _average(DOMAIN_SQL, "email_domain"))
def tile_domain_rate(spark, sf_dir):
    return r.average_rate_tile(x.top_domains_by_rate(v.transactions(spark, sf_dir), CENTS), ["email_domain"])


@query("tile_daily_rate", _average(DAILY_SQL, "transaction_day"))
def tile_daily_rate(spark, sf_dir):
    return r.average_rate_tile(x.daily_rate(v.transactions(spark, sf_dir), CENTS), ["transaction_day"])
