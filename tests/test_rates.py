"""Grouped rates, bands and merging of partial sums."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.functions.amounts import RATE_BAND_EDGES, RATE_BAND_LABELS, band, minor_units
from riskloom.operators import report as r
from riskloom.operators.rates import grouped_rate, merge_partials, rate_columns, rate_partials
from riskloom.plans import exploration as x

SCHEMA = "productcd string, p_emaildomain string, card4 string, card6 string, transactiondt long, transactionamt double, is_fraud int"

# Published results: category, transactions, flagged, rate.
CATEGORIES = [
    ("C", 68519, 8008, 0.11687269224594637),
    ("S", 11628, 686, 0.058995528035775714),
    ("H", 33024, 1574, 0.04766230620155039),
    ("R", 37699, 1426, 0.03782593702750736),
    ("W", 439670, 8969, 0.020399390451929858),
]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        hot = rng.random() < 0.4
        data.append(
            (
                "W" if hot else rng.choice("CHRS"),
                None if i % 9 == 0 else ("gmail.com" if hot else f"d{i % 30}"),
                rng.choice(["visa", "mastercard", None]),
                rng.choice(["credit", "debit", None]),
                rng.randrange(-90000, 900000),
                None if i % 17 == 0 else round(rng.uniform(0, 900), 2),
                int(rng.random() < 0.1),
            )
        )
    return data


@pytest.fixture(scope="module")
def txn(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_published_rates_come_out_of_their_counts(spark):
    partials = spark.createDataFrame(
        [(name, half, flags) for name, n, f, _ in CATEGORIES for half, flags in ((n // 2, f // 3), (n - n // 2, f - f // 3))],
        "productcd string, n_rows long, n_flagged long",
    )
    merged = merge_partials(partials, ["productcd"])
    got = {row["productcd"]: row for row in rate_columns(merged, ["productcd"], average=False).collect()}
    for name, n, flagged, rate in CATEGORIES:
        assert (got[name]["total_transactions"], got[name]["fraud_transactions"]) == (n, flagged)
        assert got[name]["fraud_rate"] == rate


def test_report_is_ordered_by_rate(spark):
    data = [(name, 1 if i < f // 100 else 0) for name, n, f, _ in CATEGORIES for i in range(n // 100)]
    df = spark.createDataFrame(data, "productcd string, is_fraud int").withColumn("transactionamt", F.lit(1.0))
    assert [row["productcd"] for row in x.rate_by_category(df).collect()] == ["C", "S", "H", "R", "W"]


def test_category_rates_equal_brute_force(txn, rows):
    got = {row["productcd"]: row for row in x.rate_by_category(txn, 2).collect()}
    for name in "CHRSW":
        mine = [row for row in rows if row[0] == name]
        cents = [round(row[5] * 100) for row in mine if row[5] is not None]
        assert got[name]["total_transactions"] == len(mine)
        assert got[name]["fraud_transactions"] == sum(row[6] for row in mine)
        assert got[name]["avg_amount"] == pytest.approx(sum(cents) / 100 / len(cents), rel=1e-15)


def test_exact_and_double_sums_agree(txn):
    exact = {row[0]: row["avg_amount"] for row in x.rate_by_category(txn, 2).collect()}
    double = {row[0]: row["avg_amount"] for row in x.rate_by_category(txn).collect()}
    assert double == pytest.approx(exact, rel=1e-12)


def test_partials_merge_to_the_direct_result(txn):
    direct = grouped_rate(txn, ["card4"], F.col("is_fraud"), F.col("transactionamt"), scale=2)
    parts = rate_partials(txn, ["card4", "productcd"], F.col("is_fraud"), F.col("transactionamt"), 2)
    merged = grouped_rate(parts, ["card4"], F.col("is_fraud"), scale=2, partials=True)
    assert sorted(map(str, direct.collect())) == sorted(map(str, merged.collect()))


def test_missing_amount_falls_into_the_last_band(spark):
    df = spark.createDataFrame([(24.99,), (25.0,), (99.99,), (249.0,), (499.9,), (500.0,), (None,)], "a double")
    labels = [row[0] for row in df.select(band(F.col("a"), RATE_BAND_EDGES, RATE_BAND_LABELS)).collect()]
    assert labels == ["00_under_25", "01_25_99", "01_25_99", "02_100_249", "03_250_499", "04_500_plus", "04_500_plus"]


def test_band_needs_one_more_label(spark):
    with pytest.raises(ValueError):
        band(F.lit(1), (1, 2), ("a", "b"))


def test_pairs_leave_out_missing_cards(txn, rows):
    total = sum(row["total_transactions"] for row in x.rate_by_card_pair(txn, 2).collect())
    assert total == sum(1 for row in rows if row[2] and row[3])


def test_top_domains_need_enough_rows_and_break_ties_by_name(spark):
    data = [("b", 1)] * 100 + [("a", 1)] * 100 + [("c", 1)] * 99 + [(None, 1)] * 500
    df = spark.createDataFrame(data, "p_emaildomain string, is_fraud int").withColumn("transactionamt", F.lit(2.0))
    assert [row["email_domain"] for row in x.top_domains_by_rate(df).collect()] == ["a", "b"]
    assert [row["email_domain"] for row in x.top_domains_by_rate(df, limit=1).collect()] == ["a"]
    assert [row[0] for row in x.top_domains_by_volume(df).collect()] == ["a", "b", "c"]


def test_days_before_zero(spark):
    df = spark.createDataFrame([(-1, 1.0, 0), (0, 2.0, 1), (86399, 3.0, 0), (86400, 4.0, 1)], "transactiondt long, transactionamt double, is_fraud int")
    got = [(row["transaction_day"], row["total_amount"]) for row in x.daily_rate(df, 2).collect()]
    assert got == [(-1, 1.0), (0, 5.0), (1, 4.0)]


def test_percent_rounds_half_up(spark):
    df = spark.createDataFrame([(1 if i < 1 else 0,) for i in range(800)], "is_fraud int").withColumn("productcd", F.lit("x"))
    assert x.percent_by_category(df).first()["fraud_rate_pct"] == 0.13


def test_a_limit_needs_an_order(txn):
    with pytest.raises(ValueError):
        grouped_rate(txn, ["productcd"], F.col("is_fraud"), limit=3)
    with pytest.raises(ValueError):
        grouped_rate(txn, ["productcd"], F.col("is_fraud"), style="permille")


def test_minor_units_survive_repartitioning(txn):
    def total(parts):
        return txn.repartition(parts).agg(F.sum(minor_units(F.col("transactionamt"), 2))).first()[0]

    assert len({total(1), total(3), total(8)}) == 1


def test_charts(spark):
    pairs = spark.createDataFrame(
        [("visa", "credit", 0.06812210385515693), ("visa", "debit", 0.025476458609475023), ("discover", "credit", 0.07931472081218274)],
        "card4 string, card6 string, fraud_rate double",
    )
    matrix = {row["card4"]: (row["credit"], row["debit"]) for row in r.pair_matrix(pairs, "card4", "card6", ["credit", "debit"]).collect()}
    assert matrix["discover"] == (0.07931472081218274 * 100, 0.0)
    assert matrix["visa"] == (0.06812210385515693 * 100, 0.025476458609475023 * 100)
    bars = r.bar_chart(pairs.withColumnRenamed("card4", "email_domain"), "email_domain").collect()
    assert [row["highlighted"] for row in bars] == [False, True, True]


def test_exploration_writes_every_report(spark, txn, folder):
    tables = x.run_exploration(txn, folder, 2)
    assert set(tables) == set(x.REPORTS)
    back = spark.read.option("header", True).csv(f"{folder}/q1_results_csv")
    assert back.count() == 5
    lines = [row["value"] for row in spark.read.text(f"{folder}/q5_results_csv").collect()]
    days = [int(line.split(",")[0]) for line in lines[1:]]
    assert days == sorted(days)
    for name in tables:
        spark.sql(f"DROP TABLE {name}")
