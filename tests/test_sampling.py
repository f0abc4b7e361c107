"""Balance, samples, splits, folds: the same rows whatever the partitioning."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import sampling as s
from riskloom.operators.quality import classes_present


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(20000).select(
        F.col("id").alias("transactionid"), F.when(F.col("id") % 20 == 0, 1.0).otherwise(0.0).alias("label")
    )


def keys(df):
    return {row[0] for row in df.select("transactionid").collect()}


@pytest.mark.parametrize("portable", [False, True])
def test_balance_is_near_even_and_keeps_positives(frame, portable):
    sample = s.balanced_sample(frame, "transactionid", portable=portable)
    counts = s.class_counts(sample)
    assert counts[1] == 1000 and 850 < counts[0] < 1150
    again = s.balanced_sample(frame.repartition(13), "transactionid", portable=portable)
    assert keys(sample) == keys(again)


def test_ratio(frame):
    counts = s.class_counts(s.balanced_sample(frame, "transactionid", ratio=3.0))
    assert 2700 < counts[0] < 3300


def test_salts_choose_different_rows(frame):
    a, b = (keys(s.balanced_sample(frame, "transactionid", salt=x)) for x in ("a", "b"))
    assert a != b


def test_balance_fallbacks(frame):
    negatives = frame.where("label = 0")
    assert s.balance(frame, "transactionid", mode="smoke") is frame
    assert s.balance(frame, "transactionid", balanced=False, fraction=1.0) is frame
    assert s.class_counts(s.balance(frame, "transactionid", fraction=1.0))[0] < 1200
    assert s.balance(negatives, "transactionid") is negatives
    assert s.balance(frame, "transactionid", min_positive=1001) is frame
    done = s.balance(frame, "transactionid", min_positive=1000)
    assert done.select("class_weight").distinct().collect()[0][0] == 1.0
    assert s.class_counts(done)[1] == 1000


def test_unbalanced_mode_takes_a_share_of_both(frame):
    counts = s.class_counts(s.balance(frame, "transactionid", balanced=False, min_positive=1))
    assert 0.31 < counts[0] / 19000 < 0.39 and 0.27 < counts[1] / 1000 < 0.43
    assert s.balance(frame, "transactionid", balanced=False, min_positive=900) is frame
    with pytest.raises(ValueError):
        s.balance(frame.limit(0), "transactionid", balanced=False, min_positive=1)


def test_split_is_a_partition_of_the_rows(frame):
    train, test = s.split(frame, "transactionid")
    a, b = keys(train), keys(test.repartition(3))
    assert not a & b and len(a | b) == 20000 and 0.68 < len(a) / 20000 < 0.72
    parts = s.split(frame, "transactionid", (1, 1, 2))
    assert [round(p.count() / 20000, 1) for p in parts] == [0.2, 0.2, 0.5] or sum(p.count() for p in parts) == 20000


def test_folds_cover_all_rows(frame):
    folds = s.with_folds(frame, "transactionid", 3)
    counts = {r["cv_fold"]: r["count"] for r in folds.groupBy("cv_fold").count().collect()}
    assert set(counts) == {0, 1, 2} and sum(counts.values()) == 20000 and min(counts.values()) > 6300
    moved = s.with_folds(frame.repartition(7), "transactionid", 3)
    assert folds.exceptAll(moved).isEmpty()


def test_split_and_folds_are_independent(frame):
    train, _ = s.split(frame, "transactionid")
    counts = [r["count"] for r in s.with_folds(train, "transactionid").groupBy("cv_fold").count().collect()]
    assert len(counts) == 3 and max(counts) / min(counts) < 1.1


def test_several_keys_identify_a_row(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("hot"), F.col("id").alias("n"), F.lit(0).alias("label"))
    kept = s.stratified_sample(df, ["hot", "n"], {0: 0.5}).count()
    assert 1350 < kept < 1650


def test_weights(frame, spark):
    rows = {r["label"]: (r["n_rows"], r["class_weight"]) for r in s.class_weights(frame).collect()}
    assert rows == {0: (19000, 20000 / 38000), 1: (1000, 10.0)}
    assert s.fit_class_weights(frame) == {0: 20000 / 38000, 1: 10.0}
    with pytest.raises(ValueError):
        s.fit_class_weights(frame.where("label = 1"))


def test_fraction_without_a_class(frame):
    assert s.negative_fraction(frame.where("label = 0")).first()["fraction"] == 1.0
    assert s.negative_fraction(frame.where("label = 1")).first()["fraction"] == 1.0
    assert s.negative_fraction(frame).first()["fraction"] == 1000 / 19000


def test_smoke_sample(frame):
    sample = s.smoke_sample(frame, "transactionid", 0.1)
    assert 1700 < sample.count() < 2300
    with pytest.raises(ValueError):
        s.smoke_sample(frame.where("label = 0"), "transactionid", 0.1)
    with pytest.raises(ValueError):
        s.smoke_sample(frame.limit(0), "transactionid")


def test_extreme_keys_have_a_fold(spark):
    df = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,), (None,)], "transactionid long")
    assert {r["cv_fold"] for r in s.with_folds(df, "transactionid").collect()} <= {0, 1, 2}


def test_classes(frame):
    assert classes_present(frame).first()["both_present"] is True
    assert classes_present(frame.where("label = 1")).first()["both_present"] is False
