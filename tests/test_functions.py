"""Column functions and the cyclic pipeline stage."""

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskloom import functions as f
from riskloom.operators.quality import is_json


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_time_parts_wrap_below_zero(spark):
    parts = f.time_parts(F.lit(-1).cast("bigint"))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    assert (row["day"], row["hour"], row["minute"], row["second"]) == (-1.0, 23.0, 59.0, 59.0)


def test_cyclic_encoder_is_a_savable_stage(spark, folder):
    df = spark.createDataFrame([(float(h),) for h in range(24)], "hour double")
    stage = f.CyclicTimeEncoder(inputCol="hour", period=24.0, sinCol="s", cosCol="c")
    model = Pipeline(stages=[stage]).fit(df)
    model.write().overwrite().save(f"{folder}/p")
    rows = PipelineModel.load(f"{folder}/p").transform(df).collect()
    for row in rows:
        assert math.isclose(row["s"], math.sin(2 * math.pi * row["hour"] / 24), abs_tol=1e-12)
        assert math.isclose(row["c"], math.cos(2 * math.pi * row["hour"] / 24), abs_tol=1e-12)


def test_flags(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, None), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(f.equal_flag(F.col("x"), F.col("y"))).collect()] == [1.0, 0.0, 0.0, 0.0]
    present = df.select(f.any_present([F.col("x"), F.col("y")])).collect()
    assert [r[0] for r in present] == [1.0, 1.0, 0.0, 1.0]
    assert one(spark, f.any_present([])) == 0.0


def test_category_names(spark):
    names = ["productcd_ohe_W", "a_ohe_b_ohe_c", "v258_imputed", "card1", "x_imputed_y"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(f.source_feature(F.col("n"))).collect()]
    assert got == ["productcd", "a", "v258", "card1", "x_imputed_y"]
    assert one(spark, f.strip_order_prefix(F.lit("02_100_249"))) == "100_249"


def test_cardinality_buckets(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 10, 11, 30, 31)], "n long")
    got = [r[0] for r in df.select(f.cardinality_bucket(F.col("n"))).collect()]
    assert got == ["constant", "constant", "low", "low", "medium", "medium", "high"]


def test_top_k_mapping(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    got = [r[0] for r in df.select(f.map_top_k(F.col("v"), ["a", "b"])).collect()]
    assert got == ["a", "__OTHER__", "__MISSING__"]


def test_display_text_and_params(spark):
    text = one(spark, f.best_model_text(F.lit("gbt"), F.lit(0.9315043931081807)))
    assert text == "Best model: gbt; test AUC-PR: 0.932"
    params = one(spark, f.params_json({"stepSize": F.lit(0.2), "maxDepth": F.lit(7)}))
    assert params == '{"maxDepth":7,"stepSize":0.2}'


def test_rates_for_display(spark):
    assert one(spark, f.rate_percent(F.lit(None).cast("double"))) == 0.0
    assert one(spark, f.rate_above(F.lit(0.05))) is False
    assert one(spark, f.rate_above(F.lit(0.0501))) is True


def test_whole_lines_of_json(spark):
    good = ['{"a": 1}', "[1, 2]", "1", '"x"', "null", "  {}  ", '{"a": "}"}']
    bad = ["", " ", "abc", '{"a": 1', '{"a": 1} x', "1,2", "1] x", "1}", '1,"b":2', "{'a': 1}", "NaN", "1],[2"]
    df = spark.createDataFrame([(v,) for v in good + bad + [None]], "v string")
    got = [r[0] for r in df.select(is_json(F.col("v"))).collect()]
    assert got == [True] * len(good) + [False] * (len(bad) + 1)
