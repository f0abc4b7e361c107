"""CSV in, typed tables, audits, snapshots, partitioned tables, reports."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import merge as g
from riskloom.operators import quality as q
from riskloom.operators import report as r
from riskloom.operators.selection import decision_counts
from riskloom.plans.dashboard import SOURCE_TABLES, dashboard_tables, dashboard_tiles
from riskloom.plans.ingest import TableSpec, audit, publish_transactions, run_ingest
from riskloom.session import scratch_path
from riskloom.sources import reports, schema, sinks, tables


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)
    return path


# --- headers and CSV


@pytest.mark.parametrize("text", ["", "a,,b\n1,2,3\n", "a,b,a\n1,2,3\n", " ,b\n"])
def test_bad_headers(spark, folder, text):
    with pytest.raises(ValueError):
        tables.validate_header(spark, write(folder, "t.csv", text))


def test_header_with_a_byte_order_mark_and_quotes(spark, folder):
    path = write(folder, "t.csv", '﻿"a","b,c"\n1,2\n')
    assert tables.validate_header(spark, path) == ["a", "b,c"]


def test_empty_cells_are_null(spark, folder):
    path = write(folder, "t.csv", 'id,name,text\n1,,"say ""hi"", ok"\n2,x,\n')
    rows = tables.read_table_csv(spark, path).orderBy("id").collect()
    assert [tuple(row) for row in rows] == [("1", None, 'say "hi", ok'), ("2", "x", None)]


def test_identifiers():
    assert tables.check_identifier("_a1") == "_a1"
    for bad in ("1a", "a-b", "a b", "", "a;drop"):
        with pytest.raises(ValueError):
            tables.check_identifier(bad)


def test_required_tables():
    assert tables.missing_tables(["a", "b"], ["c", "a", "d"]) == ["c", "d"]
    with pytest.raises(ValueError):
        tables.require_tables(["a"], ["a", "b"])


# --- schemas


def test_inferred_types(spark):
    rows = [
        ("1", "1.5", " 7 ", "x", "", "9223372036854775808", "+3", "True", "1e3"),
        ("-2", "2", "", "1", None, "1", "4", "False", ".5"),
    ]
    names = ["whole", "decimal", "padded", "mixed", "empty", "big", "signed", "included", "exponent"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = schema.declared_types(schema.infer_schema(df, booleans=["included"]))
    assert got == {
        "whole": "BIGINT", "decimal": "NUMERIC", "padded": "BIGINT", "mixed": "TEXT", "empty": "TEXT",
        "big": "NUMERIC", "signed": "BIGINT", "included": "BOOLEAN", "exponent": "NUMERIC",
    }
    assert list(got) == names
    seen = {row["column_name"]: row["non_empty"] for row in schema.infer_schema(df).collect()}
    assert (seen["padded"], seen["empty"], seen["whole"]) == (1, 0, 2)
    assert schema.declared_types(schema.infer_schema(df, overrides={"whole": "SMALLINT"}))["whole"] == "SMALLINT"
    assert schema.declared_types(schema.infer_schema(df))["included"] == "TEXT"


def test_types_of_an_empty_table_are_text(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert schema.declared_types(schema.infer_schema(df)) == {"a": "TEXT", "b": "TEXT"}


def test_sampled_inference_sees_the_first_rows_only(spark):
    df = spark.createDataFrame([("1",)] * 50 + [("x",)], "a string").coalesce(1)
    assert schema.declared_types(schema.infer_schema(df, 50)) == {"a": "BIGINT"}
    assert schema.declared_types(schema.infer_schema(df, None)) == {"a": "TEXT"}


def test_normalised_names(spark):
    df = spark.createDataFrame([(1, 2)], "`id-12` int, DeviceType int")
    assert schema.normalize_columns(df).columns == ["id_12", "devicetype"]
    with pytest.raises(ValueError):
        schema.normalize_columns(spark.createDataFrame([(1, 2)], "`id-12` int, ID_12 int"))


def test_casts(spark):
    df = spark.createDataFrame([("1", "2.5", "x"), ("z", "", "y")], "a string, b string, c string")
    out = schema.cast_to_schema(df, {"a": "BIGINT", "b": "NUMERIC"})
    assert out.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string")]
    assert [tuple(row) for row in out.collect()] == [(1, 2.5, "x"), (None, None, "y")]
    with pytest.raises(ValueError):
        schema.cast_to_schema(df, {"nope": "TEXT"})
    assert schema.spark_type("whatever").simpleString() == "string"
    assert schema.struct_type({"a": "SMALLINT"}).simpleString() == "struct<a:int>"


# --- ingest


@pytest.fixture(scope="module")
def ingested(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("ingest"))
    rng = random.Random(1)
    lines = ["TransactionID,isFraud,TransactionDT,TransactionAmt,ProductCD"]
    lines += [f"{i},{int(i % 10 == 0)},{i * 60},{rng.uniform(1, 99):.2f},{rng.choice('WCH')}" for i in range(200)]
    lines += ["5,0,1,1.0,W"]
    identity = ["TransactionID,id-01,DeviceInfo"] + [f"{i},{-i},{'' if i % 2 else 'phone'}" for i in range(0, 220, 4)]
    specs = [
        TableSpec("train_transaction", write(folder, "t.csv", "\n".join(lines)), declared={"isFraud": "SMALLINT"}),
        TableSpec("train_identity", write(folder, "i.csv", "\n".join(identity)), parent="train_transaction"),
    ]
    return run_ingest(spark, specs, f"{folder}/warehouse"), specs


def test_ingest_types(ingested):
    (stored, _), _ = ingested
    assert dict(stored["train_transaction"].dtypes) == {
        "transactionid": "bigint", "isfraud": "int", "transactiondt": "bigint", "transactionamt": "double", "productcd": "string"
    }
    assert dict(stored["train_identity"].dtypes)["id_01"] == "bigint"


def test_ingest_audit(ingested):
    (_, problems), _ = ingested
    got = {(row["table_name"], row["problem"]): row["n_rows"] for row in problems.collect()}
    assert got == {
        ("train_transaction", "null key"): 0, ("train_transaction", "duplicate key"): 1,
        ("train_identity", "null key"): 0, ("train_identity", "duplicate key"): 0, ("train_identity", "no parent"): 5,
    }


def test_published_table(spark, ingested, folder):
    (stored, _), _ = ingested
    table = publish_transactions(stored["train_transaction"], "published_txn", path=f"{folder}/published")
    assert table.columns[-1] == "is_fraud" and table.count() == 201
    assert sorted(os.path.basename(p) for p in os.listdir(f"{folder}/published") if p.startswith("is_")) == ["is_fraud=0", "is_fraud=1"]
    spark.sql("DROP TABLE published_txn")


def test_broken_keys_are_found(spark):
    child = spark.createDataFrame([(1,), (1,), (None,), (9,)], "transactionid long")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "transactionid long")
    specs = [TableSpec("p", "", key="transactionid"), TableSpec("c", "", key="transactionid", parent="p")]
    got = {(row["table_name"], row["problem"]): row["n_rows"] for row in audit({"p": parent, "c": child}, specs).collect()}
    assert got["p", "duplicate key"] == 1 and got["p", "null key"] == 1
    assert got["c", "no parent"] == 1 and got["c", "null key"] == 1


# --- sinks


def test_buckets_let_a_join_go_without_a_shuffle(spark, folder):
    rows = spark.range(1000).select(F.col("id").alias("transactionid"), (F.col("id") % 2).alias("is_fraud"))
    sinks.write_partitioned_bucketed(rows, "left_b", "is_fraud", "transactionid", files_per_bucket=1, path=f"{folder}/l")
    sinks.write_partitioned_bucketed(rows, "right_b", "is_fraud", "transactionid", files_per_bucket=3, path=f"{folder}/r")
    files = [name for _, _, names in os.walk(f"{folder}/l") for name in names if name.endswith(".orc")]
    assert len(files) <= 8
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_b").join(spark.table("right_b"), "transactionid", "left")
        assert joined.count() == 1000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(transactionid" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("DROP TABLE left_b")
    spark.sql("DROP TABLE right_b")


def test_only_touched_partitions_are_replaced(spark, folder):
    rows = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "transactionid long, v string, is_fraud int")
    sinks.write_partitioned_bucketed(rows, "over_t", "is_fraud", "transactionid", path=f"{folder}/o")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    shuffled = spark.createDataFrame([(1, 9, "new")], "is_fraud int, transactionid long, v string")
    sinks.overwrite_partitions(spark, shuffled, "over_t")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    got = sorted(tuple(row) for row in spark.table("over_t").select("transactionid", "v", "is_fraud").collect())
    assert got == [(1, "a", 0), (9, "new", 1)]
    spark.sql("DROP TABLE over_t")


def test_exports_read_back(spark, folder):
    rows = [(1, 'say "hi", ok', 1.5), (2, None, None)]
    df = spark.createDataFrame(rows, "id int, t string, x double")
    sinks.export_jsonl(df, f"{folder}/j")
    assert sorted(map(tuple, spark.read.schema(df.schema).json(f"{folder}/j").collect()), key=str) == sorted(rows, key=str)
    sinks.export_csv(df, f"{folder}/c", single_file=True)
    assert len([n for n in os.listdir(f"{folder}/c") if n.endswith(".csv")]) == 1
    back = reports.read_report_csv(spark, f"{folder}/c").orderBy("id").collect()
    assert back[0]["t"] == 'say "hi", ok'


def test_scratch_paths_differ_and_follow_the_session(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert a != b and os.path.dirname(a) == os.path.dirname(b)
    assert shared is None or a.startswith(shared)


# --- reports

EVALUATION = '''best_params_json,cv_metric_pr,model_name,test_accuracy,test_auc_pr,test_auc_roc,test_f1
"{\\"maxDepth\\": 7, \\"stepSize\\": 0.2}",0.9256071576860977,gbt,0.8447697718164717,0.9315043931081807,0.9224285714897292,0.8446437217335041
"{\\"maxDepth\\": 8, \\"numTrees\\": 60}",0.8902578328653193,rf,0.7949619694119572,0.8859480472989085,0.8701940000447371,0.7946161970065181
'''


@pytest.fixture(scope="module")
def evaluation(spark, tmp_path_factory):
    path = write(str(tmp_path_factory.mktemp("eval")), "evaluation.csv", EVALUATION)
    return reports.read_report_csv(spark, path)


def test_published_evaluation_is_read_by_name(evaluation):
    row = evaluation.where("model_name = 'gbt'").first()
    assert json.loads(row["best_params_json"]) == {"maxDepth": 7, "stepSize": 0.2}
    assert q.expected_names(evaluation, "model_name", ["gbt", "rf"]).isEmpty()
    problems = {row["name"]: row["problem"] for row in q.expected_names(evaluation, "model_name", ["gbt", "svm"]).collect()}
    assert problems == {"rf": "unexpected", "svm": "missing"}


def test_published_dashboard_tables(evaluation):
    long = {(row["model_name"], row["metric_name"]): row["metric_value"] for row in r.metrics_long(evaluation).collect()}
    assert len(long) == 8 and long["rf", "test_f1"] == 0.7946161970065181
    best = r.best_model(evaluation).first()
    assert tuple(best) == ("gbt", "test_auc_pr", 0.9315043931081807, "Best model: gbt; test AUC-PR: 0.932")
    assert [row["model_name"] for row in r.model_ranking(evaluation).orderBy("position").collect()] == ["gbt", "rf"]


def test_model_comparison_document(evaluation):
    document = json.loads(r.model_comparison(reports.cast_report_columns(evaluation)).first()[0])
    assert document["best_model_by_test_auc_pr"] == "gbt" and document["selection_metric"] == "areaUnderPR"
    assert document["label_proxy"] == "isFraud" and document["execution_mode"] == "full" and document["seed"] == 20
    assert document["models"][1]["test_auc_roc"] == 0.8701940000447371


def test_equal_models_rank_by_name(spark):
    df = spark.createDataFrame([("rf", 0.5), ("gbt", 0.5)], "model_name string, test_auc_pr double")
    assert r.best_model(df).first()["model_name"] == "gbt"


def test_report_without_rows(spark, folder):
    with pytest.raises(ValueError):
        reports.read_report_csv(spark, write(folder, "e.csv", "a,b\n"))
    with pytest.raises(ValueError):
        reports.read_report_csv(spark, write(folder, "n.csv", ""))


def test_typed_report_columns(spark):
    df = spark.createDataFrame([("x", "0.5", "True", ""), ("", "", "False", "1")], "name string, Fraud_Rate string, included string, distinct_non_null string")
    out = reports.cast_report_columns(df)
    assert [t for _, t in out.dtypes] == ["string", "double", "int", "double"]
    assert [tuple(row) for row in out.collect()] == [("x", 0.5, 1, None), (None, None, 0, 1.0)]


def test_selected_columns(spark, folder):
    path = write(folder, "s.csv", "feature_name,importance,x\nv1,0.5,1\n,,2\nv2,,3\n")
    got = reports.read_selected(spark, path, ["feature_name", "importance", "new"]).collect()
    assert [tuple(row) for row in got] == [("v1", "0.5", None), ("v2", None, None)]
    missing = reports.read_selected(spark, f"{folder}/none.csv", ["a"])
    assert missing.columns == ["a"] and missing.isEmpty()


def test_dashboard(spark, evaluation):
    results = {name: spark.createDataFrame([("a", "0.5")], "feature_name string, importance string") for name in SOURCE_TABLES}
    results["model_evaluation"] = evaluation
    results["feature_profile"] = spark.createDataFrame(
        [("a", "True", "include_numeric"), ("b", "False", "drop_high_null"), ("c", "True", "include_numeric")],
        "feature_name string, included string, inclusion_decision string",
    )
    rates = "productcd string, amount_band string, card4 string, card6 string, email_domain string, transaction_day string, fraud_rate string, total_transactions string"
    for name in SOURCE_TABLES[:5]:
        results[name] = spark.createDataFrame([("W", "b", "visa", "debit", "x", "1", "0.25", "8")] * 2, rates)
    built = dashboard_tables(results)
    assert set(built) == {*SOURCE_TABLES, "model_metrics_long", "best_model_summary", "feature_profile_summary"}
    summary = [tuple(row) for row in built["feature_profile_summary"].collect()]
    assert summary == [("drop_high_null", 1), ("include_numeric", 2)]
    tiles = dashboard_tiles(built)
    assert tiles["rate_by_card"].first()["avg_fraud_rate"] == 0.25
    assert tiles["volume_by_day"].first()["sum_transactions"] == 16.0
    assert tiles["top_importances_gbt"].first()["importance"] == 0.5
    assert tiles["feature_decisions"].count() == 2
    del results["q1_product_risk"]
    with pytest.raises(ValueError):
        dashboard_tables(results)


def test_decisions_are_counted_in_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "inclusion_decision string")
    assert [tuple(row) for row in decision_counts(df).collect()] == [("a", 1), ("b", 2)]


# --- merging


def test_upsert(spark):
    old = spark.createDataFrame([("rf", 1), ("gbt", 2), (None, 3), ("", 4)], "model_name string, v int")
    new = spark.createDataFrame([("gbt", 9), ("svm", 5)], "model_name string, v int")
    once = g.upsert(old, new, "model_name")
    assert [tuple(row) for row in once.collect()] == [("gbt", 9), ("rf", 1), ("svm", 5)]
    assert [tuple(row) for row in g.upsert(once, new, "model_name").collect()] == [tuple(row) for row in once.collect()]


def test_upsert_takes_the_last_row_of_a_hot_key(spark):
    history = spark.range(5000).select(F.lit("hot").alias("k"), "id", (F.col("id") * 2).alias("v"))
    row = g.upsert(history.limit(0), history.repartition(6), "k", "id").first()
    assert (row["id"], row["v"]) == (4999, 9998)
    plan = g.upsert(history.limit(0), history, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_upsert_keeps_nulls_of_the_new_row(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", None)], "k string, v int")
    assert g.upsert(old, new, "k").first()["v"] is None


def test_prefer_new(spark):
    old = spark.createDataFrame([("a",), ("b",)], "v string")
    assert g.prefer_new(old, old.limit(0)).count() == 2
    assert [row[0] for row in g.prefer_new(old, spark.createDataFrame([("n",)], "v string")).collect()] == ["n"]


def test_aligned_predictions(spark):
    rows = [("gbt", 1, 0.0, 0.2, 0.0), ("rf", 1, 0.0, 0.6, 1.0), ("gbt", 2, 1.0, 0.9, 1.0), ("x", 1, 0.0, 0.1, 0.0)]
    df = spark.createDataFrame(rows, "model_name string, transactionid long, label double, probability double, prediction double")
    got = [tuple(row) for row in g.aligned_predictions(df, ["gbt", "rf"]).collect()]
    assert got == [(1, 0, 0.2, 0, 0.6, 1)]


def test_json_lines(spark):
    df = spark.createDataFrame([('{"a":1}',), ("oops",), ("",), ('{"b":2}',)], "value string")
    assert tuple(q.json_line_validity(df).first()) == (4, 2)
