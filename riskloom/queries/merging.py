"""Model metrics, run merging and report reshapes on frames derived from the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import views as v
from riskloom.functions.categories import params_json
from riskloom.operators import merge as g
from riskloom.operators import report as r
from riskloom.operators.models import prediction_export as export
from riskloom.operators.quality import expected_names
from riskloom.queries.registry import TXN, query
from riskloom.session import scratch_path
from riskloom.sources import keyed, versions

METRICS = f"""WITH {TXN}, metrics AS (
  SELECT productcd AS model_name, CAST(sum(is_fraud) AS DOUBLE) / count(*) AS test_auc_pr,
         CAST(count(transactionamt) AS DOUBLE) / count(*) AS test_auc_roc,
         CAST(sum(k) AS DOUBLE) / (100 * count(*)) AS test_f1,
         CAST(count(p_emaildomain) AS DOUBLE) / count(*) AS test_accuracy
  FROM txn GROUP BY productcd
)"""


def metrics(spark, sf_dir):
    """Four shares per category, standing in for the test metrics of models."""
    rows = F.count(F.lit(1))
    return (
        v.transactions(spark, sf_dir)
        .groupBy(F.col("productcd").alias("model_name"))
        .agg(
            (F.sum("is_fraud") / rows).alias("test_auc_pr"),
            (F.count("transactionamt") / rows).alias("test_auc_roc"),
            (F.sum("k") / (rows * 100)).alias("test_f1"),
            (F.count("p_emaildomain") / rows).alias("test_accuracy"),
        )
    )


@query("metrics_long",
       f"{METRICS} " + " UNION ALL ".join(
           f"SELECT model_name, '{name}' AS metric_name, {name} AS metric_value FROM metrics" for name in r.TEST_METRICS))
def metrics_long(spark, sf_dir):
    return r.metrics_long(metrics(spark, sf_dir))


@query("tile_model_metrics",
       f"{METRICS} " + " UNION ALL ".join(
           f"SELECT '{name}' AS metric_name, model_name, {name} AS avg_metric_value FROM metrics" for name in r.TEST_METRICS))
def tile_model_metrics(spark, sf_dir):
    return r.metric_tile(r.metrics_long(metrics(spark, sf_dir)))


@query("best_model",
       f"{METRICS} SELECT model_name, 'test_auc_pr' AS best_metric_name, test_auc_pr AS best_metric_value, "
       "printf('Best model: %s; test AUC-PR: %.3f', model_name, test_auc_pr) AS display_text "
       "FROM metrics ORDER BY test_auc_pr DESC, model_name LIMIT 1")
def best_model(spark, sf_dir):
    return r.best_model(metrics(spark, sf_dir))


@query("model_ranking",
       f"{METRICS} SELECT *, CAST(row_number() OVER (ORDER BY test_auc_pr DESC, model_name) AS INT) AS position FROM metrics")
def model_ranking(spark, sf_dir):
    return r.model_ranking(metrics(spark, sf_dir))


@query("model_comparison",
       f"{METRICS}, ranked AS (SELECT *, row_number() OVER (ORDER BY test_auc_pr DESC, model_name) AS r FROM metrics) "
       "SELECT (SELECT model_name FROM ranked WHERE r = 1) AS best, 'areaUnderPR' AS selection_metric, 20 AS seed, "
       "CAST(r - 1 AS INT) AS position, model_name, test_auc_pr, test_f1 FROM ranked")
def model_comparison(spark, sf_dir):
    """The comparison document, parsed again: constants, the best model, all models in order."""
    row = "struct<model_name: string, test_auc_pr: double, test_f1: double>"
    schema = f"best_model_by_test_auc_pr string, selection_metric string, seed int, models array<{row}>"
    document = r.model_comparison(metrics(spark, sf_dir)).select(F.from_json("comparison_json", schema).alias("d"))
    models = document.select(
        F.col("d.best_model_by_test_auc_pr").alias("best"),
        "d.selection_metric",
        "d.seed",
        F.posexplode("d.models").alias("position", "model"),
    )
    return models.select("best", "selection_metric", "seed", "position", "model.*")


@query("expected_models",
       f"{METRICS} SELECT name, problem FROM (SELECT model_name AS name, 'unexpected' AS problem FROM metrics "
       "WHERE model_name NOT IN ('click', 'view', 'refund') UNION ALL SELECT n, 'missing' FROM (VALUES ('click'), ('view'), ('refund')) t(n) "
       "WHERE n NOT IN (SELECT model_name FROM metrics))")
def expected_models(spark, sf_dir):
    return expected_names(metrics(spark, sf_dir), "model_name", ["click", "view", "refund"])


@query("params_json",
       f"WITH {TXN} SELECT productcd AS model_name, concat('{{\"maxDepth\":', max(k), ',\"minRows\":', count(*), '}}') AS params "
       "FROM txn GROUP BY productcd".replace("{{", "{").replace("}}", "}"))
def params_as_json(spark, sf_dir):
    """Parameters per category as JSON with sorted keys."""
    return (
        v.transactions(spark, sf_dir)
        .groupBy(F.col("productcd").alias("model_name"))
        .agg(F.max("k").alias("depth"), F.count(F.lit(1)).alias("rows"))
        .select("model_name", params_json({"minRows": F.col("rows"), "maxDepth": F.col("depth")}).alias("params"))
    )


UPSERT = f"""WITH {TXN}, old AS (SELECT p_emaildomain AS domain, count(*) AS n_rows, 'payer' AS side FROM txn GROUP BY 1),
new AS (SELECT r_emaildomain AS domain, count(*) AS n_rows, 'receiver' AS side FROM txn WHERE is_fraud = 1 AND k % 20 < 12 GROUP BY 1)"""


def _domain_counts(frame, column, side):
    return frame.groupBy(F.col(column).alias("domain")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(side).alias("side")
    )


@query("upsert_results",
       f"{UPSERT} SELECT * FROM new WHERE domain IS NOT NULL UNION ALL SELECT * FROM old "
       "WHERE domain IS NOT NULL AND domain NOT IN (SELECT domain FROM new WHERE domain IS NOT NULL)")
def upsert_results(spark, sf_dir):
    """Payer counts, replaced by the receiver counts of flagged low-k traffic where there are any."""
    txn = v.transactions(spark, sf_dir)
    flagged = txn.where((F.col("is_fraud") == 1) & (F.col("k") % 20 < 12))
    return g.upsert(
        _domain_counts(txn, "p_emaildomain", "payer"),
        _domain_counts(flagged, "r_emaildomain", "receiver"),
        "domain",
    )


@query("latest_event_per_user",
       "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def latest_event_per_user(spark, sf_dir):
    """Last writer wins when the later half of a long history, many rows per key, is merged into the earlier one."""
    events = v.table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    middle = events.agg(F.avg("event_id")).scalar()
    earlier, later = events.where(F.col("event_id") <= middle), events.where(F.col("event_id") > middle)
    return g.upsert(earlier, later, "user_id", "event_id")


@query("merged_touched_parts",
       "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def merged_touched_parts(spark, sf_dir):
    """The same upsert in a table of 16 parts; the last events of a few users rewrite only the parts of their keys."""
    events = v.table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    table = versions.VersionedTable(spark, scratch_path(spark, "latest_events"))
    few = F.col("user_id") % 50 == 0
    middle = events.agg(F.avg("event_id")).scalar()
    versions.upsert_parts(table, events.where(~few | (F.col("event_id") <= middle)), "user_id", 16, "event_id")
    versions.upsert_parts(table, events.where(few & (F.col("event_id") > middle)), "user_id", 16, "event_id")
    return table.read()


@query("pinned_version",
       "SELECT 1 AS version, n_nationkey, n_name FROM nation UNION ALL "
       "SELECT 3, n_nationkey, CASE WHEN n_regionkey = 2 THEN lower(n_name) ELSE n_name END FROM nation WHERE n_regionkey <> 1")
def pinned_version(spark, sf_dir):
    """A reader of the first version sees its rows after two more publications: one region changed, one emptied."""
    nations = v.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    table = versions.VersionedTable(spark, scratch_path(spark, "nations"))
    region = F.col("n_regionkey").cast("string").alias(versions.PART)
    parts = [str(row[0]) for row in nations.select("n_regionkey").distinct().collect()]
    first = table.publish(nations.select("*", region), parts)
    table.publish(nations.where("n_regionkey = 2").select("n_nationkey", F.lower("n_name").alias("n_name"), "n_regionkey", region), ["2"])
    latest = table.publish(nations.limit(0).select("*", region), ["1"])
    read = [table.read(number).select(F.lit(number).alias("version"), "n_nationkey", "n_name") for number in (first, latest)]
    return read[0].unionByName(read[1])


@query("prefer_new",
       "SELECT 'replaced' AS outcome, CAST(toxic AS VARCHAR) AS name, count(*) AS n_rows FROM labels GROUP BY toxic "
       "UNION ALL SELECT 'kept', lang, count(*) FROM documents GROUP BY lang")
def prefer_new(spark, sf_dir):
    """Once with new rows, once with an empty new result."""
    documents, labels = v.table(spark, sf_dir, "documents"), v.table(spark, sf_dir, "labels")
    rows = F.count(F.lit(1)).alias("n_rows")
    old = documents.groupBy(F.col("lang").alias("name")).agg(rows)
    new = labels.groupBy(F.col("toxic").cast("string").alias("name")).agg(rows)
    replaced = g.prefer_new(old, new).select(F.lit("replaced").alias("outcome"), "*")
    kept = g.prefer_new(old, new.where(F.col("n_rows") < 0)).select(F.lit("kept").alias("outcome"), "*")
    return replaced.unionByName(kept)


def two_models(spark, sf_dir):
    """Two scorers over all transactions: by amount (where there is one) and by k."""
    txn = v.transactions(spark, sf_dir)
    amount, k = F.col("transactionamt"), F.col("k")

    def scored(name, probability, prediction):
        return txn.select(
            F.lit(name).alias("model_name"),
            "transactionid",
            F.col("is_fraud").alias("label"),
            probability.alias("probability"),
            prediction.alias("prediction"),
        )

    by_amount = scored("amount", amount / 500, F.when(amount >= 25, 1.0).otherwise(0.0))
    by_k = scored("k", k / 100, F.when(k >= 50, 1.0).otherwise(0.0))
    return by_amount.where(F.col("probability").isNotNull()).unionByName(by_k)


ALIGNED = f"""WITH {TXN} SELECT transactionid, is_fraud AS actual_label, transactionamt / 500 AS amount_probability,
  CASE WHEN transactionamt >= 25 THEN 1 ELSE 0 END AS amount_prediction, CAST(k AS DOUBLE) / 100 AS k_probability,
  CASE WHEN k >= 50 THEN 1 ELSE 0 END AS k_prediction FROM txn WHERE transactionamt IS NOT NULL"""


@query("aligned_predictions", ALIGNED)
def aligned_predictions(spark, sf_dir):
    return g.aligned_predictions(two_models(spark, sf_dir), ["amount", "k"])


@query("prediction_sample", f"{ALIGNED} ORDER BY transactionid LIMIT 1")
def prediction_sample(spark, sf_dir):
    """The first transaction with every model's answer; its key is found before anything is aligned."""
    rows = two_models(spark, sf_dir)
    answered = rows.where(F.col("model_name") == "amount")  # the other model answers everywhere
    first = answered.agg(F.min("transactionid")).scalar()
    return g.aligned_predictions(rows.where(F.col("transactionid") == first), ["amount", "k"])


@query("prediction_export",
       f"WITH {TXN} SELECT CAST(is_fraud AS INT) AS label, CASE WHEN k >= 50 THEN 1 ELSE 0 END AS prediction FROM txn")
def prediction_export(spark, sf_dir):
    """Label and prediction of one scorer as whole numbers."""
    return export(two_models(spark, sf_dir).where(F.col("model_name") == "k"))


@query("batch_duplicates",
       "SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS n_new, count(*) FILTER (WHERE event_type <> 'click') AS n_stored FROM events "
       "GROUP BY 1 HAVING n_new > 1 OR (n_new > 0 AND n_stored > 0)")
def batch_duplicates(spark, sf_dir):
    """Clicks audited as a new batch against all other events, which are stored in a batch per type."""
    events = v.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    stored = keyed.KeyedBatches(spark, scratch_path(spark, "keyed_events"), {"user_id": "bigint"})
    for kind in sorted(row[0] for row in events.where("event_type <> 'click'").select("event_type").distinct().collect()):
        stored.add(events.where(F.col("event_type") == kind), kind)
    return stored.duplicates(events.where("event_type = 'click'"))


@query("batch_orphans", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def batch_orphans(spark, sf_dir):
    """Documents without a label, where the labels are stored in a batch per quality."""
    labels = v.table(spark, sf_dir, "labels")
    stored = keyed.KeyedBatches(spark, scratch_path(spark, "keyed_labels"), {"doc_id": "bigint"})
    grade = F.coalesce(F.col("quality").cast("string"), F.lit("none"))
    for value in sorted(row[0] for row in labels.select(grade).distinct().collect()):
        stored.add(labels.where(grade == value), value)
    return stored.orphans(v.table(spark, sf_dir, "documents").select("doc_id", "lang"))
