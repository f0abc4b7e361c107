"""Profiles, decisions and encoders."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskloom import views as v
from riskloom.operators import hitters as h
from riskloom.operators import profile as p
from riskloom.operators import selection as s
from riskloom.operators import summaries
from riskloom.operators.encode import ExactMedianImputer, impute_exact, string_index, varying_dimensions
from riskloom.operators.ranges import exact_medians
from riskloom.operators.report import decision_tile, rank_importances
from riskloom.queries.registry import IDENTITY, TXN, query
from riskloom.session import scratch_path

# Columns of the profiled frame: name -> (source type, Spark type).
WIDE_COLUMNS = {
    "transactiondt": ("numeric", "bigint"),
    "k": ("numeric", "int"),
    "transactionamt": ("numeric", "double"),
    "productcd": ("string", "string"),
    "p_emaildomain": ("string", "string"),
    "r_emaildomain": ("string", "string"),
    "device": ("string", "string"),
    "channel": ("string", "string"),
    "id_01": ("numeric", "int"),
    "id_02": ("numeric", "int"),
}
WIDE_SQL = f"""WITH {TXN}, {IDENTITY}, wide AS (
  SELECT transactionid, is_fraud, transactiondt, k, transactionamt, productcd, p_emaildomain, r_emaildomain,
         concat('k', CAST(k AS VARCHAR)) AS device, 'web' AS channel, id_01, id_02
  FROM txn LEFT JOIN ident USING (transactionid)
)"""
DOC_COLUMNS = {
    "lang": ("string", "string"),
    "source": ("string", "string"),
    "text": ("string", "string"),
    "n_chars": ("numeric", "bigint"),
}
LADDER = """CASE WHEN null_ratio > 0.95 THEN 'drop_high_null'
  WHEN distinct_non_null <= 1 THEN 'drop_constant_or_empty'
  WHEN source_type = 'numeric' THEN 'include_numeric'
  WHEN dominant_ratio > 0.995 THEN 'drop_dominant_value'
  WHEN distinct_non_null > 100 AND top_category_coverage < 0.80 THEN 'drop_high_cardinality_low_coverage'
  WHEN distinct_non_null > 30 THEN 'include_string_topk'
  ELSE 'include_string' END"""


def wide(spark, sf_dir):
    """Transactions with identity, a 100-valued text column and a constant one."""
    return (
        v.transactions(spark, sf_dir)
        .join(v.identity(spark, sf_dir), "transactionid", "left")
        .select(
            "transactionid",
            "is_fraud",
            "transactiondt",
            "k",
            "transactionamt",
            "productcd",
            "p_emaildomain",
            "r_emaildomain",
            F.concat(F.lit("k"), F.col("k").cast("string")).alias("device"),
            F.lit("web").alias("channel"),
            "id_01",
            "id_02",
        )
    )


def counts_sql(source: str, names) -> str:
    """feature_name, value, n_rows of the text columns."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature_name, {name} AS value, count(*) AS n_rows FROM {source} GROUP BY {name}"
        for name in names
    )


def profile_sql(with_clause: str, source: str, columns) -> str:
    parts = []
    for name, (kind, spark_type) in columns.items():
        stats = (
            f"SELECT '{name}' AS feature_name, '{kind}' AS source_type, '{spark_type}' AS spark_type, "
            f"CAST(count(*) - count({name}) AS DOUBLE) / count(*) AS null_ratio, "
            f"count(DISTINCT {name}) AS distinct_non_null, count({name}) AS present FROM {source}"
        )
        top = f"SELECT {name} AS value, count(*) AS c FROM {source} WHERE {name} IS NOT NULL GROUP BY 1"
        tops = (
            f"SELECT max(c) AS first_rows, sum(c) FILTER (r <= 10) AS top_rows FROM "
            f"(SELECT c, row_number() OVER (ORDER BY c DESC, value) AS r FROM ({top}))"
        )
        ratio = "CASE WHEN '{kind}' = 'string' AND null_ratio <= 0.95 AND distinct_non_null > 1 THEN CAST({rows} AS DOUBLE) / present END"
        parts.append(
            f"SELECT feature_name, source_type, spark_type, null_ratio, distinct_non_null, "
            f"{ratio.format(kind=kind, rows='first_rows')} AS dominant_ratio, "
            f"{ratio.format(kind=kind, rows='top_rows')} AS top_category_coverage FROM ({stats}), ({tops})"
        )
    lead = f"{with_clause}, stats AS" if with_clause else "WITH stats AS"
    return (
        f"{lead} ({' UNION ALL '.join(parts)}), decided AS (SELECT *, {LADDER} AS inclusion_decision, "
        "CASE WHEN distinct_non_null <= 1 THEN 'constant' WHEN distinct_non_null <= 10 THEN 'low' "
        "WHEN distinct_non_null <= 30 THEN 'medium' ELSE 'high' END AS cardinality_bucket FROM stats)"
    )


PROFILE_OUT = (
    "SELECT feature_name, source_type, spark_type, round(null_ratio, 6) AS null_ratio, distinct_non_null, "
    "round(dominant_ratio, 6) AS dominant_ratio, round(top_category_coverage, 6) AS top_category_coverage, "
    "cardinality_bucket, inclusion_decision LIKE 'include%' AS included, inclusion_decision FROM decided"
)
WIDE_PROFILE = profile_sql(WIDE_SQL, "wide", WIDE_COLUMNS)
STRINGS = [name for name, (kind, _) in WIDE_COLUMNS.items() if kind == "string"]


def _profile(spark, sf_dir):
    return s.profile_features(wide(spark, sf_dir), distinct="exact")


@query("null_profile",
       f"{WIDE_SQL} " + " UNION ALL ".join(
           f"SELECT '{name}' AS feature_name, count(*) AS n_rows, count(*) - count({name}) AS n_null, "
           f"CAST(count(*) - count({name}) AS DOUBLE) / count(*) AS null_ratio FROM wide" for name in WIDE_COLUMNS))
def null_profile(spark, sf_dir):
    return p.null_profile(wide(spark, sf_dir), list(WIDE_COLUMNS))


@query("distinct_profile",
       f"{WIDE_SQL} " + " UNION ALL ".join(
           f"SELECT '{name}' AS feature_name, count(DISTINCT {name}) AS distinct_non_null FROM wide"
           for name in WIDE_COLUMNS))
def distinct_profile(spark, sf_dir):
    return p.exact_distinct(wide(spark, sf_dir), list(WIDE_COLUMNS))


@query("approx_distinct")
def approx_distinct(spark, sf_dir):
    return p.approx_distinct(wide(spark, sf_dir), list(WIDE_COLUMNS))


@query("approx_distinct_bounds",
       f"{WIDE_SQL} " + " UNION ALL ".join(
           f"SELECT '{name}' AS feature_name, count(DISTINCT {name}) AS distinct_non_null, true AS within FROM wide"
           for name in WIDE_COLUMNS))
def approx_distinct_bounds(spark, sf_dir):
    """Sketched counts lie within five relative standard deviations of the exact ones."""
    frame = wide(spark, sf_dir)
    sketched = p.approx_distinct(frame, list(WIDE_COLUMNS)).withColumnRenamed("distinct_non_null", "sketched")
    exact = F.col("distinct_non_null")
    within = F.abs(F.col("sketched") - exact) <= 5 * 0.05 * exact
    return p.exact_distinct(frame, list(WIDE_COLUMNS)).join(sketched, "feature_name").select(
        "feature_name", "distinct_non_null", within.alias("within")
    )


@query("top_categories",
       f"{WIDE_SQL}, counts AS ({counts_sql('wide', STRINGS)}), ranked AS (SELECT *, row_number() OVER "
       "(PARTITION BY feature_name ORDER BY n_rows DESC, value) AS position FROM counts WHERE value IS NOT NULL) "
       "SELECT feature_name, value, n_rows, CAST(position AS INT) AS position FROM ranked WHERE position <= 10")
def top_categories(spark, sf_dir):
    return p.top_categories(wide(spark, sf_dir), STRINGS)


@query("heavy_categories",
       f"{WIDE_SQL}, counts AS ({counts_sql('wide', STRINGS)}), ranked AS (SELECT *, row_number() OVER "
       "(PARTITION BY feature_name ORDER BY n_rows DESC, value) AS position FROM counts WHERE value IS NOT NULL) "
       "SELECT feature_name, value, n_rows, CAST(position AS INT) AS position FROM ranked WHERE position <= 10")
def heavy_categories(spark, sf_dir):
    """The top categories by bounded summaries and an exact recount."""
    return h.heavy_categories(wide(spark, sf_dir), STRINGS)


@query("heavy_document_categories",
       f"WITH counts AS ({counts_sql('documents', ['lang', 'source', 'text'])}), ranked AS (SELECT *, row_number() OVER "
       "(PARTITION BY feature_name ORDER BY n_rows DESC, value) AS position FROM counts WHERE value IS NOT NULL) "
       "SELECT feature_name, value, n_rows, CAST(position AS INT) AS position FROM ranked WHERE position <= 10")
def heavy_document_categories(spark, sf_dir):
    """Few languages and sources, many texts: only the texts are counted whole."""
    return h.heavy_categories(v.table(spark, sf_dir, "documents"), ["lang", "source", "text"])


PROFILED = {"lang": "string", "source": "string", "text": "string", "n_chars": "bigint"}


@query("merged_profiles",
       " UNION ALL ".join(
           f"SELECT '{name}' AS feature_name, '{kind}' AS spark_type, count(*) AS n_rows, count(*) - count({name}) AS n_null, "
           f"CAST(count(*) - count({name}) AS DOUBLE) / count(*) AS null_ratio, true AS distinct_within, true AS dominant_within FROM documents"
           for name, kind in PROFILED.items()))
def merged_profiles(spark, sf_dir):
    """Two batches summarised on their own, one of them twice; counts are exact, estimates within their bounds of the exact profile."""
    documents = v.table(spark, sf_dir, "documents")
    path = scratch_path(spark, "summaries")
    for batch in (0, 1, 0):
        summaries.store_summary(documents.where(F.pmod("doc_id", F.lit(2)) == batch), list(PROFILED), path, f"part{batch}")
    exact = p.exact_column_stats(documents, list(PROFILED)).select(
        "feature_name", F.col("distinct_non_null").alias("distinct"), F.col("dominant_ratio").alias("dominant")
    )
    found = summaries.stored_profile(spark, path).join(exact, "feature_name")
    # four deviations of the sketch; the summary's error, and twice it where a value may not be among its own
    near = F.abs(F.col("distinct_non_null") - F.col("distinct")) <= F.greatest(F.lit(1.0), 0.04 * F.col("distinct"))
    bound = 2 * h.summary_error(h.TRACKED)
    within = (F.col("dominant_ratio") <= F.col("dominant") + bound) & (F.col("dominant_ratio") >= F.col("dominant") - bound)
    return found.select("feature_name", "spark_type", "n_rows", "n_null", "null_ratio", near.alias("distinct_within"), within.alias("dominant_within"))


@query("category_coverage",
       f"{WIDE_SQL}, counts AS ({counts_sql('wide', STRINGS)}), ranked AS (SELECT *, row_number() OVER "
       "(PARTITION BY feature_name ORDER BY n_rows DESC, value) AS position FROM counts WHERE value IS NOT NULL) "
       "SELECT feature_name, CAST(sum(n_rows) AS BIGINT) AS n_present, CAST(max(n_rows) AS DOUBLE) / sum(n_rows) AS dominant_ratio, "
       "CAST(sum(n_rows) FILTER (position <= 10) AS DOUBLE) / sum(n_rows) AS top_category_coverage "
       "FROM ranked GROUP BY feature_name")
def category_coverage(spark, sf_dir):
    coverage = p.category_coverage(p.value_counts(wide(spark, sf_dir), STRINGS))
    return coverage.select("feature_name", "n_present", "dominant_ratio", "top_category_coverage")


@query("feature_profile", f"{WIDE_PROFILE} {PROFILE_OUT}")
def feature_profile(spark, sf_dir):
    return _profile(spark, sf_dir)


@query("training_profile",
       f"{WIDE_PROFILE} SELECT feature_name, source_type, round(null_ratio, 6) AS null_ratio, "
       "CASE WHEN source_type = 'string' THEN distinct_non_null END AS n_values, "
       "round(top_category_coverage, 6) AS top_category_coverage, inclusion_decision FROM decided")
def training_profile(spark, sf_dir):
    """The profile as training takes it; counts of numeric columns are sketches and not shown."""
    return s.profile_features(wide(spark, sf_dir)).select(
        "feature_name",
        "source_type",
        "null_ratio",
        F.when(F.col("source_type") == "string", F.col("distinct_non_null")).alias("n_values"),
        "top_category_coverage",
        "inclusion_decision",
    )


@query("document_profile", f"{profile_sql('', 'documents', DOC_COLUMNS)} {PROFILE_OUT}")
def document_profile(spark, sf_dir):
    """Whole texts as a category: too many values, too little coverage."""
    documents = v.table(spark, sf_dir, "documents").select("doc_id", *DOC_COLUMNS)
    return s.profile_features(documents, exclude={"doc_id"}, distinct="exact")


@query("feature_decisions",
       f"{WIDE_PROFILE} SELECT inclusion_decision, count(*) AS feature_count FROM decided GROUP BY 1")
def feature_decisions(spark, sf_dir):
    return s.decision_counts(_profile(spark, sf_dir))


@query("tile_feature_decisions",
       f"{WIDE_PROFILE} SELECT inclusion_decision, count(*) AS sum_feature_count FROM decided GROUP BY 1")
def tile_feature_decisions(spark, sf_dir):
    return decision_tile(s.decision_counts(_profile(spark, sf_dir)))


@query("encoded_width",
       f"{WIDE_PROFILE} SELECT count(*) FILTER (inclusion_decision = 'include_numeric') AS numeric_features, "
       "count(*) FILTER (inclusion_decision LIKE 'include_string%') AS string_features, "
       "CAST(sum(CASE inclusion_decision WHEN 'include_numeric' THEN 1 WHEN 'include_string_topk' THEN 12 "
       "WHEN 'include_string' THEN distinct_non_null + 1 ELSE 0 END) AS BIGINT) AS estimated_width FROM decided")
def encoded_width(spark, sf_dir):
    return s.encoded_width(_profile(spark, sf_dir))


# Importances that come from the data: how many rows carry a category or a number.
IMPORTANCE_SQL = f"""{WIDE_PROFILE}, importances AS (
  SELECT concat('productcd_ohe_', productcd) AS feature_name, CAST(count(*) AS DOUBLE) AS importance FROM wide GROUP BY productcd
  UNION ALL SELECT concat('r_emaildomain_ohe_', r_emaildomain), CAST(count(*) AS DOUBLE) FROM wide WHERE r_emaildomain IS NOT NULL GROUP BY r_emaildomain
  UNION ALL SELECT 'transactionamt_imputed', CAST(count(transactionamt) AS DOUBLE) FROM wide
  UNION ALL SELECT 'k_imputed', CAST(sum(is_fraud) AS DOUBLE) FROM wide
)"""
ROLLUP_SQL = """rolled AS (SELECT CASE WHEN contains(feature_name, '_ohe_') THEN split_part(feature_name, '_ohe_', 1)
  ELSE regexp_replace(feature_name, '_imputed$', '') END AS feature_name, sum(importance) AS score FROM importances GROUP BY 1)"""


def importances(spark, sf_dir):
    data = wide(spark, sf_dir)
    rows = F.count(F.lit(1)).cast("double").alias("importance")

    def per_category(name):
        return (
            data.where(F.col(name).isNotNull())
            .groupBy(F.concat(F.lit(f"{name}_ohe_"), F.col(name)).alias("feature_name"))
            .agg(rows)
        )

    numbers = data.agg(
        F.count("transactionamt").cast("double").alias("transactionamt_imputed"),
        F.sum("is_fraud").cast("double").alias("k_imputed"),
    ).unpivot([], ["transactionamt_imputed", "k_imputed"], "feature_name", "importance")
    return per_category("productcd").unionByName(per_category("r_emaildomain")).unionByName(numbers)


@query("importance_rollup", f"{IMPORTANCE_SQL}, {ROLLUP_SQL} SELECT * FROM rolled")
def importance_rollup(spark, sf_dir):
    return s.source_importances(importances(spark, sf_dir))


@query("valid_importances",
       f"{IMPORTANCE_SQL} SELECT feature_name, importance FROM importances WHERE importance >= 100 AND feature_name NOT LIKE 'k%'")
def valid_importances(spark, sf_dir):
    """Importances as text, some blanked: rows without a name or a number go."""
    blanked = importances(spark, sf_dir).select(
        F.when(F.col("feature_name").startswith("k"), "").otherwise(F.col("feature_name")).alias("feature_name"),
        F.when(F.col("importance") < 100, "").otherwise(F.col("importance").cast("string")).alias("importance"),
    )
    return s.valid_importances(blanked)


@query("top_importances",
       f"{IMPORTANCE_SQL} SELECT * FROM importances ORDER BY importance DESC, feature_name LIMIT 20")
def top_importances(spark, sf_dir):
    return rank_importances(importances(spark, sf_dir), 20)


@query("profile_with_scores",
       f"{IMPORTANCE_SQL}, {ROLLUP_SQL} SELECT d.feature_name, inclusion_decision, coalesce(score, 0.0) AS score "
       "FROM decided d LEFT JOIN rolled r ON d.feature_name = r.feature_name")
def profile_with_scores(spark, sf_dir):
    scored = s.with_scores(_profile(spark, sf_dir), s.source_importances(importances(spark, sf_dir)))
    return scored.select("feature_name", "inclusion_decision", "score")


@query("pruned_features",
       f"{IMPORTANCE_SQL}, {ROLLUP_SQL}, ranked AS (SELECT d.feature_name, source_type, row_number() OVER "
       "(PARTITION BY source_type ORDER BY coalesce(score, 0.0) DESC, d.feature_name) AS position "
       "FROM decided d LEFT JOIN rolled r ON d.feature_name = r.feature_name WHERE inclusion_decision LIKE 'include%') "
       "SELECT feature_name, source_type, CAST(position AS INT) AS position FROM ranked "
       "WHERE position <= CASE source_type WHEN 'numeric' THEN 2 ELSE 3 END")
def pruned_features(spark, sf_dir):
    """The two best numbers and the three best categories."""
    scored = s.with_scores(_profile(spark, sf_dir), s.source_importances(importances(spark, sf_dir)))
    return s.keep_top_features(scored, 2, 3).select("feature_name", "source_type", "position")


MEDIAN_COLUMNS = ["transactionamt", "transactiondt", "k"]
MEDIAN_SQL = f"WITH {TXN} " + " UNION ALL ".join(
    f"SELECT '{name}' AS feature_name, CAST(quantile_disc({name}, 0.5) AS DOUBLE) AS median FROM txn"
    for name in MEDIAN_COLUMNS
)


@query("exact_medians", MEDIAN_SQL)
def medians(spark, sf_dir):
    return exact_medians(v.transactions(spark, sf_dir), MEDIAN_COLUMNS)


@query("exact_medians_ranged", MEDIAN_SQL)
def medians_ranged(spark, sf_dir):
    """The same through 24 value ranges per column."""
    return exact_medians(v.transactions(spark, sf_dir), MEDIAN_COLUMNS, buckets=24)


@query("sales_median_price",
       "SELECT 'l_extendedprice' AS feature_name, quantile_disc(l_extendedprice, 0.5) AS median FROM lineitem")
def sales_median_price(spark, sf_dir):
    return exact_medians(v.table(spark, sf_dir, "lineitem"), ["l_extendedprice"])


@query("median_impute",
       f"WITH {TXN}, m AS (SELECT quantile_disc(transactionamt, 0.5) AS median FROM txn) "
       "SELECT transactionid, coalesce(transactionamt, median) AS transactionamt_imputed FROM txn, m")
def median_impute(spark, sf_dir):
    filled = impute_exact(v.transactions(spark, sf_dir), ["transactionamt"])
    return filled.select("transactionid", "transactionamt_imputed")


@query("median_stage",
       f"WITH {TXN}, m AS (SELECT quantile_disc(transactionamt, 0.5) AS amount, quantile_disc(k, 0.5) AS key, "
       "quantile_disc(CASE WHEN is_fraud = 1 THEN transactiondt END, 0.5) AS time FROM txn) "
       "SELECT transactionid, coalesce(transactionamt, amount) AS transactionamt_imputed, CAST(coalesce(k, key) AS DOUBLE) AS k_imputed, "
       "CAST(CASE WHEN is_fraud = 1 THEN transactiondt ELSE time END AS DOUBLE) AS flagged_imputed FROM txn, m")
def median_stage(spark, sf_dir):
    """The stage that training uses, learnt for three columns together, saved, loaded and applied."""
    txn = v.transactions(spark, sf_dir).withColumn("flagged", F.when(F.col("is_fraud") == 1, F.col("transactiondt")))
    names = ["transactionamt", "k", "flagged"]
    stage = ExactMedianImputer(inputCols=names, outputCols=[f"{name}_imputed" for name in names])
    path = scratch_path(spark, "median_stage")
    Pipeline(stages=[stage]).fit(txn).save(path)
    return PipelineModel.load(path).transform(txn).select("transactionid", *[f"{name}_imputed" for name in names])


PREPARED_STRINGS = ["productcd", "r_emaildomain", "device"]
PREPARED_SQL = f"""{WIDE_SQL}, top_device AS (SELECT device FROM wide GROUP BY device ORDER BY count(*) DESC, device LIMIT 10),
prepared AS (SELECT transactionid, productcd, coalesce(r_emaildomain, '__MISSING__') AS r_emaildomain,
  CASE WHEN device IN (SELECT device FROM top_device) THEN device ELSE '__OTHER__' END AS device,
  CAST(transactionamt AS DOUBLE) AS transactionamt, CAST(k AS DOUBLE) AS k, channel FROM wide)"""
PREPARED_PLAN = ("transactionamt", "k")


def prepared(spark, sf_dir):
    """The wide frame after category clean-up; the ten kept devices come to the driver."""
    data = wide(spark, sf_dir)
    kept = [row["value"] for row in p.top_categories(data, ["device"]).collect()]
    plan = s.FeaturePlan(PREPARED_PLAN, PREPARED_STRINGS, {"device": kept})
    return s.prepare_features(data, plan, {0: 1.0, 1: 1.0}, "is_fraud")


@query("prepared_features",
       f"{PREPARED_SQL} SELECT transactionid, productcd, r_emaildomain, device, transactionamt, k FROM prepared")
def prepared_features(spark, sf_dir):
    return prepared(spark, sf_dir).select("transactionid", *PREPARED_STRINGS, *PREPARED_PLAN)


@query("string_index",
       f"{PREPARED_SQL}, counts AS ({counts_sql('prepared', PREPARED_STRINGS)}) SELECT feature_name, value, n_rows, "
       "CAST(row_number() OVER (PARTITION BY feature_name ORDER BY n_rows DESC, value) - 1 AS DOUBLE) AS \"index\" FROM counts")
def indexed_strings(spark, sf_dir):
    return string_index(prepared(spark, sf_dir), PREPARED_STRINGS)


@query("zero_variance",
       f"{PREPARED_SQL}, counts AS ({counts_sql('prepared', ['productcd', 'channel'])}) "
       "SELECT concat(feature_name, '_ohe_', value) AS dimension, n_rows < (SELECT count(*) FROM prepared) AS kept FROM counts "
       "UNION ALL SELECT 'productcd_ohe___unknown', false UNION ALL SELECT 'channel_ohe___unknown', false "
       "UNION ALL SELECT 'k', var_samp(k) > 0 FROM prepared UNION ALL SELECT 'transactionamt', var_samp(transactionamt) > 0 FROM prepared")
def zero_variance(spark, sf_dir):
    return varying_dimensions(prepared(spark, sf_dir), ["k", "transactionamt"], ["productcd", "channel"])
