"""The modelling frame and its derived columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom import views as v
from riskloom.functions import (
    any_present,
    cyclic_pair,
    equal_flag,
    fill_missing_string,
    log_amount,
    map_top_k,
    time_parts,
)
from riskloom.functions.times import CLOCK_PERIODS
from riskloom.operators.profile import top_categories
from riskloom.plans.modeling import join_identity, modeling_frame
from riskloom.queries.registry import IDENTITY, TXN, query

JOINED = f"WITH {TXN}, {IDENTITY}"
SOURCE = "txn LEFT JOIN ident USING (transactionid)"


def six(column: Column) -> Column:
    """A computed double with six places, for comparison across math libraries."""
    return column.cast("decimal(18,6)").cast("double")


def sql_six(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(18,6)) AS DOUBLE)"


def _turn(function: str, value: str, period: int) -> str:
    return sql_six(f"{function}(CAST({value} AS DOUBLE) * (2 * pi() / {period}))")


CLOCK_SQL = {
    "hour": ("(transactiondt % 86400) // 3600", 24),
    "minute": ("(transactiondt % 3600) // 60", 60),
    "second": ("transactiondt % 60", 60),
}
CYCLIC_SQL = ", ".join(
    f"{_turn(function, value, period)} AS event_{part}_{function}"
    for part, (value, period) in CLOCK_SQL.items()
    for function in ("sin", "cos")
)
FRAME_SQL = (
    f"{JOINED} SELECT transactionid, CAST(is_fraud AS DOUBLE) AS label, "
    "CASE WHEN id_01 IS NOT NULL OR id_02 IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS identity_present, "
    f"{sql_six('ln(1 + transactionamt)')} AS log_transactionamt, "
    "CASE WHEN p_emaildomain = r_emaildomain THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS email_domain_match, "
    f"CAST(transactiondt // 86400 AS DOUBLE) AS event_day, {CYCLIC_SQL} FROM {SOURCE}"
)


@query("modeling_frame", FRAME_SQL)
def frame(spark, sf_dir):
    """All derived columns of the frame at once."""
    built = modeling_frame(v.transactions(spark, sf_dir), v.identity(spark, sf_dir))
    return built.select(
        "transactionid",
        "label",
        "identity_present",
        six(F.col("log_transactionamt")).alias("log_transactionamt"),
        "email_domain_match",
        "event_day",
        *[
            six(F.col(f"event_{part}_{function}")).alias(f"event_{part}_{function}")
            for part in CLOCK_PERIODS
            for function in ("sin", "cos")
        ],
    )


@query("identity_join", f"{JOINED} SELECT transactionid, productcd, id_01, id_02 FROM {SOURCE}")
def identity_join(spark, sf_dir):
    joined = join_identity(v.transactions(spark, sf_dir), v.identity(spark, sf_dir))
    return joined.select("transactionid", "productcd", "id_01", "id_02")


@query("identity_present",
       f"{JOINED} SELECT CASE WHEN id_01 IS NOT NULL OR id_02 IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS identity_present, "
       f"count(*) AS n_rows FROM {SOURCE} GROUP BY 1")
def identity_present(spark, sf_dir):
    joined = join_identity(v.transactions(spark, sf_dir), v.identity(spark, sf_dir))
    flag = any_present([F.col("id_01"), F.col("id_02")])
    return joined.groupBy(flag.alias("identity_present")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("time_parts",
       f"WITH {TXN} SELECT transactionid, CAST(transactiondt // 86400 AS DOUBLE) AS \"day\", "
       + ", ".join(f"CAST({value} AS DOUBLE) AS \"{part}\"" for part, (value, _) in CLOCK_SQL.items())
       + " FROM txn")
def clock_parts(spark, sf_dir):
    parts = time_parts(F.col("transactiondt"))
    return v.transactions(spark, sf_dir).select(
        "transactionid", *[column.alias(name) for name, column in parts.items()]
    )


@query("cyclic_time",
       f"WITH {TXN} SELECT transactionid, {_turn('sin', CLOCK_SQL['hour'][0], 24)} AS hour_sin, "
       f"{_turn('cos', CLOCK_SQL['hour'][0], 24)} AS hour_cos FROM txn")
def cyclic_time(spark, sf_dir):
    sine, cosine = cyclic_pair(time_parts(F.col("transactiondt"))["hour"], 24.0)
    return v.transactions(spark, sf_dir).select(
        "transactionid", six(sine).alias("hour_sin"), six(cosine).alias("hour_cos")
    )


@query("log_amount", f"WITH {TXN} SELECT transactionid, {sql_six('ln(1 + transactionamt)')} AS log_transactionamt FROM txn")
def amount_log(spark, sf_dir):
    return v.transactions(spark, sf_dir).select(
        "transactionid", six(log_amount(F.col("transactionamt"))).alias("log_transactionamt")
    )


@query("domain_match",
       f"WITH {TXN} SELECT CASE WHEN p_emaildomain = r_emaildomain THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS email_domain_match, "
       "count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_flagged FROM txn GROUP BY 1")
def domain_match(spark, sf_dir):
    flag = equal_flag(F.col("p_emaildomain"), F.col("r_emaildomain"))
    return (
        v.transactions(spark, sf_dir)
        .groupBy(flag.alias("email_domain_match"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("is_fraud").alias("n_flagged"))
    )


@query("labelled_documents", "SELECT d.doc_id, lang, source, n_chars, CAST(quality AS DOUBLE) AS label "
       "FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL")
def labelled_documents(spark, sf_dir):
    """Rows with a label only, the label as a double."""
    return (
        v.documents(spark, sf_dir)
        .where(F.col("label").isNotNull())
        .withColumn("label", F.col("label").cast("double"))
    )


@query("missing_fill", f"WITH {TXN} SELECT transactionid, coalesce(r_emaildomain, '__MISSING__') AS r_emaildomain FROM txn")
def missing_fill(spark, sf_dir):
    return v.transactions(spark, sf_dir).select(
        "transactionid", fill_missing_string(F.col("r_emaildomain")).alias("r_emaildomain")
    )


@query("topk_mapping",
       f"WITH {TXN}, top AS (SELECT r_emaildomain AS value FROM txn WHERE r_emaildomain IS NOT NULL "
       "GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10) "
       "SELECT transactionid, CASE WHEN r_emaildomain IS NULL THEN '__MISSING__' "
       "WHEN r_emaildomain IN (SELECT value FROM top) THEN r_emaildomain ELSE '__OTHER__' END AS r_emaildomain FROM txn")
def topk_mapping(spark, sf_dir):
    """The ten most frequent domains stay; brings those ten to the driver."""
    txn = v.transactions(spark, sf_dir)
    kept = [row["value"] for row in top_categories(txn, ["r_emaildomain"]).collect()]
    return txn.select("transactionid", map_top_k(F.col("r_emaildomain"), kept).alias("r_emaildomain"))
