"""Sources, schemas, audits and sinks. Round trips write below the session's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskloom import views as v
from riskloom.functions.categories import best_model_text, source_feature, strip_order_prefix, trimmed
from riskloom.operators import quality as q
from riskloom.plans import exploration as x
from riskloom.plans.ingest import TableSpec, audit, run_ingest
from riskloom.queries.rates import CATEGORY_SQL
from riskloom.queries.registry import TXN, query
from riskloom.session import scratch_path
from riskloom.sources import records, reports, schema, sinks, tables

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query("table_counts",
       " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS rows_count FROM {name}" for name in ALL_TABLES))
def table_counts(spark, sf_dir):
    return tables.table_counts({name: v.table(spark, sf_dir, name) for name in ALL_TABLES})


@query("registered_tables",
       "SELECT n_name, count(*) AS customers FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name")
def registered_tables(spark, sf_dir):
    """Snapshot two tables, expose them as views, query them by name."""
    directory = scratch_path(spark, "snapshot")
    names = {"nation": "snap_nation", "customer": "snap_customer"}
    tables.snapshot_tables({new: v.table(spark, sf_dir, old) for old, new in names.items()}, directory)
    tables.register_tables(spark, directory, names.values())
    return spark.sql(
        "SELECT n_name, count(*) AS customers FROM snap_nation JOIN snap_customer "
        "ON n_nationkey = c_nationkey GROUP BY n_name"
    )


@query("pk_duplicates",
       "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk_duplicates(spark, sf_dir):
    return q.pk_duplicates(v.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("null_keys", f"WITH {TXN} SELECT transactionid, productcd FROM txn WHERE p_emaildomain IS NULL")
def null_keys(spark, sf_dir):
    return q.null_keys(v.transactions(spark, sf_dir), "p_emaildomain").select("transactionid", "productcd")


@query("fk_orphans", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def fk_orphans(spark, sf_dir):
    documents = v.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return q.fk_orphans(documents, v.table(spark, sf_dir, "labels"), "doc_id")


@query("customers_without_events",
       "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def customers_without_events(spark, sf_dir):
    """The other table names a key many times; its keys are made distinct before the join."""
    customers = v.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return q.fk_orphans(customers, v.table(spark, sf_dir, "events"), "c_custkey", "user_id")


@query("key_audit",
       "SELECT 'documents' AS table_name, 'null key' AS problem, count(*) AS n_rows FROM documents WHERE doc_id IS NULL "
       "UNION ALL SELECT 'documents', 'duplicate key', count(*) FROM (SELECT doc_id FROM documents GROUP BY 1 HAVING count(*) > 1) "
       "UNION ALL SELECT 'conversations', 'null key', count(*) FROM conversations WHERE conv_id IS NULL "
       "UNION ALL SELECT 'conversations', 'duplicate key', count(*) FROM (SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) > 1) "
       "UNION ALL SELECT 'conversations', 'no parent', count(*) FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM documents)")
def key_audit(spark, sf_dir):
    """The ingest audit over two tables, one of them a child with repeated keys."""
    frames = {
        "documents": v.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")),
        "conversations": v.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id")),
    }
    specs = [
        TableSpec("documents", "", key="id"),
        TableSpec("conversations", "", key="id", parent="documents"),
    ]
    return audit(frames, specs)


INTEGER = "'^[+-]?[0-9]+$'"
NUMBER = "'^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def _infer_sql(table: str, columns) -> str:
    cell = "nullif(trim(CAST({0} AS VARCHAR)), '')"
    parts = [
        f"SELECT '{name}' AS column_name, count({cell.format(name)}) AS non_empty, "
        f"CASE WHEN coalesce(bool_and(regexp_matches({cell.format(name)}, {INTEGER})), false) THEN 'BIGINT' "
        f"WHEN coalesce(bool_and(regexp_matches({cell.format(name)}, {NUMBER})), false) THEN 'NUMERIC' ELSE 'TEXT' END AS inferred_type FROM {table}"
        for name in columns
    ]
    return " UNION ALL ".join(parts)


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _as_text(frame, columns):
    return frame.select(*[F.col(name).cast("string").alias(name) for name in columns])


@query("infer_schema", _infer_sql("orders", ORDER_COLUMNS))
def infer_schema(spark, sf_dir):
    return schema.infer_schema(_as_text(v.table(spark, sf_dir, "orders"), ORDER_COLUMNS))


@query("infer_document_schema", _infer_sql("documents", DOCUMENT_COLUMNS))
def infer_document_schema(spark, sf_dir):
    texts = _as_text(v.table(spark, sf_dir, "documents"), DOCUMENT_COLUMNS)
    return schema.infer_schema(texts)


@query("cast_to_schema",
       "SELECT o_orderkey, CAST(o_custkey AS INT) AS o_custkey, o_totalprice, o_orderpriority, "
       "try_cast(o_orderstatus AS DOUBLE) AS o_orderstatus FROM orders")
def cast_to_schema(spark, sf_dir):
    """Text back to types; a status is no number and becomes NULL."""
    text = _as_text(v.table(spark, sf_dir, "orders"), ORDER_COLUMNS)
    declared = {
        "o_orderkey": "BIGINT", "o_custkey": "SMALLINT", "o_totalprice": "NUMERIC",
        "o_orderstatus": "NUMERIC", "o_orderpriority": "TEXT",
    }
    return schema.cast_to_schema(text, declared)


@query("normalized_columns", "SELECT s_suppkey AS supp_key, s_name AS supp_name, s_acctbal AS id_12 FROM supplier")
def normalized_columns(spark, sf_dir):
    raw = v.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Supp-Key"), F.col("s_name").alias("SUPP_Name"), F.col("s_acctbal").alias("id-12")
    )
    return schema.normalize_columns(raw)


@query("partition_last",
       f"WITH {TXN} SELECT transactionid, transactionamt, productcd, CAST(is_fraud AS INT) AS flagged FROM txn")
def partition_last(spark, sf_dir):
    txn = v.transactions(spark, sf_dir).select("transactionid", "is_fraud", "transactionamt", "productcd")
    return sinks.project_with_partition_last(txn, "is_fraud", "flagged")


@query("partitioned_bucketed_table",
       f"WITH {TXN} SELECT transactionid, transactionamt, productcd, is_fraud FROM txn")
def partitioned_bucketed_table(spark, sf_dir):
    """Written as a partitioned, bucketed ORC table and read back."""
    txn = v.transactions(spark, sf_dir).select("transactionid", "transactionamt", "productcd", "is_fraud")
    name = f"txn_{uuid.uuid4().hex}"
    sinks.write_partitioned_bucketed(txn, name, "is_fraud", "transactionid", path=scratch_path(spark, name))
    return spark.table(name)


@query("overwritten_partitions",
       f"WITH {TXN} SELECT transactionid, CASE WHEN is_fraud = 1 THEN 'checked' ELSE productcd END AS productcd, is_fraud FROM txn")
def overwritten_partitions(spark, sf_dir):
    """The flagged partition is replaced, the other one stays."""
    txn = v.transactions(spark, sf_dir).select("transactionid", "productcd", "is_fraud")
    name = f"txn_{uuid.uuid4().hex}"
    sinks.write_partitioned_bucketed(txn, name, "is_fraud", "transactionid", path=scratch_path(spark, name))
    checked = txn.where(F.col("is_fraud") == 1).withColumn("productcd", F.lit("checked"))
    sinks.overwrite_partitions(spark, checked, name)
    return spark.table(name)


@query("materialized_result", CATEGORY_SQL)
def materialized_result(spark, sf_dir):
    report = x.rate_by_category(v.transactions(spark, sf_dir), v.MONEY_SCALE)
    name = f"report_{uuid.uuid4().hex}"
    return sinks.materialize_result(report, name, scratch_path(spark, name))


CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("csv_round_trip", CUSTOMER_SQL)
def csv_round_trip(spark, sf_dir):
    """Exported as CSV, read with a checked header, types inferred over all rows, cast."""
    path = scratch_path(spark, "customer_csv")
    sinks.export_table_csv(v.table(spark, sf_dir, "customer"), path)
    text = tables.read_table_csv(spark, path)
    types = schema.declared_types(schema.infer_schema(text, None, {"c_nationkey": "SMALLINT"}))
    return schema.cast_to_schema(text, types)


@query("jsonl_round_trip", CUSTOMER_SQL)
def jsonl_round_trip(spark, sf_dir):
    path = scratch_path(spark, "customer_json")
    customers = v.table(spark, sf_dir, "customer")
    sinks.export_jsonl(customers, path)
    return spark.read.schema(customers.schema).json(path)


@query("document_csv_round_trip",
       "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def document_csv_round_trip(spark, sf_dir):
    """Whole texts, with their quotes, backslashes and line breaks, through CSV and back; an empty cell is NULL."""
    path = scratch_path(spark, "documents_csv")
    documents = v.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    sinks.export_table_csv(documents, path)
    return tables.read_table_csv(spark, path, documents.schema)


@query("split_csv_round_trip",
       "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def split_csv_round_trip(spark, sf_dir):
    """Whole texts through one CSV file with line breaks in its cells, read back by byte ranges."""
    path = scratch_path(spark, "split_csv")
    documents = v.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    sinks.export_table_csv(documents, path)
    return records.read_split_csv(spark, path, {field.name: field.dataType for field in documents.schema})


def _varied_orders(spark, sf_dir):
    """Orders as CSV files of three kinds: another order of columns, one column less, one more whose dates are text."""
    path = scratch_path(spark, "varied_csv")
    orders = v.table(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 3
    status = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).otherwise("1")
    sinks.export_table_csv(orders.where(kind == 0).select("o_orderkey", "o_custkey", F.lit(7).alias("o_orderstatus")), f"{path}/a")
    sinks.export_table_csv(orders.where(kind == 1).select("o_totalprice", "o_orderkey"), f"{path}/b")
    sinks.export_table_csv(orders.where(kind == 2).select(status.alias("o_orderstatus"), "o_orderpriority", "o_orderkey"), f"{path}/c")
    return [f"{path}/{part}" for part in "abc"]


@query("varied_files",
       "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS o_custkey, "
       "CASE o_orderkey % 3 WHEN 0 THEN '7' WHEN 2 THEN CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE '1' END END AS o_orderstatus, "
       "CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice END AS o_totalprice, "
       "CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority FROM orders")
def varied_files(spark, sf_dir):
    """Files with reordered, missing and added columns as one table, with the types that all files allow."""
    paths = _varied_orders(spark, sf_dir)
    texts = records.read_split_csv(spark, paths, file="from_file")
    types = schema.declared_types(records.merged_types(records.file_types(texts, "from_file")))
    return schema.cast_to_schema(texts.drop("from_file"), types)


@query("file_type_clashes",
       "SELECT 'o_orderstatus' AS column_name, 'a' AS folder, 'BIGINT' AS file_type, 'TEXT' AS merged_type "
       "WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey % 3 = 0) AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey % 6 = 2)")
def file_type_clashes(spark, sf_dir):
    """A column that is a number in some files and text in others, with the folder of the files of numbers."""
    texts = records.read_split_csv(spark, _varied_orders(spark, sf_dir), file="from_file")
    clashes = records.type_clashes(records.file_types(texts, "from_file"))
    folder = F.regexp_extract("file", "/([^/]+)/[^/]+$", 1)
    return clashes.select("column_name", folder.alias("folder"), "file_type", "merged_type").distinct()


@query("required_tables",
       "SELECT * FROM (VALUES (0, 'orders_archive'), (1, 'lineitem_archive')) missing(place, table_name)")
def required_tables(spark, sf_dir):
    """Tables that an ingest requires and the snapshot does not have, in the order required."""
    available = [row["table_name"] for row in table_counts(spark, sf_dir).select("table_name").collect()]
    missing = tables.missing_tables(available, ["orders", "orders_archive", "lineitem", "lineitem_archive"])
    return spark.createDataFrame(list(enumerate(missing)), "place int, table_name string")


@query("report_round_trip",
       "SELECT o_orderpriority, CAST(count(*) AS VARCHAR) AS n_rows, concat('\"', o_orderpriority, '\", \\', o_orderpriority) AS note "
       "FROM orders GROUP BY o_orderpriority")
def report_round_trip(spark, sf_dir):
    """A report with quotes and backslashes in its cells, written as one CSV and read as reports are."""
    priority = F.col("o_orderpriority")
    note = F.concat(F.lit('"'), priority, F.lit('", \\'), priority).alias("note")
    report = v.table(spark, sf_dir, "orders").groupBy(priority).agg(F.count(F.lit(1)).alias("n_rows")).select(priority, "n_rows", note)
    path = scratch_path(spark, "report_csv")
    sinks.export_csv(report, path, single_file=True)
    return reports.read_report_csv(spark, path)


@query("ingest_rejects",
       "WITH lines AS (SELECT o_orderkey, o_orderkey % 50 AS r FROM orders), found AS ("
       "SELECT 'null key' AS problem, count(*) FILTER (o_orderkey IS NULL) AS n_rows, true AS always FROM lines "
       "UNION ALL SELECT 'duplicate key', count(*), true FROM (SELECT o_orderkey FROM lines GROUP BY 1 HAVING count(*) > 1) "
       "UNION ALL SELECT 'malformed row', count(*) FILTER (r IN (7, 11)), false FROM lines "
       "UNION ALL SELECT 'cell of no BIGINT in o_custkey', count(*) FILTER (r = 13), false FROM lines) "
       "SELECT 'orders_text' AS table_name, problem, n_rows FROM found WHERE always OR n_rows > 0")
def ingest_rejects(spark, sf_dir):
    """A CSV of all orders, some lines short, some long, some keys no numbers: what the ingest reports."""
    kind = F.col("o_orderkey") % 50
    customer = F.when(kind == 13, "n/a").otherwise(F.col("o_custkey").cast("string"))
    cells = F.when(kind == 7, F.array(F.col("o_orderkey").cast("string"), customer)).otherwise(
        F.array(F.col("o_orderkey").cast("string"), customer, F.col("o_totalprice").cast("string"))
    )
    cells = F.when(kind == 11, F.array_append(cells, F.lit("more"))).otherwise(cells)
    path = scratch_path(spark, "orders_csv")
    lines = v.table(spark, sf_dir, "orders").select(F.array_join(cells, ",").alias("o_orderkey,o_custkey,o_totalprice"))
    lines.write.option("header", True).option("sep", "\u0001").csv(path)
    spec = TableSpec("orders_text", path, "o_orderkey", {"o_custkey": "BIGINT"})
    _, problems = run_ingest(spark, [spec], scratch_path(spark, "orders_snapshot"))
    return problems


@query("json_line_validity",
       "SELECT origin, count(*) AS n_lines, count(*) FILTER (NOT json_valid(line)) AS n_corrupt FROM "
       "(SELECT 'events' AS origin, props AS line FROM events UNION ALL SELECT 'documents', text FROM documents "
       "UNION ALL SELECT 'spoiled', concat(props, ' x') FROM events) GROUP BY origin")
def json_line_validity(spark, sf_dir):
    """Valid lines, whole texts, and valid lines with something after them."""
    props = v.table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    lines = {
        "events": props,
        "documents": v.table(spark, sf_dir, "documents").select(F.col("text").alias("value")),
        "spoiled": props.select(F.concat("value", F.lit(" x")).alias("value")),
    }
    checked = [
        q.json_line_validity(frame).select(F.lit(name).alias("origin"), "n_lines", "n_corrupt")
        for name, frame in lines.items()
    ]
    return checked[0].unionByName(checked[1]).unionByName(checked[2])


@query("typed_report",
       f"WITH rep AS ({CATEGORY_SQL}) SELECT productcd, CAST(total_transactions AS DOUBLE) AS total_transactions, "
       "fraud_rate, CASE WHEN fraud_rate > 0.2 THEN 1 ELSE 0 END AS included FROM rep")
def typed_report(spark, sf_dir):
    """A report as text, as its CSV holds it, typed again by column name."""
    report = x.rate_by_category(v.transactions(spark, sf_dir), v.MONEY_SCALE)
    text = report.select(
        "productcd",
        F.col("total_transactions").cast("string").alias("total_transactions"),
        F.col("fraud_rate").cast("string").alias("fraud_rate"),
        F.when(F.col("fraud_rate") > 0.2, "True").otherwise("False").alias("included"),
    )
    return reports.cast_report_columns(text)


@query("present_rows",
       f"WITH {TXN} SELECT p_emaildomain, r_emaildomain FROM txn WHERE p_emaildomain IS NOT NULL OR r_emaildomain IS NOT NULL")
def present_rows(spark, sf_dir):
    """Rows with at least one of the chosen columns."""
    txn = v.transactions(spark, sf_dir).select("transactionid", *[
        F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("p_emaildomain", "r_emaildomain")
    ])
    return reports.select_present(txn, ["p_emaildomain", "r_emaildomain"])


@query("text_functions",
       "SELECT doc_id, CASE WHEN contains(name, '_ohe_') THEN split_part(name, '_ohe_', 1) ELSE regexp_replace(name, '_imputed$', '') END AS source_feature, "
       "regexp_replace(label, '^[0-9]+_', '') AS label, trim(padded) AS trimmed, "
       "printf('Best model: %s; test AUC-PR: %.3f', lang, CAST(n_chars AS DOUBLE)) AS display_text FROM "
       "(SELECT *, CASE WHEN n_chars > 1000 THEN concat(source, '_ohe_', lang, '_ohe_') ELSE concat(source, '_imputed') END AS name, "
       "concat(CAST(doc_id AS VARCHAR), '_', source) AS label, concat('  ', lang, ' ') AS padded FROM documents)")
def text_functions(spark, sf_dir):
    """Source feature, band label, trimmed name and display text per document."""
    long = F.concat("source", F.lit("_ohe_"), "lang", F.lit("_ohe_"))
    short = F.concat("source", F.lit("_imputed"))
    return v.table(spark, sf_dir, "documents").select(
        "doc_id",
        source_feature(F.when(F.col("n_chars") > 1000, long).otherwise(short)).alias("source_feature"),
        strip_order_prefix(F.concat(F.col("doc_id").cast("string"), F.lit("_"), "source")).alias("label"),
        trimmed(F.concat(F.lit("  "), "lang", F.lit(" "))).alias("trimmed"),
        best_model_text(F.col("lang"), F.col("n_chars").cast("double")).alias("display_text"),
    )
