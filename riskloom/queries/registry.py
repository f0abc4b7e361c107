"""Registration of queries and the SQL views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows can be checked."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


TXN = """txn AS (
  SELECT event_id AS transactionid,
         date_diff('second', TIMESTAMP '2024-01-01', ts) AS transactiondt,
         CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS transactionamt,
         CASE WHEN CAST(regexp_extract(props, '[0-9]+', 0) AS INT) < 20 THEN 1 ELSE 0 END AS is_fraud,
         event_type AS productcd,
         CASE WHEN user_id % 7 = 0 THEN NULL ELSE concat('src', CAST(user_id % 20 AS VARCHAR)) END AS p_emaildomain,
         CASE WHEN event_id % 3 = 0 THEN NULL
              ELSE concat('src', CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 20 AS VARCHAR)) END AS r_emaildomain,
         c_mktsegment AS card4,
         CASE WHEN c_custkey IS NULL THEN NULL WHEN c_acctbal < 0 THEN 'overdrawn' ELSE 'credit' END AS card6
  FROM events LEFT JOIN customer ON user_id = c_custkey
)"""

IDENTITY = """ident AS (
  SELECT doc_id AS transactionid, nullif(quality, 0) AS id_01, nullif(toxic, 0) AS id_02 FROM labels
)"""

SALES = """sales AS (
  SELECT date_diff('second', TIMESTAMP '1992-01-01', l_shipdate) AS transactiondt,
         l_extendedprice AS transactionamt,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_fraud,
         p_type AS productcd, l_linestatus AS card4, o_orderpriority AS card6, o_custkey AS p_emaildomain
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
)"""

DOCS = """docs AS (
  SELECT d.doc_id, lang, source, n_chars, quality AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

SCORES = (
    TXN
    + """, scores AS (
  SELECT transactionid, transactionamt / 500 AS score, is_fraud AS label,
         CASE WHEN transactionamt >= 25 THEN 1 ELSE 0 END AS prediction
  FROM txn WHERE transactionamt IS NOT NULL
)"""
)


def cents(column: str) -> str:
    """Whole cents of an amount."""
    return f"CAST(round({column} * 100) AS BIGINT)"


def percent(part: str, whole: str) -> str:
    """``part`` in percent of ``whole``, half up to two places, in whole numbers until the end."""
    return f"CAST(({part} * 20000 + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


def md5_bucket(text: str) -> str:
    """First 32 bits of an MD5 as a number."""
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def rate_sql(view: str, source: str, keys: str, *, where: str = "TRUE", having: str = "TRUE",
             average: bool = True, total: bool = False, order: str = "", names: str | None = None) -> str:
    """A 0-1 rate report over a view."""
    measures = ["COUNT(*) AS total_transactions", "CAST(SUM(is_fraud) AS BIGINT) AS fraud_transactions",
                "CAST(SUM(is_fraud) AS DOUBLE) / COUNT(*) AS fraud_rate"]
    units = f"CAST(SUM({cents('transactionamt')}) AS DOUBLE) / 100"
    if average:
        measures.append(f"{units} / COUNT(transactionamt) AS avg_amount")
    if total:
        measures.append(f"{units} AS total_amount")
    return (
        f"WITH {view} SELECT {keys}, {', '.join(measures)} FROM {source} WHERE {where} "
        f"GROUP BY {names or keys} HAVING {having} {order}"
    )


def percent_sql(view: str, source: str, keys: str, *, where: str = "TRUE", average: bool = False,
                order: str = "", names: str | None = None) -> str:
    """A percent report over a view."""
    measures = ["COUNT(*) AS total_transactions", "CAST(SUM(is_fraud) AS BIGINT) AS fraud_count",
                f"{percent('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct"]
    if average:
        units, count = f"SUM({cents('transactionamt')})", "COUNT(transactionamt)"
        measures.append(f"CAST(({units} * 2 + {count}) // (2 * {count}) AS DOUBLE) / 100 AS avg_amount")
    return (
        f"WITH {view} SELECT {keys}, {', '.join(measures)} FROM {source} WHERE {where} "
        f"GROUP BY {names or keys} {order}"
    )


def band_sql(edges, labels, column: str = "transactionamt") -> str:
    steps = " ".join(f"WHEN {column} < {edge} THEN '{label}'" for edge, label in zip(edges, labels))
    return f"CASE {steps} ELSE '{labels[-1]}' END"
