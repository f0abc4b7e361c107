"""The modelling frame: transactions with identity columns and derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.amounts import log_amount
from riskloom.functions.flags import any_present, equal_flag
from riskloom.functions.times import CLOCK_PERIODS, cyclic_pair, time_parts
from riskloom.sources.schema import normalize_columns


def join_identity(transactions: DataFrame, identity: DataFrame, key: str = "transactionid") -> DataFrame:
    """Every transaction with its identity columns, NULL where there are none.

    The key is unique on the identity side; the join strategy is left to the
    optimizer, and tables bucketed alike on the key join without a shuffle.
    """
    return transactions.join(identity, key, "left")


def identity_columns(identity: DataFrame, key: str = "transactionid") -> list[str]:
    return [name for name in identity.columns if name != key]


def time_features(seconds: str = "transactiondt") -> dict:
    """event_day and the cyclic clock parts."""
    parts = time_parts(F.col(seconds))
    features = {"event_day": parts["day"]}
    for part, period in CLOCK_PERIODS.items():
        sine, cosine = cyclic_pair(parts[part], period)
        features[f"event_{part}_sin"], features[f"event_{part}_cos"] = sine, cosine
    return features


def modeling_frame(transactions: DataFrame, identity: DataFrame) -> DataFrame:
    """Labelled rows with all source columns and the derived features, in one projection."""
    transactions, identity = normalize_columns(transactions), normalize_columns(identity)
    joined = join_identity(transactions, identity)
    return (
        joined.where(F.col("is_fraud").isNotNull())
        .withColumns(
            {
                "transactionid": F.col("transactionid").cast("bigint"),
                "label": F.col("is_fraud").cast("double"),
                "identity_present": any_present([F.col(name) for name in identity_columns(identity)]),
                "log_transactionamt": log_amount(F.col("transactionamt")),
                "email_domain_match": equal_flag(F.col("p_emaildomain"), F.col("r_emaildomain")),
                **time_features(),
            }
        )
    )
