"""Documents to token ids: language, exact copies, near copies, mixing by source, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe, exact, jaccard, language, mixing
from riskloom.llm.common import stored

TOKENIZER = "byte_bpe_50k.json"


def in_some_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are in no language go; the text model is fitted on a bounded sample of the rows with a declared one."""
    return language.keep_identified(docs, docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that share four fifths of their runs of five words the row with the smallest doc_id stays.

    SimHash fingerprints of the runs propose pairs, MinHash bands those whose fingerprints lie further apart.
    """
    return jaccard.keep_first(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are taken to their target sizes: rows repeat, stay, or go."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row of the mix, decoded again."""
    return bpe.encoded_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", in_some_language),
    ("exact duplicates", without_copies),
    ("near duplicates", without_near_copies),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: Sets of shingles, fitted likelihoods and byte-pair merges are beyond SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage reads what the one before wrote to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{number}")
    return docs
