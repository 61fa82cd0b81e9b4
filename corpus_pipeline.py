"""The corpus pipeline: each stage takes what its predecessor kept, and its rows are stored before the next one starts.

Stages return the columns of `documents`, the last one the digests of its token ids. A document that the mix takes twice
comes twice. Null texts are rejected with the other texts without words; a null id or source is an id or source like any
other, except that a document without an id is no near copy of anything. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwatch.llm import bpe, mixing, ngram_join, quality, secret_scan
from tillwatch.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no quality rule rejects."""
    return quality.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return ngram_join.without_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, in training order."""
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, number of tokens, digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("mixture", mixture),
    ("encoding", encoding),
]

#: The stages between decode nested layers and merge by rank, which SQL cannot express: tests/llm checks the rows of the
#: whole pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
