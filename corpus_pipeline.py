"""From raw documents to token ids: quality rules, near and exact deduplication, mixing, encoding.

Each stage takes what its predecessor kept, written as Parquet and read again, so a lost executor costs the tasks of one
stage. The rules of nulls, empty tables and repeated rows are those of the operators in ``tidemark.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, mixing, repetition, simhash, suffixes
from tidemark.llm.common import stored, table
from tidemark.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the coverage limits."""
    return repetition.kept_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within three bits, by three-word shingles."""
    return simhash.kept_documents(docs, shingle=3, bits=3)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of 50 bytes that a smaller doc_id has as well."""
    return suffixes.shortened_documents(docs, length=50)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of what they decode to."""
    return bpe.encoded_documents(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encoding", bpe_encoding),
]

#: The mix draws at random and the encoding needs merge ranks: no SQL gives these rows; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
