"""A training corpus from the documents table: toxic documents go, copies and near copies go, sources are mixed to
their target weights, and what is left is encoded.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. When a stage starts, what earlier ones stored on the way is
deleted, since their results are written by then.

Null texts count as empty, null ids and sources as values of their own, repeated rows are copies; texts of any length are read whole.
Extra columns pass through, whatever their names. An empty table gives an empty corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from lodestone.llm.shared import Leftovers, stored, table

_leftovers = Leftovers()


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the nearest labelled examples don't call toxic."""
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z), the row of the largest doc_id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: words in shingles of five, Jaccard similarity of 0.8 or more."""
    return jaccard_join.representatives(docs, shingle=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; a document that the mix takes several times has as many rows."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each row."""
    return bpe.encode(docs).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


def _tidy(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, which first deletes what the one before it left."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _leftovers.delete()
        return _leftovers.of(lambda: stage(spark, docs, sf_dir))

    return run_stage


STAGES = [(name, _tidy(stage)) for name, stage in (("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("jaccard_join", drop_near_copies), ("mixing", mix_sources), ("byte_bpe", encode))]
#: SQL can express neither the classifier nor the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
