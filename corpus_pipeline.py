"""A corpus pipeline: bad documents out, copies and near copies out, sources mixed, tokens made.

Each stage takes ``(spark, docs, sf_dir)``, where ``docs`` has the columns of ``documents``, and returns a
DataFrame. ``run`` applies them in order to the documents of a folder; each result is written as Parquet
to the shared folder and read again as the next stage's input.

The stages inherit the defined results of their operators for nulls, empty and very long texts, ties,
repeated rows, empty tables and further columns; all but the last return the columns they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.llm import bpe, exact, minhash, mixing, quality
from basinflow.llm.queries import held_out, table, vocabulary
from basinflow.session import cut

# SQL can express neither the classifier nor the encoding; tests compare each stage with brute force.
ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier calls good. It learns from the labelled rows among ``documents``."""
    model = quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out())
    return quality.keep(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.dedup(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return minhash.dedup(docs, minhash.Settings(shingle=5, threshold=80))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: ``doc_id, n_tokens, ids``."""
    return bpe.encode(docs, vocabulary()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", good), ("exact_dedup", distinct), ("near_dedup", unlike), ("mixing", mixed), ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
