"""Toxicity by compression distance: ``compression`` with toxic text as the target class.

Defined results: a null text counts as empty and gets the score of a text without words. Rows are
scored one by one, so repeated rows get equal scores and a null id is carried along. Without labels
of both classes every score is the toxic share of the labels. Very long texts are read whole, in
pieces. Further columns are ignored. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.llm import compression

THRESHOLD = 0.3


def learn(docs: DataFrame, labels: DataFrame, usable: Column, **names) -> compression.Model:
    """Train on the labelled rows that ``usable`` allows."""
    return compression.learn(docs, labels, "toxic", 1, usable, **names)


def score(docs: DataFrame, model: compression.Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``id, score, predicted``: the probability that a document is toxic, and whether it is called so."""
    found = compression.score(docs, model, id_col, text_col)
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
