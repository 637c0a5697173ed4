"""Quality by compression: ``compression`` with bad text as the target class.

The normalised difference of the sizes under the dictionaries of good and bad text, calibrated, is
the probability that a document is bad; the score is its complement.

Defined results: a null text counts as empty and gets the score of a text without words. Rows are
scored one by one, so repeated rows get equal scores and a null id is carried along. Without labels
of both classes every score is the good share of the labels. Very long texts are read whole, in
pieces. ``keep`` returns the columns it was given. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.llm import compression

THRESHOLD = 0.7
SETTINGS = compression.Settings(gram_sizes=(4, 6, 8), ordinary_bytes=20_000)


def learn(docs: DataFrame, labels: DataFrame, usable: Column, **names) -> compression.Model:
    """Train on the labelled rows that ``usable`` allows."""
    return compression.learn(docs, labels, "quality", 0, usable, **{"settings": SETTINGS} | names)


def score(docs: DataFrame, model: compression.Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``id, score, predicted``: the probability that a document is good, and whether it is called so."""
    found = compression.score(docs, model, id_col, text_col)
    found = found.withColumn("score", 1 - F.col("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, model: compression.Model, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """The documents called good, with all their columns."""
    found = compression.score(docs, model, id_col, text_col, carry=True)
    return found.filter(1 - F.col("_score") >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
