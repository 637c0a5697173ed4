"""Exact dedup by skew-safe combining.

Texts are equal when they are identical after each run of white space has become one space; null
counts as empty. Three merges, each keyed by the full content next to its digest: within each task
(the partial side of the first aggregate), within each salt, then over the winners of all salts. A
text that a third of all rows share reaches the last merge as one row per salt.

Defined results: of equal texts the smallest id stays, a null id only where no row has one. Rows that
repeat an id and its text all count in ``group_size`` and are all marked; ``dedup`` returns one of them.
Columns beyond id and text are ignored by ``mark`` and carried by ``dedup``. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.llm.common import fresh, squeezed
from basinflow.session import cut


def _keys(content: Column) -> list[Column]:
    """What leads a document back to its group: two digests and the length of the content."""
    return [
        F.sha2(content, 256).alias("digest"),
        F.xxhash64(content).alias("second"),
        F.length(content).alias("length"),
    ]


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """One row per distinct text: ``digest, second, length, keep_id, group_size``."""
    rows = docs.select(F.col(id_col).alias("id"), squeezed(text_col).alias("content"))
    salted = rows.select(
        "id", "content", F.sha2("content", 256).alias("digest"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"),
    )
    winners = salted.groupBy("salt", "digest", "content").agg(
        F.min("id").alias("id"), F.count("*").alias("n"),
    )
    merged = winners.groupBy("digest", "content").agg(
        F.min("id").alias("keep_id"), F.sum("n").alias("group_size"),
    )
    return merged.select(*_keys(F.col("content")), "keep_id", "group_size")


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """One row per document: id, ``keep_id, group_size, kept, text_sha256``."""
    rows = docs.select(F.col(id_col), squeezed(text_col).alias("content")).select(
        id_col, *_keys(F.col("content"))
    )
    found = rows.join(groups(docs, id_col, text_col, salts), ["digest", "second", "length"])
    return found.select(
        id_col, "keep_id", "group_size",
        F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """The documents that stay, with all their columns."""
    key = fresh(docs, "_digest")
    stay = cut(
        mark(docs, id_col, text_col, salts).filter("kept")
        .groupBy(F.col(id_col).alias("_stay_id"), F.col("text_sha256").alias("_stay_digest"))
        .agg(F.count("*").alias("_stay_rows")),
        "exact-stay",
    )
    keyed = docs.withColumn(key, F.sha2(squeezed(text_col), 256))
    same = F.col(id_col).eqNullSafe(F.col("_stay_id")) & (F.col(key) == F.col("_stay_digest"))
    out = keyed.join(stay.filter("_stay_rows = 1"), same, "left_semi")
    again = stay.filter("_stay_rows > 1")
    if not again.isEmpty():
        out = out.unionByName(keyed.join(again, same, "left_semi").dropDuplicates([id_col, key]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
