"""Mix sources to target weights by systematic sampling.

A source's target is its share of all words by weight, at most ``cap`` times the words it has; what a
capped source leaves is shared again by weight among the others. Every document of a source expects
``target / source words`` copies. The expected copies are prefix-summed over the documents of a
source, one random offset per source is added, and a document is emitted once for each whole number
its interval crosses. Documents are ordered by bucket, size and id, so that the words taken stay near
the target and a rerun gives the same mix.

A source may hold any part of the rows: it is cut into buckets by a hash of the id, about as many as
each holds rows. Only bucket totals are summed per source.

Defined results: a null text has no words, a null source is a source of its own, ordered last. A null
id takes part like any other. Rows that repeat an id are documents of their own. Sources without
words have target 0 and no copies. No rows give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basinflow.llm.common import unit_hash, word_count
from basinflow.session import cut

# Weights in the order of the sources, repeating.
WEIGHTS = (1, 2, 3)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 3) -> DataFrame:
    """One row per source of ``sizes (source, size)``: ``source, sid, weight, n_docs, source_size, target``.

    Sources with little room for their weight are capped first; the first one whose share fits within
    its cap sets the words per weight of all that follow. This works on one row per source.
    """
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    wide = per_source.withColumn("sid", F.row_number().over(by_name)).withColumn("weight", weight)
    room = wide.withColumn("most", F.col("source_size") * F.lit(cap))
    order = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = room.select(
        "*",
        F.sum("source_size").over(every).alias("total"),
        F.coalesce(F.sum("most").over(before), F.lit(0)).alias("gone"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("rest"),
    )
    big = "decimal(38,0)"
    fits = (
        F.col("most").cast(big) * F.col("rest") > F.col("weight") * (F.col("total") - F.col("gone")).cast(big)
    )
    level = F.when(fits, F.struct("most", (F.col("total") - F.col("gone")).alias("left"), "rest"))
    # Once one source fits, all with more room per weight fit at the same level.
    first = F.first(level, ignorenulls=True).over(every)
    levelled = steps.withColumn("_level", first).withColumn("_fits", fits)
    share = F.col("weight") * F.col("_level.left").cast("double") / F.col("_level.rest")
    return levelled.select(
        "source", "sid", "weight", "n_docs", "source_size",
        F.when(F.col("_fits"), share).otherwise(F.col("most").cast("double")).alias("target"),
    )


def _buckets(n_docs: Column) -> Column:
    rows = F.greatest(F.lit(256.0), F.ceil(F.sqrt(n_docs.cast("double"))).cast("double"))
    return F.greatest(F.lit(1), F.ceil(n_docs / rows)).cast("long")


def plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, cap: int = 3, seed: int = 7,
) -> DataFrame:
    """All columns of ``docs`` as the struct ``doc``, then ``source, size, source_size, target, copies``."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        unit_hash(F.lit(seed), F.col(id_col)).alias("h"),
        F.col(id_col).alias("id"),
    )
    small = cut(rows.select("source", "size", "h"), "mix-sizes")
    per_source = cut(targets(small, weights, cap), "mix-targets").select(
        F.col("source").alias("_source"), "sid", "n_docs", "source_size", "target"
    )

    def placed(df: DataFrame) -> DataFrame:
        """With the source's figures and the bucket; the targets are one small row per source, whose
        written size decides how Spark joins them."""
        joined = df.join(per_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        return joined.withColumn("bucket", F.pmod(F.col("h"), _buckets(F.col("n_docs"))))

    totals = placed(small).groupBy("sid", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("sid").alias("_sid"), F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
    )
    within = Window.partitionBy("sid", "bucket").orderBy("size", "h", F.col("id").asc_nulls_first())
    ranked = placed(rows).withColumn("rank", F.row_number().over(within))
    ranked = ranked.join(offsets, (F.col("sid") == F.col("_sid")) & (F.col("bucket") == F.col("_bucket")))
    # Every document of a source expects the same copies, so the prefix sum is rank times rate, exactly.
    place = F.col("offset") + F.col("rank")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    shift = unit_hash(F.lit(seed), F.lit("offset"), F.col("source")) / F.lit(float(2**60))
    copies = F.floor(place * rate + shift) - F.floor((place - 1) * rate + shift)
    return ranked.select(
        "doc", "id", "source", "size", "source_size", "target",
        F.least(copies, F.lit(math.ceil(cap))).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents, each as often as the plan takes it."""
    taken = plan(docs, **settings).filter("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
