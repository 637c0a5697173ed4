"""Running totals, ranks and sequence numbers over a whole table without a one-task sort.

A global window sends every row to one task. Here the rows are dealt into ranges of the ordered
column; each range is summed and sorted on its own, and the totals of the preceding ranges are added
as an offset. Only the totals, one row per range, are ever ordered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basinflow.session import cut


def running_before(df: DataFrame, key: str, amount: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over all rows with a smaller ``key``.

    ``key`` must be unique and not NULL; pre-aggregate ties first.
    """
    # written once: the ranges are found by sampling, and both uses below must see the same ones
    ranged = df.repartitionByRange(key).withColumn("_range", F.spark_partition_id())
    parts = cut(ranged, "ranges")
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_range").agg(F.sum(amount).alias("_total"))
        .select(
            F.col("_range").alias("_of"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
        )
    )
    inner = W.partitionBy("_range").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    within = parts.withColumn("_within", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
    return (
        within.join(offsets, F.col("_range") == F.col("_of"))
        .withColumn(out, (F.col("_within") + F.col("_offset")).cast("bigint"))
        .drop("_range", "_of", "_within", "_offset")
    )


def sequential_id(df: DataFrame, order_by: str, out: str) -> DataFrame:
    """Number the rows ``1..n`` by the unique column ``order_by``."""
    numbered = running_before(df.withColumn("_one", F.lit(1)), order_by, "_one", "_before")
    return numbered.withColumn(out, F.col("_before") + 1).drop("_one", "_before")


def average_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """Zero-based rank of ``column``; ties share the mean of their positions, NULL stays NULL.

    Ties are counted before anything is ordered, so a value held by most rows is one row here.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    ranks = running_before(counts, column, "_n", "_before").select(
        F.col(column).alias("_value"), (F.col("_before") + (F.col("_n") - 1) / 2).alias("_mid")
    )
    joined = df.join(ranks, F.col(column) == F.col("_value"), "left")
    return joined.select(*df.columns, F.col("_mid").cast("double").alias(out))
