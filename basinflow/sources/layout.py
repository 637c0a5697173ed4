"""Blocks and weights stored for repeated zonal means: bucketed by block origin, blocks also by day.

Both tables lie in the same number of buckets, sorted within each, so their join plans no exchange: weights and
blocks are shuffled once, when they are stored, however many periods are asked for. A period reads the folders of its days
only. Further hours are added to the blocks without touching what is stored.

A task of the join reads one bucket of the days asked for; choose ``buckets`` so that this fits. The tables are
entries of the session's catalog over the given folder.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.functions.timestamps import ntz
from basinflow.operators.zonal import place_zones

ORIGIN = ["y0", "x0"]


def _store(df: DataFrame, name: str, folder: str, buckets: int, mode: str, days: bool) -> None:
    rows = df.repartition(buckets, *ORIGIN).sortWithinPartitions(*(["day"] if days else []), *ORIGIN)
    writer = rows.write.mode(mode).format("parquet").option("path", folder).bucketBy(buckets, *ORIGIN).sortBy(*ORIGIN)
    (writer.partitionBy("day") if days else writer).saveAsTable(name)


def store_zones(zones: DataFrame, chunk_shape: tuple[int, int], name: str, folder: str, buckets: int) -> None:
    """Store ``zones (id, j, i, w)`` as table ``{name}_zones``, in place of one that is there."""
    _store(place_zones(zones, chunk_shape), f"{name}_zones", f"{folder}/zones", buckets, "overwrite", False)


def add_blocks(chunks: DataFrame, name: str, folder: str, buckets: int) -> None:
    """Add blocks to table ``{name}_blocks``; hours that are there already would count twice."""
    dated = chunks.withColumn("day", F.to_date("time"))
    _store(dated, f"{name}_blocks", f"{folder}/blocks", buckets, "append", True)


def stored_period(spark: SparkSession, name: str, start: datetime, end: datetime) -> tuple[DataFrame, DataFrame]:
    """Blocks of the hours from ``start`` through ``end``, and the placed weights, as stored."""
    blocks = spark.table(f"{name}_blocks").filter(
        F.col("day").between(F.lit(start.date()), F.lit(end.date())) & F.col("time").between(ntz(start), ntz(end)))
    return blocks.drop("day"), spark.table(f"{name}_zones")
