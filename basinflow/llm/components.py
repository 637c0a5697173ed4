"""Connected components of a graph too large for one machine, by alternating large-star and small-star.

Large-star ties every larger neighbour of a node to the least node it sees; small-star ties the smaller
neighbours, and the node itself, to the least of them. Repeated in turn, the edges become stars around
the least node of each component. Minima are aggregated before they are joined back, so a node with a
large part of all edges reaches the join as one row on one side; Spark splits the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from basinflow.session import delete, scratch_path


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` for every id in ``links``, the component being its least id.

    Links may repeat, point either way or join an id to itself; nulls are left out. Each round is written
    to the shared folder and the round before is deleted. Without links there are no rows.
    """
    spark = links.sparkSession
    edges = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct()
    path, before = None, None
    while True:
        seen = Observation()
        out = scratch_path(spark, "stars")
        edges.observe(
            seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.bit_xor(F.xxhash64("v", "u")).alias("y"),
        ).write.parquet(out)
        now = seen.get
        if path:
            delete(spark, path)
        path, stars = out, spark.read.schema("u long, v long").parquet(out)
        if now == before or not now["n"]:
            break
        before = now
        edges = small_star(large_star(stars))
    centres = stars.select(F.col("v").alias("id")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        centres.select("id", F.col("id").alias("component"))
    )
