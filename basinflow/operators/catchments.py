"""Model input configuration per catchment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def configure_catchments(
    catchments: DataFrame, attributes: DataFrame, forcing: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Configuration rows and forcing of every catchment.

    ``catchments(id)``, ``attributes(id, …)`` and zonal ``forcing(id, time, var, mean, …)``. A
    catchment without attributes keeps NULLs; one without forcing has no time range and 0 steps.
    """
    spans = forcing.groupBy("id").agg(
        F.min("time").alias("time_first"), F.max("time").alias("time_last"),
        F.count_distinct("time").alias("n_steps"),
    )
    config = (
        catchments.select("id").distinct()
        .join(attributes, "id", "left")
        .join(spans, "id", "left")
        .withColumn("n_steps", F.coalesce("n_steps", F.lit(0).cast("bigint")))
        .withColumn("config_name", F.concat(F.lit("cat-"), F.col("id").cast("string")))
    )
    inputs = forcing.join(catchments.select("id").distinct(), "id", "left_semi")
    return config, inputs
