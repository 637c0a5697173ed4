"""Readers of the model's tables. Each returns a lazy DataFrame; columns are pruned by use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinflow import schemas
from basinflow.functions.timestamps import ntz


def read_chunks(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Stored grid blocks; several paths are read as one dataset."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schemas.CHUNKS).parquet(*paths)


def open_listed(spark: SparkSession, listing: DataFrame, root: str) -> DataFrame:
    """Blocks of the hours in a listing ``(valid_time)``, from a store with a ``time`` column.

    The listing's first and last hour become literal predicates that reach the files; the exact hours
    are then matched, so gaps in the listing stay gaps.
    """
    span = listing.agg(F.min("valid_time").alias("a"), F.max("valid_time").alias("b")).first()
    chunks = read_chunks(spark, root)
    if span.a is None:
        return chunks.filter(F.lit(False))
    hours = listing.select(F.col("valid_time").alias("time")).distinct()
    inside = F.col("time").between(ntz(span.a), ntz(span.b))
    return chunks.filter(inside).join(hours, "time", "left_semi")


def read_weights(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(weights, polys)``: two tables of different length stored side by side."""
    return (
        spark.read.schema(schemas.WEIGHTS).parquet(f"{path}/data"),
        spark.read.schema(schemas.POLYS).parquet(f"{path}/polys"),
    )


def read_links(
    spark: SparkSession, path: str, cols: Sequence[str] | None = None
) -> DataFrame:
    """Links with every stored variable but ``time``, plus the trimmed gauge number ``site_no``.

    With ``cols`` only those variables are read.
    """
    links = spark.read.parquet(path)
    if cols is not None:
        return links.select(*cols)
    return links.drop("time").withColumn("site_no", F.trim("gages"))


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """A parameter table (buckets, lakes, lake types) with all its variables."""
    return spark.read.parquet(path)


def read_grid(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(grid_cells, attrs)`` of a grid template."""
    return (
        spark.read.schema(schemas.GRID_CELLS).parquet(f"{path}/cells"),
        spark.read.schema(schemas.ATTRS).parquet(f"{path}/attrs"),
    )


def spatial_ref(attrs: DataFrame, dataset: str) -> str:
    """The coordinate system text of a dataset."""
    found = attrs.filter(
        (F.col("dataset") == dataset) & (F.col("variable") == "crs")
        & (F.col("name") == "spatial_ref")
    ).select(F.element_at("value", 1).alias("v")).distinct().limit(2).collect()
    if not found:
        raise ValueError(f"dataset {dataset} has no spatial_ref")
    if len(found) > 1:
        raise ValueError(f"dataset {dataset} has several spatial_refs")
    return found[0].v


def read_hydrofabric(
    spark: SparkSession, base: str, vpu_id: str, layers: Sequence[str]
) -> dict[str, DataFrame]:
    """Layers of one vector processing unit, stored as ``{base}/{layer}/vpu_id={vpu_id}``.

    The unit's folder is read by name, for an id such as ``02`` is text and not the number 2.
    """
    return {
        layer: spark.read.parquet(f"{base}/{layer}/vpu_id={vpu_id}").withColumn(
            "vpu_id", F.lit(vpu_id)
        )
        for layer in layers
    }


def read_results(spark: SparkSession, folder: str, csv_schema: T.StructType) -> DataFrame:
    """Parquet and CSV result files of one folder as one table; absent columns are NULL."""
    parquet = spark.read.option("pathGlobFilter", "*.parquet").parquet(folder)
    csv = spark.read.option("pathGlobFilter", "*.csv").csv(folder, header=True, schema=csv_schema)
    return parquet.unionByName(csv, allowMissingColumns=True)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A clustered feature table."""
    return spark.read.parquet(path)


def polygon_ids(records: DataFrame, column: str | None = None) -> DataFrame:
    """Ids of boundary records: the named attribute, by default the first, as text."""
    return records.select(F.col(column or records.columns[0]).cast("string").alias("poly_id"))
