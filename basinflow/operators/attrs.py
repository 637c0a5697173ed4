"""Dataset and variable attributes as rows ``(dataset, variable, name, type, value)``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow import schemas
from basinflow.functions.gridindex import plain_number

KEY = ["dataset", "variable", "name"]

# Attributes of the coordinate variables of a projected forcing dataset.
COORDINATE_ATTRS = [
    ("x", "axis", "c", ["X"]),
    ("x", "standard_name", "c", ["projection_x_coordinate"]),
    ("x", "long_name", "c", ["x-coordinate in projected coordinate system"]),
    ("x", "resolution", "f", ["1000.0"]),
    ("y", "axis", "c", ["Y"]),
    ("y", "standard_name", "c", ["projection_y_coordinate"]),
    ("y", "long_name", "c", ["y-coordinate in projected coordinate system"]),
    ("y", "resolution", "f", ["1000.0"]),
    ("lon", "units", "c", ["degrees_east"]),
    ("lon", "standard_name", "c", ["longitude"]),
    ("lon", "long_name", "c", ["longitude"]),
    ("lat", "units", "c", ["degrees_north"]),
    ("lat", "standard_name", "c", ["latitude"]),
    ("lat", "long_name", "c", ["latitude"]),
]

# Grid size attributes dropped from a cut-out.
DELETED_GRID_ATTRS = [
    "WEST-EAST_PATCH_START_STAG",
    "SOUTH-NORTH_PATCH_START_STAG",
    "WEST-EAST_PATCH_END_STAG",
    "SOUTH-NORTH_PATCH_END_STAG",
]


def attr_rows(
    spark: SparkSession, rows: Iterable[tuple[str, str, str, str, Sequence[str]]]
) -> DataFrame:
    """A small attribute table from Python tuples."""
    return spark.createDataFrame([(*r[:4], list(r[4])) for r in rows], schemas.ATTRS)


def set_attrs(attrs: DataFrame, updates: DataFrame) -> DataFrame:
    """Add attributes, replacing those of the same dataset, variable and name."""
    return attrs.join(updates.select(*KEY), KEY, "left_anti").unionByName(updates)


def delete_attrs(attrs: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove attributes by dataset, variable and name."""
    return attrs.join(keys.select(*KEY), KEY, "left_anti")


def set_coordinate_attrs(attrs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Describe ``x, y, lon, lat`` of every dataset listed in ``datasets(dataset)``."""
    rows = F.array(*[
        F.struct(
            F.lit(var).alias("variable"), F.lit(name).alias("name"), F.lit(kind).alias("type"),
            F.array(*[F.lit(v) for v in value]).alias("value"),
        )
        for var, name, kind, value in COORDINATE_ATTRS
    ])
    return set_attrs(attrs, datasets.select("dataset", F.inline(rows)))


def set_crs(
    attrs: DataFrame, datasets: DataFrame, spatial_ref: str, x_dim: str = "x", y_dim: str = "y"
) -> DataFrame:
    """Record the coordinate system and the names of the spatial dimensions."""
    rows = F.array(*[
        F.struct(
            F.lit(var).alias("variable"), F.lit(name).alias("name"), F.lit("c").alias("type"),
            F.array(F.lit(value)).alias("value"),
        )
        for var, name, value in [
            ("spatial_ref", "spatial_ref", spatial_ref),
            ("spatial_ref", "crs_wkt", spatial_ref),
            ("", "x_dim", x_dim),
            ("", "y_dim", y_dim),
        ]
    ])
    return set_attrs(attrs, datasets.select("dataset", F.inline(rows)))


def grid_attrs(attrs: DataFrame, bounds: DataFrame, corners: DataFrame) -> DataFrame:
    """Rewrite the size attributes of cut-out grids.

    ``bounds(dataset, w, e, s, n)`` are inclusive; ``corners`` come from ``grid_corners``. Six sizes
    and both corner lists are set, four patch attributes are deleted.
    """
    deleted = bounds.select(
        "dataset", F.lit("").alias("variable"),
        F.explode(F.array(*[F.lit(n) for n in DELETED_GRID_ATTRS])).alias("name"),
    )
    cols = F.col("e") - F.col("w") + 1
    rows = F.col("n") - F.col("s") + 1
    # Size attributes by name; staggered sizes are one more than the cell count.
    sizes = [
        ("WEST-EAST_GRID_DIMENSION", cols + 1),
        ("SOUTH-NORTH_GRID_DIMENSION", rows + 1),
        ("WEST-EAST_PATCH_END_UNSTAG", cols),
        ("SOUTH-NORTH_PATCH_END_UNSTAG", rows),
        ("i_parent_end", cols + 1),
        ("j_parent_end", rows + 1),
    ]
    size_rows = F.array(*[
        F.struct(
            F.lit("").alias("variable"), F.lit(name).alias("name"), F.lit("l").alias("type"),
            F.array(value.cast("string")).alias("value"),
        )
        for name, value in sizes
    ])
    corner_rows = F.array(*[
        F.struct(
            F.lit("").alias("variable"), F.lit(name).alias("name"), F.lit("f").alias("type"),
            F.transform(name, lambda v: plain_number(v.cast("double"))).alias("value"),
        )
        for name in ("corner_lons", "corner_lats")
    ])
    updates = bounds.select("dataset", F.inline(size_rows)).unionByName(
        corners.select("dataset", F.inline(corner_rows))
    )
    return set_attrs(delete_attrs(attrs, deleted), updates)
