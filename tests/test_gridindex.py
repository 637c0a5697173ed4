import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basinflow.functions import crs
from basinflow.functions.gridindex import (
    Grid, IndexBounds, as_bounds, bbox_bounds, buffered_envelope, cell_centre, cell_of,
    corner_lonlat, flip_row, geotransform,
)
from basinflow.sources.sinks import bounds_lines, write_bounds
from support import plan_of, rows

NATIONAL = Grid(xmin=-2304000.0, ymax=1920000.0, res=1000.0, ncol=4608, nrow=3840)
SOUTH, NORTH = 382582.18746, 367584.87840
WEST, EAST = 1720355.72762, 1734488.45260

# The published index bounds of this box.
GOLDEN = """"grid"\t"imin"\t"imax"\t"jmin"\t"jmax"\t"index_start"
"hyd_sn"\t16097\t16156\t9149\t9212\t1
"hyd_ns"\t16097\t16156\t6149\t6212\t1
"geo_sn"\t4025\t4039\t2288\t2303\t1
"geo_ns"\t4025\t4039\t1538\t1553\t1"""


@pytest.fixture
def corners(spark):
    points = [(WEST, SOUTH), (WEST, NORTH), (EAST, NORTH), (EAST, SOUTH)]
    return spark.createDataFrame(points, "x double, y double")


def test_golden_bounds(spark, corners, tmp_path):
    table = bbox_bounds(corners, NATIONAL)
    text = [r.line for r in bounds_lines(table).orderBy("ord").collect()]
    assert "\n".join(text) == GOLDEN
    write_bounds(table, str(tmp_path / "params"))
    stored = [p.read_text() for p in (tmp_path / "params").glob("part-*")]
    assert "".join(stored).strip() == GOLDEN


def test_golden_hyperslab(corners):
    geo = as_bounds(bbox_bounds(corners, NATIONAL))["geo_sn"]
    assert (geo.imin - 1, geo.imax - 1, geo.jmin - 1, geo.jmax - 1) == (4024, 4038, 2287, 2302)
    assert geo.staggered(x=True) == IndexBounds(4025, 4040, 2288, 2303)
    assert (geo.width, geo.height) == (15, 16)


def test_corner_order_does_not_matter(spark):
    points = [(EAST, NORTH), (WEST, SOUTH), (EAST, SOUTH), (WEST, NORTH)]
    shuffled = spark.createDataFrame(points, "x double, y double")
    assert as_bounds(bbox_bounds(shuffled, NATIONAL))["hyd_ns"] == IndexBounds(16097, 16156, 6149, 6212)


def test_cell_edges(spark):
    grid = Grid(xmin=0.0, ymax=30.0, res=10.0, ncol=2, nrow=3)
    pts = [(0.0, 30.0), (10.0, 20.0), (20.0, 0.0), (19.9, 0.1)]
    row, col = cell_of(F.col("x"), F.col("y"), grid)
    got = spark.createDataFrame(pts, "x double, y double").select(row.alias("r"), col.alias("c"))
    assert [tuple(r) for r in got.collect()] == [(1, 1), (2, 2), (3, 2), (3, 2)]


def test_point_outside_raises(spark):
    grid = Grid(xmin=0.0, ymax=30.0, res=10.0, ncol=2, nrow=3)
    bad = spark.createDataFrame([(25.0, 5.0)], "x double, y double")
    with pytest.raises(Exception, match="outside"):
        bbox_bounds(bad, grid).collect()
    row, _ = cell_of(F.col("x"), F.col("y"), grid, outside="null")
    assert bad.select(row.alias("r")).first().r is None


def test_buffer_outside_raises(spark):
    grid = Grid(xmin=0.0, ymax=30.0, res=10.0, ncol=2, nrow=3)
    box = spark.createDataFrame([(5.0, 5.0)], "x double, y double")
    with pytest.raises(Exception, match="outside"):
        buffered_envelope(box, grid).collect()


def test_centre_and_flip(spark):
    x, y = cell_centre(F.lit(2), F.lit(1), Grid(0.0, 30.0, 10.0, 2, 3))
    got = spark.range(1).select(x.alias("x"), y.alias("y"), flip_row(F.lit(1), 3).alias("f")).first()
    assert (got.x, got.y, got.f) == (5.0, 15.0, 3)


def test_envelope_holds_corners(corners):
    env = buffered_envelope(corners, NATIONAL, cell_buffer=2).first()
    plain = corner_lonlat(corners, NATIONAL).collect()
    assert [r.id for r in plain] == [1, 2, 3, 4]
    for p in plain:
        assert env.lon_min < p.lon < env.lon_max
        assert env.lat_min < p.lat < env.lat_max
    wide = buffered_envelope(corners, NATIONAL, cell_buffer=4).first()
    assert wide.lon_min < env.lon_min and wide.lat_max > env.lat_max


def test_grid_from_cells(spark):
    cells = spark.createDataFrame(
        [(5.0, 25.0), (15.0, 5.0)], "x double, y double"
    )
    assert Grid.from_cells(cells, 10.0) == Grid(0.0, 30.0, 10.0, 2, 3)


def test_geotransform_adds_half_step_to_y(spark):
    cells = spark.createDataFrame(
        [(1, 1, 500.0, 1500.0), (2, 2, 1500.0, 2500.0)], "j int, i int, x double, y double"
    )
    assert geotransform(cells, 1000.0, 1000.0).first()[0] == "0 1000 0 2000 0 1000"
    assert geotransform(cells, 1000.0, 1000.0, dxy=4).first()[0] == "375 250 0 1625 0 250"


def test_projection_constants():
    assert crs.NWM_LCC.cone == pytest.approx(0.715566847, abs=1e-9)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(-170, 60), st.floats(-60, 85)), min_size=1, max_size=30))
def test_projection_round_trip(spark, points):
    df = spark.createDataFrame(points, "lon double, lat double")
    x, y = crs.lcc_forward(F.col("lon"), F.col("lat"))
    lon, lat = crs.lcc_inverse(F.col("x"), F.col("y"))
    back = df.select("lon", "lat", x.alias("x"), y.alias("y")).select(
        "lon", "lat", lon.alias("lon2"), lat.alias("lat2")
    )
    for r in back.collect():
        assert math.isclose(r.lon, r.lon2, abs_tol=1e-9)
        assert math.isclose(r.lat, r.lat2, abs_tol=1e-9)


def test_projection_centre(spark):
    x, y = crs.lcc_forward(F.lit(-97.0), F.lit(40.0000076293945))
    got = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(got.x) < 1e-6 and abs(got.y) < 1e-6


def test_meshgrid(spark):
    xs = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 35.0)], "i int, x double")
    ys = spark.createDataFrame([(1, 1.0), (2, 2.0)], "j int, y double")
    mesh = crs.meshgrid(xs, ys)
    assert rows(mesh, "j", "i", "x", "y") == [
        (j, i, x, float(j)) for j in (1, 2) for i, x in ((1, 10.0), (2, 20.0), (3, 35.0))
    ]
    plan = plan_of(mesh)
    assert "Cartesian" not in plan and "NestedLoop" not in plan
