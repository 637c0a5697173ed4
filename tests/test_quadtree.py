"""Quadtree covers against runs and brute force."""

import pytest
from pyspark.sql import functions as F
from support import plan_of, rows
from test_clip import concave, inside, noise, ring

from basinflow import schemas
from basinflow.operators import clip as P
from basinflow.operators import quadtree as Q


def cover(spark, shapes, size, top=Q.TOP):
    return Q.quadtree_cover(P.polygon_runs(spark.createDataFrame(shapes, schemas.POLYGONS), size, size), top)


@pytest.mark.parametrize("shapes,top", [(concave(), 12), (noise(1), 12), (concave() + noise(3), 2), (noise(4), 0)])
def test_cover_equals_brute_force(spark, shapes, top):
    found = cover(spark, shapes, 20, top)
    got = rows(Q.cover_cells(found), "poly_id", "j", "i")
    assert got == sorted(inside(shapes, 20, 20))  # each cell once
    cells = {tuple(r) for r in found.select("poly_id", "level", "qj", "qi").collect()}
    for poly, level, qj, qi in cells:  # no four cells could be one
        same = [(poly, level, 2 * (qj // 2) + a, 2 * (qi // 2) + b) for a in (0, 1) for b in (0, 1)]
        assert level == top or not set(same) <= cells


def test_rows_grow_with_the_outline(spark):
    counts = []
    for size in (64, 256, 1_024):
        square = ring("s", 0, [(2.5, 2.5), (size - 1.5, 2.5), (size - 1.5, size - 1.5), (2.5, size - 1.5)])
        found = cover(spark, square, size).cache()
        counts.append(found.count())
        assert found.agg(F.sum(F.pow(4.0, "level"))).first()[0] == (size - 4) ** 2
        found.unpersist()
    assert counts[2] < 6 * counts[1] < 36 * counts[0]  # the area grows 16 times each


def test_points_join_by_cell(spark, broadcasts):
    shapes = concave() + noise(5)
    found = cover(spark, shapes, 20)
    spots = spark.createDataFrame([(100 * j + i, j, i) for j in range(1, 21) for i in range(1, 21)], "id int, j int, i int")
    want = sorted((p, 100 * j + i) for p, j, i in inside(shapes, 20, 20))
    assert rows(Q.join_cover(spots, found), "poly_id", "id") == want
    broadcasts(-1)
    plan = plan_of(Q.join_cover(spots, found))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_covers(spark):
    none = spark.createDataFrame([], schemas.POLYGONS)
    found = Q.quadtree_cover(P.polygon_runs(none, 20, 20))
    assert found.columns == ["poly_id", "level", "qj", "qi"] and found.count() == 0
    spots = spark.createDataFrame([(1, 1)], "j int, i int")
    assert Q.join_cover(spots, found).columns == ["j", "i", "poly_id"]
    assert Q.cover_cells(found).count() == 0
