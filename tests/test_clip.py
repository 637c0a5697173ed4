import random

import pytest
from pyspark.sql import functions as F

from basinflow import schemas
from basinflow.functions.gridindex import Grid
from basinflow.operators import clip as P
from support import plan_of, rows
from test_cells import blocks


def ring(poly, number, points, part=0):
    closed = [*points, points[0]]
    return [(poly, part, number, s, float(x), float(y)) for s, (x, y) in enumerate(closed)]


def inside(polygons, nrow, ncol):
    """Even-odd test of every cell centre against every polygon, one by one."""
    edges = {}
    for poly, part, number, seq, x, y in polygons:
        edges.setdefault((poly, part, number), []).append((seq, x, y))
    hits = set()
    for j in range(1, nrow + 1):
        for i in range(1, ncol + 1):
            count = {}
            for (poly, _, _), pts in edges.items():
                pts.sort()
                for (_, x1, y1), (_, x2, y2) in zip(pts, pts[1:]):
                    if (y1 <= j) != (y2 <= j) and i >= x1 + (j - y1) * (x2 - x1) / (y2 - y1):
                        count[poly] = count.get(poly, 0) + 1
            hits |= {(p, j, i) for p, n in count.items() if n % 2}
    return hits


def concave():
    outer = [(2, 2), (18.5, 1.3), (17, 16), (10, 7.5), (3.2, 17)]
    hole = [(6, 4), (12, 4), (12, 6.5), (6, 6.5)]
    return ring("c", 0, outer) + ring("c", 1, hole)


def noise(seed, n=6):
    r = random.Random(seed)
    out = []
    for k in range(n):
        out += ring(f"n{k}", 0, [(r.uniform(-3, 23), r.uniform(-3, 23)) for _ in range(r.randint(3, 9))])
    return out


@pytest.mark.parametrize("shapes", [concave(), noise(1), noise(2), concave() + noise(3)])
def test_runs_equal_brute_force(spark, shapes):
    df = spark.createDataFrame(shapes, schemas.POLYGONS)
    runs = P.polygon_runs(df, 20, 20)
    cells = runs.select("poly_id", "row", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)))
    expected = inside(shapes, 20, 20)
    assert set(rows(cells)) == expected
    merged = P.union_runs(runs).select("row", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)))
    got = rows(merged)
    assert len(got) == len(set(got))
    assert set(got) == {(j, i) for _, j, i in expected}


@pytest.mark.parametrize("limit", [10**8, -1])
@pytest.mark.parametrize("strip", [256, 4])
def test_clip_modes(spark, broadcasts, monkeypatch, limit, strip):
    broadcasts(limit)
    monkeypatch.setattr(P, "STRIP", strip)
    shapes = concave() + noise(5, 3)
    runs = P.union_runs(P.polygon_runs(spark.createDataFrame(shapes, schemas.POLYGONS), 20, 20))
    grid = blocks(spark, ny=3, nx=7, nrow=20, ncol=20, hours=2)
    want = {(j, i) for _, j, i in inside(shapes, 20, 20)}
    dropped = rows(P.clip(grid, runs, "drop"), "time", "j", "i", "value")
    assert len(dropped) == 2 * len(want)
    assert {(j, i) for _, j, i, _ in dropped} == want
    assert all(v == 100.0 * j + i for _, j, i, v in dropped)
    masked = rows(P.clip(grid, runs, "mask"), "time", "j", "i", F.coalesce("value", F.lit(-1.0)))
    js, iis = [j for j, _ in want], [i for _, i in want]
    box = [(j, i) for j in range(min(js), max(js) + 1) for i in range(min(iis), max(iis) + 1)]
    assert [(j, i, v) for t, j, i, v in masked if t == masked[0][0]] == [
        (j, i, 100.0 * j + i if (j, i) in want else -1.0) for j, i in box
    ]


def test_clip_per_polygon(spark):
    shapes = noise(7, 4)
    runs = P.polygon_runs(spark.createDataFrame(shapes, schemas.POLYGONS), 20, 20)
    got = P.clip(blocks(spark, nrow=20, ncol=20), runs, "drop", keys=["poly_id"])
    assert set(rows(got, "poly_id", "j", "i")) == inside(shapes, 20, 20)


def test_nothing_inside(spark):
    far = spark.createDataFrame(ring("f", 0, [(50, 50), (60, 50), (60, 60)]), schemas.POLYGONS)
    runs = P.union_runs(P.polygon_runs(far, 20, 20))
    assert P.clip(blocks(spark, nrow=20, ncol=20), runs).count() == 0


def test_index_space(spark):
    grid = Grid(xmin=0.0, ymax=30.0, res=10.0, ncol=2, nrow=3)
    df = spark.createDataFrame([("p", 0, 0, 0, 5.0, 25.0)], schemas.POLYGONS)
    assert rows(P.to_index_space(df, grid), "x", "y") == [(1.0, 1.0)]
    assert rows(P.to_index_space(df, grid, "sn"), "x", "y") == [(1.0, 3.0)]


def test_joins_are_equi_joins(spark, broadcasts):
    runs = P.union_runs(P.polygon_runs(spark.createDataFrame(concave(), schemas.POLYGONS), 20, 20))
    grid = blocks(spark, nrow=20, ncol=20)
    for limit in (10**8, -1):
        broadcasts(limit)
        for mode in ("mask", "drop"):
            plan = plan_of(P.clip(grid, runs, mode))
            assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_domain_by_ids(spark):
    shapes = spark.createDataFrame(concave() + noise(3), schemas.POLYGONS)
    ids = spark.createDataFrame([("c",), ("c",), ("absent",)], "poly_id string")
    grids = {"a": blocks(spark, nrow=20, ncol=20), "b": blocks(spark, nrow=20, ncol=20, var="w")}
    got = P.subset_domain_by_ids(grids, shapes, ids, 20, 20, mode="drop")
    want = {(j, i) for _, j, i in inside(concave(), 20, 20)}
    assert {k: set(rows(v, "j", "i")) for k, v in got.items()} == {"a": want, "b": want}
