"""The curve, its ranges and box reads."""

import random

import pytest
from pyspark.sql import functions as F
from support import plan_of, rows

from basinflow.session import scratch_path
from basinflow.sources import curve

EXTENT = (0.0, 0.0, float(1 << curve.ORDER), float(1 << curve.ORDER))


def keys(spark, points):
    df = spark.createDataFrame([(k, float(x) + 0.5, float(y) + 0.5) for k, (x, y) in enumerate(points)], "k int, x double, y double")
    return [r[0] for r in df.orderBy("k").select(curve.hilbert_key(F.col("x"), F.col("y"), EXTENT)).collect()]


def test_neighbours_on_the_curve_are_neighbours(spark):
    n = 32
    found = keys(spark, [(x, y) for x in range(n) for y in range(n)])
    assert sorted(found) == list(range(n * n))
    place = {key: divmod(k, n) for k, key in enumerate(found)}
    assert all(abs(place[k][0] - place[k + 1][0]) + abs(place[k][1] - place[k + 1][1]) == 1 for k in range(n * n - 1))


@pytest.mark.parametrize("most", [1, 4, 64])
def test_ranges_hold_every_cell_of_the_box(spark, most):
    rng = random.Random(5)
    top = 1 << curve.ORDER
    for size in (1, 20, 3000, top):
        x, y = rng.randrange(top - size + 1), rng.randrange(top - size + 1)
        box = (float(x), float(y), float(x + size) - 0.5, float(y + size) - 0.5)
        ranges = curve.key_ranges(box, EXTENT, most)
        assert 0 < len(ranges) <= most and all(a <= b for a, b in ranges)
        points = [(x, y), (x + size - 1, y + size - 1)] + [
            (rng.randrange(x, x + size), rng.randrange(y, y + size)) for _ in range(200)]
        assert all(any(a <= k <= b for a, b in ranges) for k in keys(spark, points))
    if most == 64:
        few = curve.key_ranges((100.0, 100.0, 163.5, 163.5), EXTENT)
        assert sum(b - a + 1 for a, b in few) < 4 * 66 * 66


def test_box_reads(spark):
    rng = random.Random(7)
    data = []
    for k in range(3000):
        x, y = rng.uniform(-5, 105), rng.uniform(0, 50)
        data.append((k, x, y, x + rng.uniform(0, 3), y + rng.uniform(0, 2)))
    data += [(3000, None, 1.0, 2.0, 3.0), (3001, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(data, "id long, xmin double, ymin double, xmax double, ymax double")
    out = scratch_path(spark, "curve")
    curve.write_along_curve(df, out, (0.0, 0.0, 100.0, 50.0), "id")
    for box in [(10, 10, 20, 20), (0, 0, 100, 50), (-5, 0, 0, 50), (50, 25, 50, 25), (99, 0, 120, 5), (1, 1, 1, 1), (300, 300, 301, 301)]:
        want = sorted(r[0] for r in data if r[1] is not None
                      and r[1] <= box[2] and r[3] >= box[0] and r[2] <= box[3] and r[4] >= box[1])
        for most in (1, 64):
            assert [r[0] for r in rows(curve.read_box(spark, out, box, most), "id")] == want
    plan = plan_of(curve.read_box(spark, out, (10, 10, 20, 20)))
    assert "GreaterThanOrEqual(key" in plan.split("PushedFilters:")[1]
    assert curve.read_box(spark, out, (5, 5, 4, 4)).count() == 0
    curve.write_along_curve(df.filter("false"), scratch := scratch_path(spark, "curve"), (0.0, 0.0, 1.0, 1.0), "id")
    assert curve.read_box(spark, scratch, (0, 0, 1, 1)).count() == 0


def test_rows_lie_along_the_curve(spark):
    df = spark.range(5000).selectExpr("id", "double(id * 37 % 1000) AS xmin", "double(id * 91 % 700) AS ymin").selectExpr(
        "*", "xmin AS xmax", "ymin AS ymax")
    out = scratch_path(spark, "curve")
    curve.write_along_curve(df, out, (0.0, 0.0, 1000.0, 700.0), "id")
    stored = spark.read.parquet(f"{out}/features").select("key", F.col("_metadata.file_path").alias("f"),
                                                          F.col("_metadata.row_index").alias("r")).collect()
    by_file = {}
    for row in sorted(stored, key=lambda r: (r.f, r.r)):
        by_file.setdefault(row.f, []).append(row.key)
    assert all(v == sorted(v) for v in by_file.values())
    spans = sorted((v[0], v[-1]) for v in by_file.values())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
