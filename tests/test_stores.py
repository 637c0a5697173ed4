"""Chunked stores: partitions planned, rows read, edges, gaps, odd input."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import rows

from basinflow import schemas
from basinflow.functions.gridindex import IndexBounds
from basinflow.operators.cells import explode_cells
from basinflow.session import scratch_path
from basinflow.sources import stores

T0 = datetime(2024, 1, 1)
SHAPE = (10, 13)


def blocks(spark, hours=range(7), names=("a", "b"), lost=()):
    """Blocks of 2 by 4 cells over a grid of 10 by 13, numbers that tell every cell apart."""
    out = []
    for var in names:
        for h in hours:
            for y0 in range(1, 11, 2):
                for x0 in range(1, 14, 4):
                    nx = min(4, 14 - x0)
                    data = [float(h * 1000 + (y0 + j) * 20 + x0 + i) * (1 if var == "a" else -1)
                            for j in range(2) for i in range(nx)]
                    if (h, y0, x0) in lost:
                        data[1] = None
                    out.append((var, T0 + timedelta(hours=h), y0, x0, 2, nx, data))
    return spark.createDataFrame(out, schemas.CHUNKS)


def stored(spark, df, chunk=(3, 4, 8), packed=False):
    path = scratch_path(spark, "store")
    stores.write_store(df, path, SHAPE, chunk, packed)
    return path


@pytest.mark.parametrize("packed", [False, True])
def test_round_trip(spark, packed):
    df = blocks(spark, lost={(2, 3, 5)})
    path = stored(spark, df, packed=packed)
    got = stores.read_store(spark, path, chunks_per_partition=1)
    assert got.schema == schemas.CHUNKS
    assert got.rdd.getNumPartitions() == 2 * 3 * 3 * 2  # variables, times, rows, columns of chunks
    want = explode_cells(df)
    assert rows(explode_cells(got), "var", "time", "j", "i", "value") == rows(want, "var", "time", "j", "i", "value")
    few = stores.read_store(spark, path, chunks_per_partition=10)
    assert few.rdd.getNumPartitions() == 4 and few.count() == got.count()
    assert stores.read_store(spark, path).rdd.getNumPartitions() == 1  # small chunks are read together


def test_one_frame_read_several_times(spark):
    """What one query leaves out must be there for the next."""
    got = stores.read_store(spark, stored(spark, blocks(spark)))
    all_rows = rows(got.drop("data"))
    assert len(all_rows) == 2 * 7 * 6
    early, low = got.filter("y0 > 4 AND var = 'a'"), got.filter("x0 = 1")
    assert early.count() == 7 * 4 and low.count() == 2 * 7 * 3
    assert early.unionByName(low).count() == 7 * 4 + 2 * 7 * 3
    assert rows(got.drop("data")) == all_rows


def test_named_variables(spark):
    path = stored(spark, blocks(spark))
    got = stores.read_store(spark, path, names=["b"], chunks_per_partition=1)
    assert got.rdd.getNumPartitions() == 18 and {r.var for r in got.select("var").collect()} == {"b"}
    with pytest.raises(Exception, match="no variable c"):
        stores.read_store(spark, path, names=["c"]).count()
    assert stores.read_store(spark, path, T0 + timedelta(hours=40)).count() == 0


@pytest.mark.parametrize("box", [(1, 13, 1, 10), (5, 9, 3, 6), (8, 8, 4, 4), (9, 13, 9, 10)])
def test_window(spark, box):
    imin, imax, jmin, jmax = box
    df = blocks(spark)
    path = stored(spark, df)
    got = stores.read_store(spark, path, T0 + timedelta(hours=1), T0 + timedelta(hours=5), IndexBounds(imin, imax, jmin, jmax), chunks_per_partition=1)
    chunks = {(y, x) for y in range(jmin - 1, jmax) for x in range(imin - 1, imax)}
    assert got.rdd.getNumPartitions() == 2 * 2 * len({(y // 4, x // 8) for y, x in chunks})
    inside = F.col("j").between(jmin, jmax) & F.col("i").between(imin, imax)
    want = explode_cells(df).filter(inside & F.hour("time").between(1, 5))
    cols = ("var", "time", "j", "i", "value")
    assert rows(explode_cells(got).filter(inside), *cols) == rows(want, *cols)


def test_gaps_and_empty(spark):
    df = blocks(spark, hours=(0, 9), names=("a",))
    got = stores.read_store(spark, stored(spark, df))
    cells = explode_cells(got)
    assert cells.filter("value IS NOT NULL").count() == df.selectExpr("sum(ny * nx)").first()[0]
    assert got.agg(F.countDistinct("time")).first()[0] == 10  # hours between are there, without values
    none = stored(spark, df.filter("false"))
    assert stores.read_store(spark, none).count() == 0


def test_refused(spark):
    odd = blocks(spark, hours=(0,), names=("a",))
    with pytest.raises(Exception, match="crosses"):
        stored(spark, odd, (1, 3, 8))
    with pytest.raises(Exception, match="whole hours"):
        stored(spark, odd.withColumn("time", F.expr("time + INTERVAL 1 MINUTE")))


def test_fill_value(spark):
    path = stored(spark, blocks(spark, hours=(0,), names=("a",)), (1, 4, 8))
    where = stores.qualified(spark, path)
    meta = stores.describe(where, "a")
    assert stores._chunk(where + "/a", meta, "9.9.9").shape == (1, 4, 8)
    assert stores._chunk(where + "/a", meta | {"fill_value": None}, "9.9.9") is None
    assert np.all(stores._chunk(where + "/a", meta | {"fill_value": 2}, "9.9.9") == 2)


def test_job_from_files(spark, tmp_path):
    """A store and a boundary in, cells, attributes and a description out; the description as a second read gives it."""
    import json

    from basinflow.functions.crs import lcc_inverse
    from basinflow.functions.gridindex import Grid
    from basinflow.operators.metadata import describe_cells
    from basinflow.plans import jobs
    from basinflow.sources.sinks import RunLayout

    grid = Grid(xmin=0.0, ymax=10_000.0, res=1000.0, ncol=13, nrow=10)
    corners = spark.createDataFrame([(k, *p) for k, p in enumerate(
        [(4000.0, 5000.0), (9000.0, 5000.0), (9000.0, 8000.0), (4000.0, 8000.0)])], "k int, x double, y double")
    lon, lat = lcc_inverse(F.col("x"), F.col("y"))
    ring = [[r[0], r[1]] for r in corners.orderBy("k").select(lon, lat).collect()]

    def boundary(name, points):
        shape = {"type": "Polygon", "coordinates": [points]}
        feature = {"type": "Feature", "id": "a", "properties": {}, "geometry": shape}
        (tmp_path / name).write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
        return str(tmp_path / name)

    store = stored(spark, blocks(spark, lost={(2, 7, 5)}))
    layout = RunLayout(str(tmp_path), "r")
    got = jobs.run_forcing_files(
        spark, store, boundary("b.json", [*ring, ring[0]]), grid, layout, T0 + timedelta(hours=1), T0 + timedelta(hours=4), "WKT")
    cells = spark.read.parquet(f"{layout.forcing}/cells")
    assert {(r.j, r.i) for r in cells.collect()} == {(j, i) for j in range(6, 9) for i in range(5, 10)}
    assert cells.filter("value IS NULL").count() == 2  # variables
    assert rows(got) == rows(describe_cells(cells, "r"))
    attrs = spark.read.parquet(f"{layout.forcing}/attrs")
    assert {("x", "axis"), ("spatial_ref", "crs_wkt")} <= {(r.variable, r.name) for r in attrs.collect()}
    documents = [json.loads(r.value) for r in spark.read.text(layout.metadata).collect()]
    assert sorted(d["variable"] for d in documents) == ["a", "b"] and {d["n"] for d in documents} == {4 * 15 - 1}
    far = [[x + 20, y] for x, y in ring]
    with pytest.raises(ValueError, match="no cell"):
        jobs.run_forcing_files(spark, store, boundary("f.json", [*far, far[0]]), grid, layout, T0, T0, "WKT")


def test_description_gathered_while_written(spark):
    from basinflow.operators.metadata import describe_cells, described_while_written

    cells = explode_cells(blocks(spark, lost={(2, 7, 5)}))
    out = scratch_path(spark, "d")
    got = described_while_written(cells, "d", ["a", "b", "never", "a"], lambda df: df.write.parquet(out))
    stored_cells = spark.read.parquet(out)
    assert rows(got) == rows(describe_cells(stored_cells, "d")) and stored_cells.count() == cells.count()
    assert dict(got.dtypes) == dict(describe_cells(cells, "d").dtypes)
    odd = cells.withColumn("var", F.when(F.col("var") == "a", "a"))
    with pytest.raises(ValueError, match="not named"):
        described_while_written(odd, "d", ["a"], lambda df: df.write.parquet(scratch_path(spark, "d")))
    none = described_while_written(cells.filter("false"), "d", ["a"], lambda df: df.write.parquet(scratch_path(spark, "d")))
    assert none.count() == 0
