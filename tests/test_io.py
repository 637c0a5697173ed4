import json
import struct
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinflow import schemas
from basinflow.functions.gridindex import Grid, IndexBounds
from basinflow.operators.cells import explode_cells
from basinflow.operators.timebins import time_bins
from basinflow.plans import jobs
from basinflow.session import cut, scratch_path, shared_dir
from basinflow.sources import geojson, manifest, netcdf, sinks, tables
from basinflow.sources.manifest import list_forcing, year_manifest
from basinflow.streaming.clip import stream_chunks, stream_clip
from support import plan_of, rows
from test_cells import T0, blocks
from test_clip import concave, inside


# -- classic NetCDF headers --------------------------------------------------------------------------

def classic(version, records=3, streaming=False, lone=False):
    """A small classic NetCDF file: a fixed 2 by 3 grid and one or two record variables."""
    count = ">q" if version == 5 else ">i"
    offset = ">i" if version == 1 else ">q"

    def n(v):
        return struct.pack(count, v)

    def name(s):
        b = s.encode()
        return n(len(b)) + b + b"\0" * (-len(b) % 4)

    def tag(t, items):
        return struct.pack(">i", t) + n(len(items)) + b"".join(items)

    def text(k, v):
        b = v.encode()
        return name(k) + struct.pack(">i", 2) + n(len(b)) + b + b"\0" * (-len(b) % 4)

    dims = tag(10, [name("time") + n(0), name("y") + n(2), name("x") + n(3)])
    attrs = tag(12, [text("title", "grid"), name("level") + struct.pack(">i", 4) + n(1) + struct.pack(">i", 7)])
    fill = tag(12, [name("_FillValue") + struct.pack(">i", 5) + n(1) + struct.pack(">f", -9.0)])
    none = struct.pack(">i", 0) + n(0)

    def var(label, ids, own, kind, size, begin):
        return name(label) + n(len(ids)) + b"".join(n(d) for d in ids) + own + struct.pack(">i", kind) + n(size) + struct.pack(offset, begin)

    def header(begins):
        vs = [var("hgt", [1, 2], fill, 5, 24, begins[0]), var("t", [0, 1], none, 3, 4, begins[1])]
        if not lone:
            vs.append(var("flag", [0], none, 1, 4, begins[2]))
        recs = {1: 0xFFFFFFFF, 2: 0xFFFFFFFF, 5: 0xFFFFFFFFFFFFFFFF}[version] if streaming else records
        numrecs = struct.pack(">Q" if version == 5 else ">I", recs)
        return b"CDF" + bytes([version]) + numrecs + dims + attrs + tag(11, vs)

    size = len(header([0, 0, 0]))
    begins = [size, size + 24, size + 28]
    body = struct.pack(">6f", *range(6))
    for r in range(records):
        body += struct.pack(">2h", r, r + 10)
        if not lone:
            body += struct.pack(">b", r) + b"\0\0\0"
    return header(begins) + body


@pytest.mark.parametrize("version", [1, 2, 5])
@pytest.mark.parametrize("streaming", [False, True])
def test_scan_headers(spark, tmp_path, version, streaming):
    (tmp_path / "in").mkdir()
    data = classic(version, streaming=streaming)
    (tmp_path / "in" / "a.b.nc").write_bytes(data)
    refs = netcdf.scan_headers(spark, str(tmp_path / "in"))
    got = {r.key: r for r in refs.collect()}
    assert json.loads(got[".zattrs"].inline) == {"title": "grid", "level": 7}
    assert json.loads(got["hgt/.zarray"].inline) == {
        "chunks": [2, 3], "compressor": None, "dtype": ">f4", "fill_value": -9.0, "filters": None,
        "order": "C", "shape": [2, 3], "zarr_format": 2,
    }
    assert json.loads(got["t/.zarray"].inline)["shape"] == [3, 2]
    assert json.loads(got["t/.zattrs"].inline) == {"_ARRAY_DIMENSIONS": ["time", "y"]}
    grid = got["hgt/0.0"]
    assert struct.unpack(">6f", data[grid.offset:grid.offset + grid.length]) == tuple(range(6))
    for r in range(3):
        ref = got[f"t/{r}.0"]
        assert struct.unpack(">2h", data[ref.offset:ref.offset + ref.length]) == (r, r + 10)
        flag = got[f"flag/{r}"]
        assert data[flag.offset:flag.offset + flag.length] == bytes([r])


def test_lone_record_variable_is_unpadded(spark, tmp_path):
    (tmp_path / "x.nc").write_bytes(classic(1, lone=True))
    got = {r.key: r for r in netcdf.scan_headers(spark, str(tmp_path), "*.nc").collect()}
    assert got["t/1.0"].offset - got["t/0.0"].offset == 4


def test_write_refs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for f in ("2010010100.grid.nc", "2010010101.grid.nc"):
        (tmp_path / "in" / f).write_bytes(classic(2))
    refs = netcdf.scan_headers(spark, str(tmp_path / "in"))
    netcdf.write_refs(refs, str(tmp_path / "out"))
    for stem in ("2010010100.grid", "2010010101.grid"):
        files = list((tmp_path / "out" / f"name={stem}.json").glob("part-*"))
        assert len(files) == 1
        doc = json.loads(files[0].read_text())
        assert doc["version"] == 1
        assert json.loads(doc["refs"][".zgroup"]) == {"zarr_format": 2}
        path, at, length = doc["refs"]["hgt/0.0"]
        assert path.endswith(f"{stem}.nc") and isinstance(at, int) and length == 24
        assert len(doc["refs"]) == refs.filter(F.col("path") == path).count()


def test_refs_with_one_stem_are_refused(spark, tmp_path):
    for f in ("a.nc", "a.cdf"):
        (tmp_path / f).write_bytes(classic(1))
    with pytest.raises(ValueError, match="a"):
        netcdf.write_refs(netcdf.scan_headers(spark, str(tmp_path)), str(tmp_path / "out"))


def test_written_blocks_are_found(spark, tmp_path):
    out = str(tmp_path / "b")
    netcdf.write_blocks(blocks(spark), out)
    refs = netcdf.scan_headers(spark, out).filter("key = 'v/0.0' AND path LIKE '%.v.4.5.nc'").collect()
    assert len(refs) == 1
    data = (tmp_path / "b" / "2024010100.v.4.5.nc").read_bytes()
    at, n = refs[0].offset, refs[0].length
    assert struct.unpack(">12f", data[at:at + n]) == tuple(
        100.0 * j + i for j in (4, 5, 6) for i in (5, 6, 7, 8)
    )


def test_not_a_netcdf_file(spark, tmp_path):
    (tmp_path / "x.nc").write_bytes(b"\x89HDF\r\n\x1a\n" + b"\0" * 64)
    with pytest.raises(Exception, match="not a classic NetCDF"):
        netcdf.scan_headers(spark, str(tmp_path)).collect()


# -- listings, polygons, tables ------------------------------------------------------------------------

def test_listing(spark):
    files = [
        ("b/f/2009/2009123123.x.json", 2009), ("b/f/2010/2010010100.x.json", 2010),
        ("b/f/2010/2010010105.x.json", 2010), ("b/f/2010/readme.txt", 2010), ("b/f/2011/2011010100.x", 2011),
    ]
    got = manifest.list_forcing(
        spark.createDataFrame(files, "path string, year int"), datetime(2009, 12, 31, 23), datetime(2010, 1, 1, 4)
    )
    assert rows(got, "url") == [
        ("https://b.s3.amazonaws.com/f/2009/2009123123.x.json",),
        ("https://b.s3.amazonaws.com/f/2010/2010010100.x.json",),
    ]


def test_year_is_a_partition_filter(spark, tmp_path):
    df = spark.createDataFrame([("b/2010/2010010100.x", 2010), ("b/2011/2011010100.x", 2011)], "path string, year int")
    df.write.partitionBy("year").parquet(str(tmp_path / "m"))
    listed = manifest.list_forcing(spark.read.parquet(str(tmp_path / "m")), datetime(2010, 1, 1), datetime(2010, 2, 1))
    plan = plan_of(listed)
    assert "PartitionFilters: [isnotnull(year" in plan
    assert listed.count() == 1


def test_folder(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"123")
    got = manifest.list_folder(spark, str(tmp_path))
    assert rows(got, "length") == [(3,)]


FEATURES = [
    {"type": "Feature", "properties": {"ID": 7, "name": "a"},
     "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]]}},
    {"type": "Feature", "properties": {"ID": 8, "name": "b"},
     "geometry": {"type": "MultiPolygon", "coordinates": [[[[5.5, 5], [6, 5], [6, 6], [5.5, 5]]], [[[7, 7], [8, 7], [8, 8], [7, 7]]]]}},
]


@pytest.mark.parametrize("lines", [False, True])
def test_geojson(spark, tmp_path, lines):
    path = tmp_path / "f.geojson"
    if lines:
        path.write_text("\n".join(json.dumps(f) for f in FEATURES))
    else:
        path.write_text(json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=1))
    got = geojson.read_polygons(spark, str(path), "ID", lines)
    assert got.columns == schemas.POLYGONS.names
    assert got.count() == 16
    assert rows(got.filter("poly_id = '8' AND part = 1 AND seq = 2"), "ring", "x", "y") == [(0, 8.0, 8.0)]
    records = geojson.read_records(spark, str(path), ["ID", "name"], lines)
    assert rows(tables.polygon_ids(records)) == [("7",), ("8",)]
    assert rows(tables.polygon_ids(records, "name")) == [("a",), ("b",)]


def test_table_readers(spark, tmp_path):
    w = spark.createDataFrame([(1, 2, 3, 0.5, 0.25)], schemas.WEIGHTS)
    p = spark.createDataFrame([(3, 9)], schemas.POLYS)
    sinks.write_weights(w.withColumn("extra", F.lit(1)), p, str(tmp_path / "w"))
    back_w, back_p = tables.read_weights(spark, str(tmp_path / "w"))
    assert (rows(back_w), rows(back_p)) == ([(1, 2, 3, 0.5, 0.25)], [(3, 9)])
    links = spark.createDataFrame([(1, "  07 ", 3, 0)], "link long, gages string, order int, time int")
    links.write.parquet(str(tmp_path / "l"))
    got = tables.read_links(spark, str(tmp_path / "l"))
    assert got.columns == ["link", "gages", "order", "site_no"] and got.first().site_no == "07"
    some = tables.read_links(spark, str(tmp_path / "l"), ["gages", "link", "order"])
    assert some.columns == ["gages", "link", "order"]
    assert tables.read_params(spark, str(tmp_path / "l")).columns == ["link", "gages", "order", "time"]


def test_grid_template(spark, tmp_path):
    spark.createDataFrame([("g", 1, 1, 0.0, 0.0, 1.0, 2.0)], schemas.GRID_CELLS).write.parquet(str(tmp_path / "cells"))
    spark.createDataFrame([("g", "crs", "spatial_ref", "c", ["WKT"])], schemas.ATTRS).write.parquet(str(tmp_path / "attrs"))
    cells, attrs = tables.read_grid(spark, str(tmp_path))
    assert cells.count() == 1 and tables.spatial_ref(attrs, "g") == "WKT"
    with pytest.raises(ValueError):
        tables.spatial_ref(attrs, "other")


def test_hydrofabric_reader(spark, tmp_path):
    df = spark.createDataFrame([("wb-1", "01"), ("wb-2", "02")], "id string, vpu_id string")
    df.write.partitionBy("vpu_id").parquet(str(tmp_path / "flowpaths"))
    got = tables.read_hydrofabric(spark, str(tmp_path), "02", ["flowpaths"])["flowpaths"]
    assert rows(got, "id", "vpu_id") == [("wb-2", "02")]


def test_mixed_results(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "id int, q double").coalesce(1).write.parquet(str(tmp_path / "p"))
    part = next((tmp_path / "p").glob("*.parquet"))
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.parquet").write_bytes(part.read_bytes())
    (tmp_path / "r" / "b.csv").write_text("id\n5\n")
    got = tables.read_results(spark, str(tmp_path / "r"), T.StructType.fromDDL("id int"))
    assert got.columns == ["id", "q"] and rows(got, "id") == [(1,), (5,)]


def test_open_listed(spark, tmp_path):
    blocks(spark, hours=4).write.parquet(str(tmp_path / "c"))
    hours = spark.createDataFrame([(T0,), (T0 + timedelta(hours=2),)], "valid_time timestamp_ntz")
    got = tables.open_listed(spark, hours, str(tmp_path / "c"))
    assert rows(got.select("time").distinct()) == [(T0,), (T0 + timedelta(hours=2),)]
    assert tables.open_listed(spark, hours.filter("false"), str(tmp_path / "c")).count() == 0
    assert tables.read_chunks(spark, [str(tmp_path / "c"), str(tmp_path / "c")]).count() == 2 * 4 * 9


# -- sinks -----------------------------------------------------------------------------------------

def test_write_hourly(spark, tmp_path):
    sinks.write_hourly(explode_cells(blocks(spark, hours=3)), str(tmp_path / "h"))
    names = sorted(p.name for p in (tmp_path / "h").glob("part=*"))
    assert names == [f"part=20240101{h:02d}00.LDASIN_DOMAIN1" for h in range(3)]


def test_write_parts(spark, tmp_path):
    span = spark.createDataFrame([(T0, T0 + timedelta(hours=4))], "start timestamp_ntz, end timestamp_ntz")
    sinks.write_parts(time_bins(span, 3), str(tmp_path / "p"))
    files = sorted((tmp_path / "p").glob("part=*/part-*"))
    assert [json.loads(f.read_text()) for f in files] == [
        {"end": "2024-01-01T02:00:00", "start": "2024-01-01T00:00:00"},
        {"end": "2024-01-01T04:00:00", "start": "2024-01-01T03:00:00"},
    ]


def test_conformed_write(spark, tmp_path):
    template = spark.createDataFrame([(1, 1.5, "x")], "a long, b float, c string")
    df = spark.createDataFrame([(7, 2, 3.25)], "z int, a int, b double")
    sinks.write_conformed(df, template, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.dtypes == [("a", "bigint"), ("b", "float")] and rows(back) == [(2, 3.25)]


def test_layout_and_publish(spark, tmp_path):
    run = sinks.RunLayout.new(str(tmp_path))
    assert run.domain == f"{tmp_path}/{run.run_id}/domain" and len(run.run_id) == 32
    df = spark.createDataFrame([(1,)], "a int")
    sinks.publish(df, run.results)
    sinks.publish(df, run.results)
    assert spark.read.parquet(run.results).count() == 2


def test_pyramid_and_features(spark, tmp_path):
    sinks.write_pyramid(explode_cells(blocks(spark)), str(tmp_path / "py"), 2, tile=3)
    assert len(list((tmp_path / "py").glob("level=*"))) == 3
    assert sinks.read_pyramid(spark, str(tmp_path / "py")).filter("level = 2").count() == 6
    boxes = spark.range(50).select(
        "id", *[F.col("id").cast("double").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]
    )
    sinks.write_clustered(boxes, str(tmp_path / "f"), (0.0, 0.0, 50.0, 50.0), "id")
    assert tables.read_features(spark, str(tmp_path / "f")).count() == 50


# -- streaming and jobs ------------------------------------------------------------------------------

def test_stream_counts_each_file_once(spark, tmp_path):
    src, out, log = (str(tmp_path / d) for d in ("src", "out", "log"))
    box = IndexBounds(2, 5, 2, 4)

    def arrive(hour):
        one = blocks(spark, hours=hour + 1).filter(F.col("time") == T0 + timedelta(hours=hour))
        one.write.mode("append").parquet(src)

    def run():
        stream = stream_chunks(spark, src, files_per_trigger=1)
        stream_clip(stream, box, out, log, available_now=True, reorigin=True).awaitTermination()

    arrive(0)
    run()
    arrive(1)
    run()
    run()  # a restart with nothing new
    got = explode_cells(spark.read.parquet(out))
    assert rows(got, "time", "j", "i", "value") == [
        (T0 + timedelta(hours=h), j - 1, i - 1, 100.0 * j + i)
        for h in (0, 1) for j in (2, 3, 4) for i in (2, 3, 4, 5)
    ]


def test_hourly_job(spark, tmp_path):
    grid = blocks(spark, nrow=20, ncol=20, hours=5)
    paths = [(f"b/f/2024/2024010{1}{h:02d}.x", 2024) for h in range(5)]
    xs = spark.range(1, 21).select(F.col("id").cast("int").alias("i"), (F.col("id") * 1000.0).alias("x"))
    ys = xs.select(F.col("i").alias("j"), F.col("x").alias("y"))
    parts = dict(
        manifest=spark.createDataFrame(paths, "path string, year int"), chunks=grid,
        axes=(xs, ys), polygons=spark.createDataFrame(concave(), schemas.POLYGONS),
        grid=jobs.ForcingGrid(20, 20, (3, 4)),
    )
    status = jobs.run_forcing_hourly(
        spark, str(tmp_path / "ok"), T0, T0 + timedelta(hours=4), 2, **parts
    )
    assert rows(status, "bin", "expected", "ok") == [(0, 2, True), (1, 2, True), (2, 1, True)]
    parts["manifest"] = parts["manifest"].filter("path NOT LIKE '%03.x'")
    with pytest.raises(RuntimeError, match=r"\[1\]"):
        jobs.run_forcing_hourly(spark, str(tmp_path / "bad"), T0, T0 + timedelta(hours=4), 2, **parts)


def test_dataset_job(spark, tmp_path):
    jobs.run_forcing_dataset(
        str(tmp_path / "d"), chunks=blocks(spark, nrow=20, ncol=20, hours=30),
        polygons=spark.createDataFrame(concave(), schemas.POLYGONS),
        grid=jobs.ForcingGrid(20, 20), start="2024-01-02", end="2024-01-02",
    )
    back = spark.read.parquet(str(tmp_path / "d"))
    assert back.select("time").distinct().count() == 6
    assert back.filter("value IS NOT NULL").count() == 6 * len(inside(concave(), 20, 20))


def test_static_job(spark, tmp_path):
    grid = Grid(xmin=-10_000.0, ymax=10_000.0, res=1000.0, ncol=20, nrow=20)
    # land columns 9..11, rows (north) 9..12, south 9..12; routing 33..44 by 33..48
    corners = spark.createDataFrame([(-1500.0, -1500.0), (500.0, 1500.0)], "x double, y double")
    inputs = jobs.StaticInputs(
        weights=spark.createDataFrame([(33, 33, 1, 1.0, 0.0), (44, 48, 2, 0.5, 0.0), (45, 48, 2, 0.5, 0.0)], schemas.WEIGHTS),
        polys=spark.createDataFrame([(1, 0), (2, 0)], schemas.POLYS),
        links=spark.createDataFrame([(1, 2, 10.0, 10.0, "", 3, 0), (2, 0, 0.0, 0.0, "07", 4, 0), (9, 2, -97.0, 40.0, "", 1, 0)],
                                    "link long, to long, lon double, lat double, gages string, ascendingIndex int, NHDWaterbodyComID long"),
        buckets=spark.createDataFrame([(2, 0, 1), (1, 0, 2)], schemas.BUCKETS),
        land_grids={"soil": blocks(spark, nrow=20, ncol=20)},
    )
    run = sinks.RunLayout.new(str(tmp_path))
    bounds = jobs.run_static_subset(inputs, corners, grid, run)
    assert bounds["geo_sn"] == IndexBounds(9, 11, 9, 12)
    assert bounds["hyd_sn"] == IndexBounds(33, 44, 33, 48)

    def read(name):
        return spark.read.parquet(f"{run.domain}/{name}")

    assert rows(read("spatialweights/data"), "i_index", "j_index", "IDmask", "weight") == [(1, 1, 1, 1.0)]
    assert rows(read("links"), "link", "to", "ascendingIndex") == [(1, 0, 1.0), (9, 0, 0.0)]
    assert rows(read("buckets"), "ComID", "Basin") == [(1, 1)]
    soil = rows(explode_cells(read("soil")), "j", "i", "value")
    assert soil[0] == (1, 1, 909.0) and soil[-1] == (4, 3, 1211.0) and len(soil) == 12
    for wrong in (
        dict(buckets=inputs.buckets), dict(attrs=inputs.links), dict(axes={"q": None}), dict(row_orders={"q": "sn"}),
        dict(weights=inputs.weights, polys=inputs.polys, links=inputs.links, lakes=inputs.links),
    ):
        with pytest.raises(ValueError):
            jobs.StaticInputs(**wrong).check()
    with pytest.raises(ValueError):
        jobs.StaticInputs(weights=inputs.weights).check()


def test_domain_with_metadata(spark, tmp_path):
    shapes = spark.createDataFrame(concave(), schemas.POLYGONS)
    ids = spark.createDataFrame([("c",)], "poly_id string")
    domain = jobs.domain_by_ids(
        {"a": blocks(spark, nrow=20, ncol=20)}, shapes, ids, jobs.ForcingGrid(20, 20), "w"
    )
    run = sinks.RunLayout.new(str(tmp_path))
    jobs.run_domain_with_metadata(domain, run)
    docs = spark.read.text(run.metadata).collect()
    assert json.loads(docs[0].value)["n"] == len(inside(concave(), 20, 20))


def test_shared_folder(spark):
    assert scratch_path(spark, "a").startswith(shared_dir(spark))
    df = cut(spark.range(10).withColumn("b", F.col("id") * 2))
    assert "Range" not in plan_of(df)
    assert df.count() == 10


def test_static_attrs(spark):
    xs = spark.range(1, 81).select(F.col("id").cast("int").alias("i"), (F.col("id") * 250.0).alias("x"))
    ys = spark.range(1, 81).select(F.col("id").cast("int").alias("j"), (F.col("id") * 250.0).alias("y"))
    land_xs = xs.filter("i <= 20").withColumn("x", F.col("i") * 1000.0)
    land_ys = ys.filter("j <= 20").withColumn("y", F.col("j") * 1000.0)
    grids = {"geogrid": blocks(spark, nrow=20, ncol=20, var="XLAT_M"), "soil": blocks(spark, nrow=20, ncol=20),
             "template": blocks(spark, nrow=20, ncol=20)}
    inputs = jobs.StaticInputs(
        land_grids=grids, routing_grids={"routing": blocks(spark, nrow=80, ncol=80)},
        attrs=spark.createDataFrame([("soil", "", "i_parent_end", "l", ["9"])], schemas.ATTRS),
        axes={"soil": (land_xs, land_ys, 1000.0, 1000.0), "routing": (xs, ys, 250.0, -250.0),
              "template": (land_xs, land_ys, 1000.0, 500.0)},
        row_orders={"template": "ns"},
    )
    bounds = {
        "geo_sn": IndexBounds(2, 4, 3, 6), "geo_ns": IndexBounds(2, 4, 15, 18),
        "hyd_sn": IndexBounds(5, 16, 9, 24), "hyd_ns": IndexBounds(5, 16, 57, 72),
    }
    out = jobs.static_subset(inputs, bounds, spark.createDataFrame([(1,)], "unused int"))
    got = {(r.dataset, r.name): r.value for r in out["attrs"].collect()}
    assert got["soil", "i_parent_end"] == got["geogrid", "i_parent_end"] == ["4"]
    assert got["soil", "j_parent_end"] == ["5"]
    assert got["soil", "corner_lats"] == ["302", "602", "604", "304"] + ["0"] * 12
    assert got["soil", "GeoTransform"] == ["1500 1000 0 3500 0 1000"]
    assert got["template", "GeoTransform"] == ["1500 1000 0 15250 0 500"]
    assert got["routing", "GeoTransform"] == ["1125 250 0 14125 0 -250"]
    assert len(got) == 3 * 8 + 3
    for name, row in (("soil", 3), ("template", 15)):
        assert rows(explode_cells(out[name]), "j", "i", "value")[0] == (1, 1, row * 100.0 + 2)


def test_chain(spark, tmp_path):
    flow = [(f"wb-{k}", f"nex-{k // 2}", "7") for k in range(1, 8)]
    flow += [(f"nex-{k}", f"wb-{k}", "7") for k in range(1, 4)] + [("wb-2", "nex-1", "8")]
    edges = spark.createDataFrame(flow, "id string, toid string, vpu_id string")
    cats = spark.createDataFrame([(f"cat-{k}", "7") for k in range(1, 8)], "divide_id string, vpu_id string")
    attrs = cats.withColumn("slope", F.lit(0.5))
    for name, df in {"edges": edges, "catchments": cats, "attributes": attrs}.items():
        df.write.partitionBy("vpu_id").parquet(str(tmp_path / "hf" / name))
    wts = spark.createDataFrame([(2, 3, 4, 1.0, 0.0), (4, 3, 4, 1.0, 0.0), (1, 1, 3, 1.0, 0.0)], schemas.WEIGHTS)
    run = sinks.RunLayout.new(str(tmp_path))
    jobs.run_chain(
        spark, str(tmp_path / "hf"), "7", "wb-2", blocks(spark, hours=3), wts, (3, 4),
        "2024-01-01", "2024-01-01", run,
    )
    assert rows(spark.read.parquet(run.forcing), "id", "mean", "n_cells") == [(4, 303.0, 2)] * 3
    config = spark.read.json(run.config)
    assert rows(config, "id", "slope", "n_steps") == [(2, 0.5, 0), (4, 0.5, 3), (5, 0.5, 0)]
    assert spark.read.parquet(f"{run.domain}/edges").count() == 4


def test_reference_job(spark, tmp_path):
    netcdf.write_blocks(blocks(spark, nrow=3, ncol=4), str(tmp_path / "in"))
    jobs.run_references(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out").glob("name=*")] == ["name=2024010100.v.1.1.json"]


def test_forcing_from_a_boundary_file(spark, tmp_path):
    from basinflow.functions.crs import lcc_inverse

    grid = Grid(xmin=0.0, ymax=20_000.0, res=1000.0, ncol=20, nrow=20)
    corners = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(
        [(4000.0, 5000.0), (9000.0, 5000.0), (9000.0, 12000.0), (4000.0, 12000.0)])], "k int, x double, y double")
    lon, lat = lcc_inverse(F.col("x"), F.col("y"))
    ring = [[r[0], r[1]] for r in corners.orderBy("k").select(lon, lat).collect()]
    feature = {"type": "Feature", "id": "a", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [[*ring, ring[0]]]}}
    (tmp_path / "b.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
    polygons = jobs.boundary_polygons(spark, str(tmp_path / "b.json"), grid)
    got = jobs.forcing_dataset(blocks(spark, nrow=20, ncol=20), polygons, jobs.ForcingGrid(20, 20), "2024-01-01", "2024-01-01")
    assert {(r.j, r.i) for r in got.collect()} == {(j, i) for j in range(6, 13) for i in range(5, 10)}
    attrs = {(r.variable, r.name) for r in jobs.forcing_attrs(spark, "d", "WKT").collect()}
    assert {("x", "axis"), ("lat", "units"), ("spatial_ref", "crs_wkt"), ("", "x_dim")} <= attrs


def test_year_folders_and_windows(spark, tmp_path):
    for year, name in (("2009", "2009123123.nc"), ("2010", "2010010100.nc"), ("other", "2010010101.nc")):
        (tmp_path / "f" / year).mkdir(parents=True, exist_ok=True)
        (tmp_path / "f" / year / name).write_text("x")
    listed = list_forcing(year_manifest(spark, str(tmp_path / "f")), datetime(2009, 1, 1), datetime(2010, 12, 31), ordered=True)
    assert [r.valid_time for r in listed.collect()] == [datetime(2009, 12, 31, 23), datetime(2010, 1, 1)]
    windows = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), datetime(2024, 1, 1, 1)), ("b", datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2))],
        "window_id string, start timestamp_ntz, end timestamp_ntz",
    )
    jobs.run_windows(blocks(spark, hours=3), windows, str(tmp_path / "w"))
    sizes = spark.read.parquet(str(tmp_path / "w")).groupBy("window_id").agg(F.count_distinct("time").alias("n"))
    assert rows(sizes) == [("a", 2), ("b", 2)]
