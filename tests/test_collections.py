"""Feature collections read in pieces against a JSON reader."""

import json
import random

import pytest
from support import rows

from basinflow.sources import geojson


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)

    def to(size):
        spark.conf.set(name, str(size))

    yield to
    spark.conf.set(name, before)


def feature(r, k):
    text = "".join(r.choice(['"', "\\", "{", "}", "[", "é", "\n", "a", "Feature", '"}', "\\\""]) for _ in range(r.randrange(12)))
    return {
        "type": "Feature", "properties": {"ID": k, "note": text, "deep{": {"er}": {"x": [{}, {"y": text}]}}},
        "geometry": {"type": "Polygon", "coordinates": [[[k, 0], [k + 1, 0], [k + 1, 1.5], [k, 0]]]},
    }


def collection(seed, n):
    r = random.Random(seed)
    return {
        "name": 'a } brace {" and \\ more', "crs": {"type": "name", "properties": {"name": "x}"}}, "type": "FeatureCollection",
        "features": [feature(r, k) for k in range(n)], "bbox": [0, 0, 1, 1], "after": {"of": "it"},
    }


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("size", [37, 200, 10**6])
def test_pieces_of_one_file(spark, tmp_path, small_splits, seed, size):
    path = tmp_path / "c.geojson"
    held = collection(seed, 9)
    style = [{"indent": 1}, {}, {"separators": (",", ":")}, {"ensure_ascii": False}][seed]
    path.write_text(json.dumps(held, **style) + "\n" * (seed % 2), encoding="utf-8")
    small_splits(size)
    found = geojson.feature_texts(spark, str(path))
    got = [json.loads(r.value) for r in found.collect()]
    want = held["features"] + [held["crs"], held["after"]]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))
    polygons = geojson.read_polygons(spark, str(path), "ID")
    assert rows(polygons, "poly_id", "seq", "x", "y") == sorted(
        (str(k), s, float(x), float(y)) for k in range(9) for s, (x, y) in enumerate([(k, 0), (k + 1, 0), (k + 1, 1.5), (k, 0)])
    )


def test_several_files_and_no_features(spark, tmp_path, small_splits):
    small_splits(64)
    for k in range(3):
        (tmp_path / f"{k}.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature(random.Random(k), k)]}))
    (tmp_path / "none.json").write_text('{"type":"FeatureCollection","features":[]}')
    (tmp_path / "blank.json").write_text("")
    assert rows(geojson.read_records(spark, str(tmp_path), ["ID"])) == [("0",), ("1",), ("2",)]


def test_no_value_is_as_large_as_the_file(spark, tmp_path, small_splits):
    path = tmp_path / "big.geojson"
    path.write_text(json.dumps(collection(1, 400)))
    small_splits(4_000)
    found = geojson.feature_texts(spark, str(path))
    assert found.count() == 402
    assert found.selectExpr("max(length(value)) AS n").first().n < path.stat().st_size / 50
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 10
