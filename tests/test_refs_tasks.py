"""Reference documents are written by several tasks however small they are."""

import json

from pyspark.sql import functions as F

from basinflow.sources import netcdf


def test_small_documents_are_dealt_to_all_cores(spark, tmp_path):
    refs = spark.range(60).select(
        F.concat(F.lit("/in/"), F.col("id"), F.lit(".nc")).alias("path"), F.inline(F.array(
            F.struct(F.lit(".zgroup").alias("key"), F.lit("{}").alias("inline"),
                     F.lit(0).cast("bigint").alias("offset"), F.lit(0).cast("bigint").alias("length")),
            F.struct(F.lit("v/0.0").alias("key"), F.lit(None).cast("string").alias("inline"),
                     F.lit(8).cast("bigint").alias("offset"), F.lit(4).cast("bigint").alias("length")),
        )))
    netcdf.write_refs(refs, str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("name=*.json/part-*"))
    assert len(files) == 60
    plan = spark.sparkContext.defaultParallelism
    assert plan > 1 and {r[0] for r in spark.read.text(str(tmp_path / "out")).select("name").distinct().collect()} == {
        f"{k}.json" for k in range(60)}
    docs = {f.parent.name: json.loads(f.read_text()) for f in files}
    assert docs["name=7.json"]["refs"]["v/0.0"] == ["/in/7.nc", 8, 4]


def test_odd_names_and_lines_are_read_back(spark, tmp_path):
    names = ["a b", "50%", "x=y:z", "q'[1]", "ü"]
    refs = spark.createDataFrame(
        [(f"/in/{n}.nc", k, '"é"' if k == ".zattrs" else "{}", 0, 0) for n in names for k in (".zgroup", ".zattrs")],
        netcdf.REFERENCES)
    for _ in range(2):  # written again over what is there
        netcdf.write_refs(refs, str(tmp_path / "out"))
    got = spark.read.text(str(tmp_path / "out")).groupBy("name").count().collect()
    assert {(r[0], r[1]) for r in got} == {(f"{n}.json", 3) for n in names}


def test_headers_are_read_by_all_cores(spark, tmp_path):
    (tmp_path / "in").mkdir()
    blocks = spark.range(40).selectExpr(
        "'T2D' AS var", "TIMESTAMP_NTZ '2024-01-01' AS time", "CAST(id AS INT) AS y0", "1 AS x0", "1 AS ny", "2 AS nx",
        "array(1f, 2f) AS data")
    netcdf.write_blocks(blocks, str(tmp_path / "in"))
    refs = netcdf.scan_headers(spark, str(tmp_path / "in"), "*.nc")
    per_task = refs.select(F.spark_partition_id().alias("t"), "path").distinct().groupBy("t").count().collect()
    assert sum(r["count"] for r in per_task) == 40 and len(per_task) > 1
