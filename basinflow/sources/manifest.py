"""Listings of time-stamped files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.functions.names import bucket_url, first_stem
from basinflow.functions.timestamps import ntz, parse_stamp


def list_forcing(
    manifest: DataFrame, start: datetime, end: datetime, ordered: bool = False
) -> DataFrame:
    """Files of ``manifest(path, year)`` whose name says a time in ``[start, end]``.

    The name up to its first dot is ``yyyyMMddHH``. Years outside are pruned as partitions. Returns
    ``(valid_time, path, url)``, with ``ordered`` in time order (not needed to read the files).
    """
    stamped = manifest.filter(F.col("year").between(start.year, end.year)).withColumn(
        "valid_time", parse_stamp(first_stem(F.col("path")))
    )
    listed = stamped.filter(F.col("valid_time").between(ntz(start), ntz(end))).select(
        "valid_time", "path", bucket_url(F.col("path")).alias("url")
    )
    return listed.orderBy("valid_time", "path") if ordered else listed


def list_folder(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files below a folder as ``(path, length, modificationTime)``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length", "modificationTime")


def year_manifest(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``manifest(path, year)`` of the files stored below one folder per year, as ``{root}/{year}/{file}``."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").load(root).select("path")
    )
    folder = F.element_at(F.split("path", "/"), -2)
    return files.select("path", folder.try_cast("int").alias("year")).filter("year IS NOT NULL")
