"""Boundary polygons from GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basinflow.operators.joins import lookup_join
from basinflow.session import cut

_FEATURE = (
    "STRUCT<type: STRING, id: STRING, properties: MAP<STRING, STRING>,"
    " geometry: STRUCT<type: STRING, coordinates: STRING>>"
)
_POLYGON = "ARRAY<ARRAY<ARRAY<DOUBLE>>>"
_MULTI = "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"


# A text without escaped characters, its strings closed: what stands outside of strings.
_ESCAPED = r"(?s)\\."
_STRING = '"[^"]*"'
# What may stand in front of a feature in the text since the one before: no brace outside a string.
_BEFORE = r'(?s)^(?:[^"{}]++|"(?:[^"\\]++|\\.)*+")*+'
_HERE = ["_file", "_block"]


def _outside(text: Column, inside: Column) -> Column:
    """``text`` without its strings; ``inside`` says whether it begins in one. An open string at the end goes too."""
    plain = F.regexp_replace(text, _ESCAPED, "")
    plain = F.when(inside, F.concat(F.lit('"'), plain)).otherwise(plain)
    return F.regexp_replace(F.regexp_replace(plain, _STRING, ""), '(?s)".*$', "")


def _opened(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("{")))


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """The objects in the outer object of each file, one text per row, found by many tasks in each file.

    Files are cut at closing braces, by Spark's own splits. Whether a piece begins inside a string, and at what depth of
    braces, follows from what all pieces in front of it hold: sums within a split, then over the splits of a file, which
    has one row per split. Both readings of a split, beginning in a string or not, are summed before the
    one that holds is known. A piece after which the depth is 1 ends an object; pieces are put together by the
    number of objects that ended in front of them, so objects across splits come out whole. No value is longer than one
    object, and no task reads more than its splits and the objects it puts together.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"), "value",
    )
    quotes = F.regexp_count(F.regexp_replace("value", _ESCAPED, ""), F.lit('"'))
    before = W.partitionBy(*_HERE).orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy(*_HERE).orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    read = pieces.withColumn("_quotes", quotes)
    read = read.withColumn("_odd", F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2 == 1)
    for name, inside in (("0", F.col("_odd")), ("1", ~F.col("_odd"))):
        text = _outside(F.col("value"), inside)
        ends_inside = inside != (F.col("_quotes") % 2 == 1)
        read = read.withColumn(f"_step{name}", _opened(text) - F.when(ends_inside, 0).otherwise(1))
    read = read.withColumns({
        "_depth0": F.sum("_step0").over(upto), "_depth1": F.sum("_step1").over(upto),
    })
    read = cut(read, "pieces")
    splits = read.groupBy(*_HERE).agg(
        F.sum("_quotes").alias("_quotes"), F.sum("_step0").alias("_step0"), F.sum("_step1").alias("_step1"),
    )
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = splits.withColumn("_inside", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2 == 1)
    starts = starts.withColumn("_base", F.coalesce(
        F.sum(F.when(F.col("_inside"), F.col("_step1")).otherwise(F.col("_step0"))).over(earlier), F.lit(0)
    )).select(*_HERE, "_inside", "_base")
    placed = lookup_join(read, starts, _HERE)
    closes = F.when(F.col("_inside"), ~F.col("_odd")).otherwise(F.col("_odd")) == (F.col("_quotes") % 2 == 1)
    depth = F.col("_base") + F.when(F.col("_inside"), F.col("_depth1")).otherwise(F.col("_depth0"))
    marked = placed.withColumn("_end", (closes & (depth == 1)).cast("int")).select(*_HERE, "_at", "value", "_end")
    counts = marked.groupBy(*_HERE).agg(F.sum("_end").alias("_end"))
    offsets = counts.withColumn("_gone", F.coalesce(F.sum("_end").over(earlier), F.lit(0))).select(*_HERE, "_gone")
    number = F.col("_gone") + F.coalesce(F.sum("_end").over(before), F.lit(0))
    numbered = lookup_join(marked, offsets, _HERE).withColumn("_number", number)
    whole = numbered.groupBy("_file", "_number").agg(
        F.max("_end").alias("_ended"),
        F.array_sort(F.collect_list(F.struct("_block", "_at", "value"))).alias("_pieces"),
    ).filter("_ended = 1")
    text = F.concat(F.array_join(F.transform("_pieces", lambda p: p["value"]), "}"), F.lit("}"))
    first = F.when(F.col("_number") == 0, F.regexp_replace(text, r"^\s*\{", "")).otherwise(text)
    return whole.select(F.regexp_replace(first, _BEFORE, "").alias("value"))


def _features(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    if lines:
        texts = spark.read.text(path)
        return texts.filter(F.trim("value") != "").select(F.from_json("value", _FEATURE).alias("f"))
    found = feature_texts(spark, path).select(F.from_json("value", _FEATURE).alias("f"))
    return found.filter("f.type = 'Feature'")


def _id(id_property: str | None) -> Column:
    return F.col(f"f.properties.{id_property}") if id_property else F.col("f.id")


def read_polygons(
    spark: SparkSession, path: str, id_property: str | None = None, lines: bool = False
) -> DataFrame:
    """Polygon and MultiPolygon vertices ``(poly_id, part, ring, seq, x, y)``.

    ``path`` holds feature collections, one per file, or with ``lines`` one feature per line. Either way many tasks
    read a large file. The id comes from a property or from the feature's ``id``. Features are the objects of
    type ``Feature`` directly below the outer object's members.
    """
    shapes = _features(spark, path, lines).select(
        _id(id_property).alias("poly_id"), F.col("f.geometry.type").alias("type"),
        F.col("f.geometry.coordinates").alias("text"),
    )
    parts = F.when(
        F.col("type") == "Polygon", F.array(F.from_json("text", _POLYGON))
    ).when(F.col("type") == "MultiPolygon", F.from_json("text", _MULTI))
    rings = shapes.select("poly_id", F.posexplode(parts).alias("part", "rings"))
    vertices = rings.select("poly_id", "part", F.posexplode("rings").alias("ring", "points"))
    return vertices.select(
        "poly_id", "part", "ring", F.posexplode("points").alias("seq", "p")
    ).select("poly_id", "part", "ring", "seq", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def read_records(
    spark: SparkSession, path: str, columns: list[str], lines: bool = False
) -> DataFrame:
    """Attribute records of the features, as text columns."""
    return _features(spark, path, lines).select(
        *[F.col(f"f.properties.{c}").alias(c) for c in columns]
    )
