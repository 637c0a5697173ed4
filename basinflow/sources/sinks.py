"""Writers."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow import schemas
from basinflow.functions.timestamps import stamp
from basinflow.operators.cluster import clustered
from basinflow.operators.metadata import metadata_documents
from basinflow.operators.pyramid import build_pyramid

# Fixed value: suffix of hourly forcing outputs.
HOURLY_SUFFIX = ".LDASIN_DOMAIN1"


def hourly_parts(cells: DataFrame) -> DataFrame:
    """Add ``part``, the name of the output a row belongs to."""
    return cells.withColumn("part", F.concat(stamp(F.col("time")), F.lit(HOURLY_SUFFIX)))


def write_hourly(cells: DataFrame, out: str) -> None:
    """One output folder per time step. An hour too big for one task is split over several files."""
    named = hourly_parts(cells).hint("rebalance", "part")
    named.write.mode("overwrite").partitionBy("part").parquet(out)


def replace_hours(cells: DataFrame, out: str) -> None:
    """Write the time steps of ``cells`` again; files of all other steps stay as they are."""
    named = hourly_parts(cells).hint("rebalance", "part")
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(out)


def write_dataset(df: DataFrame, out: str) -> None:
    """A single dataset."""
    df.write.mode("overwrite").parquet(out)


def bounds_lines(bounds: DataFrame) -> DataFrame:
    """Index bounds as tab-separated text: quoted header and names, bare numbers (``ord, line``)."""
    # Columns and row order of the bounds file.
    columns = ["grid", "imin", "imax", "jmin", "jmax", "index_start"]
    order = ["hyd_sn", "hyd_ns", "geo_sn", "geo_ns"]
    rank = F.array_position(F.array(*[F.lit(g) for g in order]), F.col("grid")).cast("int")
    header = F.lit("\t".join(f'"{c}"' for c in columns))
    line = F.concat_ws(
        "\t", F.concat(F.lit('"'), F.col("grid"), F.lit('"')),
        *[F.col(c).cast("string") for c in columns[1:]],
    )
    first = bounds.filter(F.col("grid") == order[0]).select(
        F.lit(0).alias("ord"), header.alias("line")
    )
    return first.unionByName(bounds.select(rank.alias("ord"), line.alias("line")))


def write_bounds(bounds: DataFrame, out: str) -> None:
    """The bounds of one box (five lines) as a text file."""
    lines = bounds_lines(bounds).coalesce(1).sortWithinPartitions("ord")
    lines.select("line").write.mode("overwrite").text(out)


def part_documents(bins: DataFrame) -> DataFrame:
    """``(part, document)``: start and end of every time group as JSON with sorted keys."""

    def iso(c: str):
        return F.replace(F.col(c).cast("string"), F.lit(" "), F.lit("T"))

    doc = F.to_json(F.struct(iso("bin_end").alias("end"), iso("bin_start").alias("start")))
    return bins.select(F.col("bin").alias("part"), doc.alias("document"))


def write_parts(bins: DataFrame, out: str) -> None:
    """One JSON document per time group."""
    part_documents(bins).write.mode("overwrite").partitionBy("part").text(out)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """``(part, start, end)`` of the time groups that ``write_parts`` has stored."""
    doc = F.from_json("value", "start STRING, end STRING")
    times = [F.to_timestamp_ntz(doc[c], F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias(c) for c in ("start", "end")]
    return spark.read.schema("value STRING, part INT").text(path).select("part", *times)


def conform(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Columns the target has, in the target's order; others are not written."""
    return df.select(*[c for c in target_columns if c in df.columns])


def write_conformed(df: DataFrame, template: DataFrame, out: str) -> None:
    """Write the rows of ``df`` with the columns and types of ``template`` that it has."""
    types = {f.name: f.dataType for f in template.schema.fields}
    rows = conform(df, template.columns)
    rows.select(*[F.col(c).cast(types[c]).alias(c) for c in rows.columns]).write.mode(
        "overwrite"
    ).parquet(out)


def write_weights(weights: DataFrame, polys: DataFrame, out: str) -> None:
    """Weights and polys side by side, each with the names and types that ``read_weights`` expects."""
    for df, schema, name in ((weights, schemas.WEIGHTS, "data"), (polys, schemas.POLYS, "polys")):
        rows = conform(df, schema.names)
        typed = [F.col(c).cast(schema[c].dataType).alias(c) for c in rows.columns]
        rows.select(*typed).write.mode("overwrite").parquet(f"{out}/{name}")


@dataclass(frozen=True)
class RunLayout:
    """Folders of one run."""

    base: str
    run_id: str

    @classmethod
    def new(cls, base: str) -> RunLayout:
        return cls(base, uuid.uuid4().hex)

    @property
    def root(self) -> str:
        return f"{self.base.rstrip('/')}/{self.run_id}"

    # Folder names of a run.
    @property
    def domain(self) -> str:
        return f"{self.root}/domain"

    @property
    def forcing(self) -> str:
        return f"{self.root}/forcing"

    @property
    def config(self) -> str:
        return f"{self.root}/config"

    @property
    def results(self) -> str:
        return f"{self.root}/results"

    @property
    def metadata(self) -> str:
        return f"{self.root}/.meta"


def write_tables(tables: Mapping[str, DataFrame], out: str) -> None:
    """Named tables below one folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")


def publish(df: DataFrame, out: str) -> None:
    """Results into the output folder, added to what is there."""
    df.write.mode("append").parquet(out)


def write_metadata(description: DataFrame, out: str) -> None:
    """One JSON document per dataset and variable."""
    docs = metadata_documents(description)
    docs.select("dataset", "document").write.mode("overwrite").partitionBy("dataset").text(out)


def write_pyramid(
    cells: DataFrame, out: str, levels: int, tile: int = 512, method: str = "nearest",
    keys: Sequence[str] = ("var", "time"),
) -> None:
    """A pyramid partitioned by level, with the cells of a tile close together."""
    tiles = build_pyramid(cells, levels, tile, method, keys)
    tiles.hint("rebalance", "level", "tile_row", "tile_col").sortWithinPartitions(
        "tile_row", "tile_col", *keys, "row", "col"
    ).write.mode("overwrite").partitionBy("level").parquet(out)


def write_clustered(
    features: DataFrame, out: str, extent: tuple[float, float, float, float], tie_breaker: str
) -> None:
    """Features sorted along a Z-order curve, so box filters skip row groups by their statistics."""
    clustered(features, extent, tie_breaker).write.mode("overwrite").parquet(out)


def read_pyramid(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
