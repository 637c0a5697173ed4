"""Composite jobs. Steps pass DataFrames; writing is left to the caller or to ``run_*``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow import schemas
from basinflow.functions.crs import NWM_LCC, LambertConformal, reproject_polygons
from basinflow.functions.gridindex import (
    Grid, IndexBounds, as_bounds, bbox_bounds, buffered_envelope, geotransform,
)
from basinflow.functions.timestamps import HOUR, ntz
from basinflow.operators import network
from basinflow.operators.attrs import grid_attrs, set_attrs, set_coordinate_attrs, set_crs
from basinflow.operators.catchments import configure_catchments
from basinflow.operators.cells import (
    explode_cells, grid_corners, hyperslab, time_slice, with_axis_coords,
)
from basinflow.operators.clip import (
    Mask, clip, polygon_runs, subset_domain_by_ids, to_index_space, union_runs,
)
from basinflow.operators.metadata import describe_cells, described_while_written
from basinflow.operators.timebins import (
    assign_bins, batch_windows, group_status, require_complete, time_bins,
)
from basinflow.operators.weights import full_basins, subset_weights
from basinflow.operators.zonal import zonal_mean_chunks, zone_weights
from basinflow.session import cut
from basinflow.sources.geojson import read_polygons, read_records
from basinflow.sources.manifest import list_forcing
from basinflow.sources.netcdf import scan_headers, write_refs
from basinflow.sources.sinks import (
    RunLayout, hourly_parts, replace_hours, write_bounds, write_dataset, write_hourly, write_metadata,
    write_tables, write_weights,
)
from basinflow.sources.stores import read_store, store_variables
from basinflow.sources.tables import polygon_ids, read_hydrofabric


@dataclass(frozen=True)
class ForcingGrid:
    """What a forcing job needs to know about its grid."""

    nrow: int
    ncol: int
    block: tuple[int, int] | None = None


def boundary_polygons(
    spark: SparkSession, path: str, grid: Grid, id_property: str | None = None, lines: bool = False,
    rows: str = "sn", crs: LambertConformal = NWM_LCC,
) -> DataFrame:
    """Polygons of a GeoJSON boundary file in the index space of a grid, as the clip jobs take them.

    Longitudes and latitudes are projected first; ``rows`` says which way the grid's rows count.
    """
    return to_index_space(reproject_polygons(read_polygons(spark, path, id_property, lines), crs), grid, rows)


def forcing_attrs(spark: SparkSession, dataset: str, spatial_ref: str) -> DataFrame:
    """Attributes that describe the coordinates and the coordinate system of a job's output."""
    datasets = spark.createDataFrame([(dataset,)], "dataset STRING")
    none = spark.createDataFrame([], schemas.ATTRS)
    return set_crs(set_coordinate_attrs(none, datasets), datasets, spatial_ref)


def run_windows(chunks: DataFrame, windows: DataFrame, out: str) -> None:
    """The rows of every window ``(window_id, start, end)``, one folder per window; a row in several
    windows is written to each."""
    parts = batch_windows(chunks, windows)
    parts.hint("rebalance", "window_id").write.mode("overwrite").partitionBy("window_id").parquet(out)


def forcing_hourly(
    manifest: DataFrame,
    chunks: DataFrame,
    axes: tuple[DataFrame, DataFrame],
    polygons: DataFrame,
    grid: ForcingGrid,
    start: datetime,
    end: datetime,
) -> DataFrame:
    """Listed hours of the forcing, clipped, with coordinates, as named hourly parts.

    ``axes`` are the x and y axis tables, ``polygons`` are in index space. Cells of the window
    outside the polygons are NULL.
    """
    listed = list_forcing(manifest, start, end).select(F.col("valid_time").alias("time")).distinct()
    hours = chunks.filter(F.col("time").between(ntz(start), ntz(end))).join(
        listed, "time", "left_semi"
    )
    runs = union_runs(polygon_runs(polygons, grid.nrow, grid.ncol))
    cells = clip(hours, runs, "mask", max_chunk=grid.block)
    return hourly_parts(with_axis_coords(cells, *axes))


def forcing_groups(
    written: DataFrame, spark: SparkSession, start: datetime, end: datetime, step_hours: int = 10
) -> DataFrame:
    """Status of each time group of the output."""
    span = spark.createDataFrame(
        [(start, end)], "start TIMESTAMP_NTZ, end TIMESTAMP_NTZ"
    )
    binned = assign_bins(written, ntz(start), ntz(end), step_hours)
    return group_status(time_bins(span, step_hours), binned)


def run_forcing_hourly(
    spark: SparkSession, out: str, start: datetime, end: datetime, step_hours: int = 10, **parts
) -> DataFrame:
    """Write the hourly parts, check them as written, and fail when a group is incomplete."""
    cells = forcing_hourly(start=start, end=end, **parts)
    write_hourly(cells, out)
    status = forcing_groups(spark.read.parquet(out), spark, start, end, step_hours)
    return require_complete(status)


def repair_forcing_hourly(
    spark: SparkSession, out: str, start: datetime, end: datetime, step_hours: int = 10, **parts
) -> DataFrame:
    """Cut and write the incomplete groups of an earlier run again, then check all as written.

    Only the hours of groups that lack one are read from the forcing and replaced; files of complete groups are
    not touched. Nothing is written if every group is complete. Fails if a group still is not.
    """
    stored = spark.read.parquet(out)
    bad = cut(forcing_groups(stored, spark, start, end, step_hours).filter(~F.col("ok")), "incomplete")
    if not bad.isEmpty():
        again = bad.select(F.explode(F.sequence("bin_start", "bin_end", F.expr(HOUR))).alias("time"))
        chunks = parts["chunks"].join(again, "time", "left_semi").select(*parts["chunks"].columns)
        replace_hours(forcing_hourly(start=start, end=end, **(parts | {"chunks": chunks})), out)
    status = forcing_groups(spark.read.parquet(out), spark, start, end, step_hours)
    return require_complete(status)


def forcing_dataset(
    chunks: DataFrame, polygons: DataFrame, grid: ForcingGrid, start: str, end: str
) -> DataFrame:
    """A time slice of a block store, clipped, as one dataset. Labels may be dates."""
    runs = union_runs(polygon_runs(polygons, grid.nrow, grid.ncol))
    return clip(time_slice(chunks, start, end), runs, "mask", max_chunk=grid.block)


def run_forcing_dataset(out: str, **parts) -> None:
    write_dataset(forcing_dataset(**parts), out)


def run_forcing_files(
    spark: SparkSession, store: str, boundary: str, grid: Grid, layout: RunLayout, start: datetime, end: datetime,
    spatial_ref: str, id_property: str | None = None, lines: bool = False, rows: str = "sn",
    crs: LambertConformal = NWM_LCC, variables: Sequence[str] | None = None,
) -> DataFrame:
    """From a stored array and a boundary file to a clipped dataset with attributes and description.

    The boundary's polygons are projected and turned into runs first; their window decides which chunks of the store are
    planned. Cells, attributes and description go below the run's folder; the description, which is returned, is
    gathered while the cells are written. A boundary without a cell inside is an error.
    """
    polygons = boundary_polygons(spark, boundary, grid, id_property, lines, rows, crs)
    mask = Mask.of(union_runs(polygon_runs(polygons, grid.nrow, grid.ncol)))
    if mask.window is None:
        raise ValueError("no cell of the grid lies inside the boundary")
    names = store_variables(spark, store) if variables is None else list(variables)
    blocks = read_store(spark, store, start, end, mask.window, names)
    description = described_while_written(
        clip(blocks, mask, "mask"), layout.run_id, names, lambda cells: write_dataset(cells, f"{layout.forcing}/cells"))
    write_dataset(forcing_attrs(spark, layout.run_id, spatial_ref), f"{layout.forcing}/attrs")
    write_metadata(description, layout.metadata)
    return description


@dataclass(frozen=True)
class StaticInputs:
    """Tables of the full domain. Grids are block tables by name; others may be left out.

    ``attrs`` are rewritten for every land grid; this needs a land grid named ``geogrid`` which holds
    the corner variables. ``axes`` give ``(xs, ys, x resolution, y resolution)`` by grid name, for grids
    whose GeoTransform is to be rewritten. ``row_orders`` say by grid name which way its rows count,
    ``sn`` or ``ns``; the grid and its GeoTransform are cut by the same rows. By default land grids count
    from the south and routing grids from the north.
    """

    weights: DataFrame | None = None
    polys: DataFrame | None = None
    links: DataFrame | None = None
    buckets: DataFrame | None = None
    lakes: DataFrame | None = None
    lake_types: DataFrame | None = None
    stations: DataFrame | None = None
    land_grids: Mapping[str, DataFrame] | None = None
    routing_grids: Mapping[str, DataFrame] | None = None
    attrs: DataFrame | None = None
    axes: Mapping[str, tuple[DataFrame, DataFrame, float, float]] | None = None
    row_orders: Mapping[str, str] | None = None

    def window(self, name: str, bounds: Mapping[str, IndexBounds]) -> IndexBounds:
        """The rectangle a grid is cut to, in its own row order."""
        land = name in (self.land_grids or {})
        order = (self.row_orders or {}).get(name, "sn" if land else "ns")
        return bounds[f"{'geo' if land else 'hyd'}_{order}"]

    def check(self) -> None:
        """Options that need others are refused before any work starts."""
        if (self.weights is None) != (self.polys is None):
            raise ValueError("weights and polys belong together")
        if self.weights is not None and self.links is None:
            raise ValueError("weights need links")
        network_ready = self.weights is not None and self.links is not None
        for name in ("buckets", "lakes", "stations"):
            if getattr(self, name) is not None and not network_ready:
                raise ValueError(f"{name} need weights and links")
        if self.lakes is not None and self.lake_types is None:
            raise ValueError("lakes need lake_types")
        if self.attrs is not None and "geogrid" not in (self.land_grids or {}):
            raise ValueError("attrs need a land grid named geogrid")
        if self.axes and self.attrs is None:
            raise ValueError("axes need attrs")
        grids = set(self.land_grids or {}) | set(self.routing_grids or {})
        for what in ("axes", "row_orders"):
            unknown = set(getattr(self, what) or {}) - grids
            if unknown:
                raise ValueError(f"{what} of unknown grids: {sorted(unknown)}")
        if set((self.row_orders or {}).values()) - {"sn", "ns"}:
            raise ValueError("row orders are sn or ns")


def window_geotransform(
    xs: DataFrame, ys: DataFrame, x_res: float, y_res: float, window: IndexBounds, dataset: str
) -> DataFrame:
    """GeoTransform attribute of a grid cut to ``window``, from its first column and row."""
    x = xs.filter(F.col("i") == window.imin).select(F.lit(dataset).alias("dataset"), "i", "x")
    y = ys.filter(F.col("j") == window.jmin).select(F.lit(dataset).alias("dataset"), "j", "y")
    text = geotransform(x.join(y, "dataset"), x_res, y_res, by=["dataset"])
    return text.select(
        "dataset", F.lit("crs").alias("variable"), F.lit("GeoTransform").alias("name"),
        F.lit("c").alias("type"), F.array("GeoTransform").alias("value"),
    )


def static_attrs(
    inputs: StaticInputs, bounds: Mapping[str, IndexBounds], geogrid: DataFrame
) -> DataFrame:
    """Attributes of the cut grids: sizes and corners of land grids, GeoTransforms where asked for.

    The corners are those of the cut ``geogrid``; all land grids get the same.
    """
    geo = inputs.window("geogrid", bounds)
    names = F.array(*[F.lit(n) for n in inputs.land_grids])
    corners = grid_corners(explode_cells(geogrid).withColumn("dataset", F.lit("geogrid")))
    corners = corners.select(F.explode(names).alias("dataset"), "corner_lats", "corner_lons")
    sizes = inputs.attrs.sparkSession.createDataFrame(
        [(n, geo.imin, geo.imax, geo.jmin, geo.jmax) for n in inputs.land_grids],
        "dataset STRING, w INT, e INT, s INT, n INT",
    )
    attrs = grid_attrs(inputs.attrs, sizes, corners)
    for name, (xs, ys, x_res, y_res) in (inputs.axes or {}).items():
        window = inputs.window(name, bounds)
        attrs = set_attrs(attrs, window_geotransform(xs, ys, x_res, y_res, window, name))
    return attrs


def static_subset(
    inputs: StaticInputs,
    bounds: Mapping[str, IndexBounds],
    envelope: DataFrame,
) -> dict[str, DataFrame]:
    """Every table of a domain cut to one box.

    ``bounds`` as from ``as_bounds``, ``envelope`` as from ``buffered_envelope``. A table that is not
    given is skipped.
    """
    inputs.check()
    out: dict[str, DataFrame] = {}
    for name, grid in (inputs.land_grids or {}).items():
        stag = "stag_x" in grid.columns
        out[name] = hyperslab(grid, inputs.window(name, bounds), stag=stag, reorigin=True)
    for name, grid in (inputs.routing_grids or {}).items():
        out[name] = hyperslab(grid, inputs.window(name, bounds), reorigin=True)
    if inputs.attrs is not None:
        out["attrs"] = static_attrs(inputs, bounds, out["geogrid"])
    if inputs.weights is None:
        return out
    rect = bounds["hyd_sn"]
    # four tables depend on the kept basins: find them once
    basins = cut(full_basins(inputs.weights, rect), "basins")
    out["weights"], out["polys"] = subset_weights(inputs.weights, inputs.polys, basins, rect)
    keep = network.kept_ids(basins, network.links_in_envelope(inputs.links, envelope))
    out["links"] = network.subset_links(inputs.links, keep)
    if inputs.buckets is not None:
        out["buckets"] = network.subset_buckets(inputs.buckets, basins)
    if inputs.lakes is not None:
        out["lakes"], out["links"] = network.retain_lakes(
            inputs.lakes, inputs.lake_types, out["links"], inputs.links
        )
    if inputs.stations is not None:
        out["stations"] = network.subset_stations(inputs.stations, out["links"])
    return out


def run_static_subset(
    inputs: StaticInputs,
    corners: DataFrame,
    grid: Grid,
    layout: RunLayout,
    dxy: int = 4,
    cell_buffer: int = 2,
) -> dict[str, IndexBounds]:
    """Cut a domain to the box spanned by ``corners(x, y)`` and write it below the run's folder."""
    inputs.check()
    table = bbox_bounds(corners, grid, dxy)
    bounds = as_bounds(table)
    parts = static_subset(inputs, bounds, buffered_envelope(corners, grid, cell_buffer))
    if "weights" in parts:
        write_weights(parts.pop("weights"), parts.pop("polys"), f"{layout.domain}/spatialweights")
    write_tables(parts, layout.domain)
    write_bounds(table, f"{layout.domain}/params")
    return bounds


def domain_by_ids(
    grids: Mapping[str, DataFrame],
    polygons: DataFrame,
    ids: DataFrame,
    grid: ForcingGrid,
    label: str,
) -> DataFrame:
    """All grids of a domain clipped to the listed polygons, as one labelled cell table."""
    parts = subset_domain_by_ids(grids, polygons, ids, grid.nrow, grid.ncol)
    out = None
    for name, cells in parts.items():
        named = cells.select(
            F.lit(label).alias("label"), F.lit(name).alias("grid"), *cells.columns
        )
        out = named if out is None else out.unionByName(named)
    return out


def run_domain_by_ids(
    spark: SparkSession, grids: Mapping[str, DataFrame], boundary: str, records: str, grid: Grid, label: str,
    layout: RunLayout, variables: Sequence[str], id_property: str, id_column: str | None = None, lines: bool = False,
    rows: str = "sn", crs: LambertConformal = NWM_LCC,
) -> DataFrame:
    """Cut a domain to those polygons of a boundary file whose ids another file of records lists, write and describe it.

    ``id_column`` is the attribute of the records that holds the ids, by default the one named like the boundary's.
    """
    polygons = boundary_polygons(spark, boundary, grid, id_property, lines, rows, crs)
    ids = polygon_ids(read_records(spark, records, [id_column or id_property], lines))
    domain = domain_by_ids(grids, polygons, ids.distinct(), ForcingGrid(grid.nrow, grid.ncol), label)
    return run_domain_with_metadata(domain, layout, variables)


def domain_with_metadata(domain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A domain and the description of its variables."""
    return domain, describe_cells(domain, "domain")


def run_domain_with_metadata(domain: DataFrame, layout: RunLayout, variables: Sequence[str] | None = None) -> DataFrame:
    """Write a domain and its description, which is returned.

    With the names of its variables it is described while it is written, else by reading what was written.
    """
    if variables is None:
        write_dataset(domain, layout.domain)
        description = describe_cells(domain.sparkSession.read.parquet(layout.domain), layout.run_id)
    else:
        description = described_while_written(
            domain, layout.run_id, variables, lambda cells: write_dataset(cells, layout.domain))
    write_metadata(description, layout.metadata)
    return description


def catchment_inputs(
    layers: Mapping[str, DataFrame],
    edges: DataFrame,
    wb_id: str,
    chunks: DataFrame,
    weights: DataFrame,
    block: tuple[int, int],
    start: str,
    end: str,
    attributes: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """Hydrofabric above a flowpath, its forcing, and the configuration of its catchments."""
    domain = network.subset_hydrofabric(layers, edges, wb_id)
    number = F.regexp_replace("divide_id", "^cat-", "").cast("bigint").alias("id")
    catchments = domain["catchments"].select(number)
    attrs = domain["attributes"].select(number, *attributes)
    zones = zone_weights(weights).join(catchments, "id", "left_semi")
    forcing = zonal_mean_chunks(time_slice(chunks, start, end), zones, block)
    return configure_catchments(catchments, attrs, forcing)


def run_hydrofabric_subset(
    spark: SparkSession, base: str, vpu_id: str, wb_id: str, layers: Sequence[str], layout: RunLayout
) -> None:
    """Cut the layers stored at ``base`` to what drains to ``wb_id`` and write them.

    The unit's edges are the layer ``edges`` (``id, toid``); it is cut and written as well.
    """
    parts = read_hydrofabric(spark, base, vpu_id, [*layers, "edges"])
    write_tables(network.subset_hydrofabric(parts, parts["edges"], wb_id), layout.domain)


def run_chain(
    spark: SparkSession,
    base: str,
    vpu_id: str,
    wb_id: str,
    chunks: DataFrame,
    weights: DataFrame,
    block: tuple[int, int],
    start: str,
    end: str,
    layout: RunLayout,
) -> None:
    """Domain, forcing and configuration of the catchments above a flowpath, written step by step.

    Each step reads what the one before has written.
    """
    run_hydrofabric_subset(spark, base, vpu_id, wb_id, ["catchments", "attributes"], layout)
    number = F.regexp_replace("divide_id", "^cat-", "").cast("bigint").alias("id")
    catchments = spark.read.parquet(f"{layout.domain}/catchments").select(number)
    attributes = spark.read.parquet(f"{layout.domain}/attributes")
    kept = [c for c in attributes.columns if c not in {"divide_id", "vpu_id"}]
    zones = zone_weights(weights).join(catchments, "id", "left_semi")
    write_dataset(zonal_mean_chunks(time_slice(chunks, start, end), zones, block), layout.forcing)
    config, _ = configure_catchments(
        catchments, attributes.select(number, *kept), spark.read.parquet(layout.forcing)
    )
    config.write.mode("overwrite").json(layout.config)


def run_references(spark: SparkSession, folder: str, out: str) -> None:
    """A reference document for every classic NetCDF file of a folder."""
    write_refs(scan_headers(spark, folder), out)
