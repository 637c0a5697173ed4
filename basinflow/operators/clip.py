"""Polygon clip of chunked grids.

Polygons are vertex rows ``(poly_id, part, ring, seq, x, y)`` with closed rings; holes are further
rings of the same polygon. In index space the centre of cell ``(j, i)`` is the point ``(i, j)``. A
cell belongs to a polygon when its centre does. The polygon is turned into ``runs`` of cells per
grid row (``row, lo, hi``, ``lo <= i < hi``) and runs are joined to grid rows by equality.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basinflow.functions.gridindex import Grid, IndexBounds
from basinflow.operators.cells import chunk_rows, explode_cells, hyperslab
from basinflow.operators.joins import lookup_join
from basinflow.session import cut

# Width of the column strips used as second join key.
STRIP = 256


def to_index_space(polygons: DataFrame, grid: Grid, rows: str = "ns") -> DataFrame:
    """Projected vertices to index space; ``rows`` counts from the north or south (``ns``, ``sn``)."""
    u = (F.col("x") - grid.xmin) / grid.res + 0.5
    north = (F.lit(grid.ymax) - F.col("y")) / grid.res + 0.5
    v = north if rows == "ns" else F.lit(grid.nrow + 1.0) - north
    return polygons.withColumns({"x": u, "y": v})


def edges(polygons: DataFrame) -> DataFrame:
    """Consecutive vertices of each ring as ``(poly_id, x1, y1, x2, y2)``.

    Successors are found by an equi-join that includes ``seq``, so a ring of any length spreads over
    all tasks.
    """
    ring = ["poly_id", "part", "ring", "seq"]
    nxt = polygons.select(
        "poly_id", "part", "ring", (F.col("seq") - 1).alias("seq"),
        F.col("x").alias("x2"), F.col("y").alias("y2"),
    )
    first = polygons.select(*ring, F.col("x").alias("x1"), F.col("y").alias("y1"))
    return first.join(nxt, ring).select("poly_id", "x1", "y1", "x2", "y2")


def polygon_runs(polygons: DataFrame, nrow: int, ncol: int) -> DataFrame:
    """Cells inside each polygon as ``(poly_id, row, lo, hi)``, ``lo <= i < hi``.

    Every edge toggles the cells to the east of its crossing with each grid row. Toggles are counted
    per cell first, so what is ordered per polygon and row is at most one entry per grid column.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    spans = edges(polygons).withColumns({
        "_r0": F.greatest(F.ceil(low), F.lit(1)),
        "_r1": F.least(F.ceil(high) - 1, F.lit(nrow)),
    }).filter("_r0 <= _r1")
    crossings = spans.withColumn("row", F.explode(F.sequence(F.col("_r0").cast("int"), F.col("_r1").cast("int"))))
    cx = F.col("x1") + (F.col("row") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (
        F.col("y2") - F.col("y1")
    )
    first = F.least(F.greatest(F.ceil(cx), F.lit(1)), F.lit(ncol + 1)).cast("int")
    toggles = (
        crossings.select("poly_id", "row", first.alias("at"))
        .groupBy("poly_id", "row", "at").agg(F.count("*").alias("n"))
        .filter("n % 2 = 1")
    )
    w = W.partitionBy("poly_id", "row").orderBy("at")
    return (
        toggles.select(
            "poly_id", "row", F.col("at").alias("lo"), F.lead("at").over(w).alias("hi"),
            F.row_number().over(w).alias("_k"),
        )
        .filter("_k % 2 = 1 AND lo < hi")
        .drop("_k")
    )


def union_runs(runs: DataFrame) -> DataFrame:
    """Cells covered by any polygon, as disjoint ``(row, lo, hi)``."""
    steps = runs.select("row", F.inline(F.array(
        F.struct(F.col("lo").alias("at"), F.lit(1).alias("step")),
        F.struct(F.col("hi").alias("at"), F.lit(-1).alias("step")),
    ))).groupBy("row", "at").agg(F.sum("step").alias("step")).filter("step <> 0")
    w = W.partitionBy("row").orderBy("at")
    return (
        steps.select(
            "row", F.col("at").alias("lo"), F.lead("at").over(w).alias("hi"),
            F.sum("step").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("_cover"),
        )
        .filter("_cover > 0")
        .drop("_cover")
    )


@dataclass(frozen=True)
class Mask:
    """Runs written to the shared folder, their number, and the index range holding them."""

    runs: DataFrame
    count: int
    window: IndexBounds | None

    @classmethod
    def of(cls, runs: DataFrame) -> Mask:
        """Materialise runs once, for any number of grids to be clipped."""
        runs = cut(runs, "runs")
        e = runs.agg(
            F.count("*").alias("n"), F.min("lo").alias("i0"), F.max("hi").alias("i1"),
            F.min("row").alias("j0"), F.max("row").alias("j1"),
        ).first()
        window = IndexBounds(e.i0, e.i1 - 1, e.j0, e.j1) if e.n else None
        return cls(runs, e.n, window)


def _strips(lo: str, hi: str):
    """Numbers of the column strips touched by ``lo..hi`` (inclusive columns)."""
    return F.sequence(F.expr(f"{lo} div {STRIP}"), F.expr(f"{hi} div {STRIP}"))


def clip(
    chunks: DataFrame,
    runs: DataFrame | Mask,
    mode: str = "mask",
    keys: Sequence[str] = (),
    max_chunk: tuple[int, int] | None = None,
) -> DataFrame:
    """Cells of the blocks inside the runs.

    Blocks are first cut to the window of the runs. ``drop`` returns only cells inside, ``mask`` all
    cells of the window with NULL outside. With ``mask``, and with ``drop`` unless ``keys`` names
    run columns to carry along, runs must be disjoint (``union_runs``).
    """
    mask = runs if isinstance(runs, Mask) else Mask.of(runs)
    window = mask.window
    if window is None:
        return explode_cells(chunks.filter(F.lit(False)))
    blocks = hyperslab(chunks, window, max_chunk=max_chunk)
    side = mask.runs.select(*keys, F.col("row").alias("j"), "lo", "hi").withColumn(
        "_strip", F.explode(_strips("lo", "(hi - 1)"))
    )
    keep = [c for c in chunks.columns if c not in {"y0", "x0", "ny", "nx", "data"}]
    rows = chunk_rows(blocks).withColumn("_x1", F.col("x0") + F.col("nx") - 1)
    rows = rows.withColumn("_strip", F.explode(_strips("x0", "_x1")))
    if mode == "drop":
        hit = lookup_join(
            rows, side, ["j", "_strip"], "inner",
            (F.col("lo") <= F.col("_x1")) & (F.col("hi") > F.col("x0")),
        )
        first = F.greatest(F.col("x0"), F.col("lo"), F.col("_strip") * STRIP)
        last = F.least(F.col("_x1"), F.col("hi") - 1, F.col("_strip") * STRIP + STRIP - 1)
        # the pieces can meet a run in the same strip without overlapping inside that strip
        hit = hit.withColumns({"_a": first.cast("int"), "_b": last.cast("int")}).filter("_a <= _b")
        hit = hit.withColumn("i", F.explode(F.sequence("_a", "_b")))
        value = F.element_at("data", F.col("i") - F.col("x0") + 1).alias("value")
        return hit.select(*keep, *keys, "j", "i", value)
    if mode != "mask":
        raise ValueError(f"unknown clip mode {mode}")
    if keys:
        raise ValueError("mask mode works on one merged set of runs")
    # one row per grid row and strip, with the few runs that a strip can hold; cells unfold last
    strips = side.groupBy("j", "_strip").agg(F.collect_list(F.struct("lo", "hi")).alias("_runs"))
    hit = lookup_join(rows, strips, ["j", "_strip"], "left")
    first = F.greatest(F.col("x0"), F.col("_strip") * STRIP)
    last = F.least(F.col("_x1"), F.col("_strip") * STRIP + STRIP - 1)
    hit = hit.withColumn("i", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    inside = F.exists("_runs", lambda r: (F.col("i") >= r["lo"]) & (F.col("i") < r["hi"]))
    value = F.when(inside, F.element_at("data", F.col("i") - F.col("x0") + 1)).alias("value")
    return hit.select(*keep, "j", "i", value)


def subset_domain_by_ids(
    grids: Mapping[str, DataFrame],
    polygons: DataFrame,
    ids: DataFrame,
    nrow: int,
    ncol: int,
    mode: str = "mask",
) -> dict[str, DataFrame]:
    """Clip every grid of a domain to the polygons whose id is in ``ids(poly_id)``."""
    chosen = polygons.join(ids.select("poly_id").distinct(), "poly_id", "left_semi")
    mask = Mask.of(union_runs(polygon_runs(chosen, nrow, ncol)))
    return {name: clip(grid, mask, mode) for name, grid in grids.items()}
