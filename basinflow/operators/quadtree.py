"""Polygons covered by quadtree cells: large ones inside, smaller ones towards the outline.

A cell of level ``l`` holds ``2^l`` by ``2^l`` grid cells; its ``qj, qi`` are the 0-based grid indices, shifted right by
``l``. A polygon's cover is the set of largest cells that lie wholly inside it, so its cells are disjoint and hold exactly
the grid cells that ``polygon_runs`` finds, by the same centre rule.

The cover is made from the top level down. Runs are cut at the borders of cells; a cell whose runs fill it is done, runs
of the others go on to the next level. What goes on lies in cells that the outline crosses, so the rows of each level grow
with the length of the outline, not with the area. Each level is written to the shared folder, its sums are combined
before the shuffle, and the runs of a cell that holds most of them stay splittable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinflow.operators.joins import lookup_join
from basinflow.session import Rounds, cut

# Cells of this level have 4,096 grid cells on a side; larger insides are covered by several.
TOP = 12
KEYS = ["poly_id", "qj", "qi"]


def _dealt(runs: DataFrame, level: int) -> DataFrame:
    """Runs ``(poly_id, row, lo, hi)`` (1-based, ``hi`` outside) cut at the borders of a level's cells."""
    first, last = F.shiftright(F.col("lo") - 1, level), F.shiftright(F.col("hi") - 2, level)
    each = runs.select(
        "poly_id", "row", "lo", "hi", F.shiftright(F.col("row") - 1, level).alias("qj"),
        F.explode(F.sequence(first, last)).alias("qi"),
    )
    west = F.shiftleft("qi", level) + 1
    return each.withColumns({
        "lo": F.greatest("lo", west).cast("int"), "hi": F.least(F.col("hi"), west + (1 << level)).cast("int"),
    })


def quadtree_cover(runs: DataFrame, top: int = TOP) -> DataFrame:
    """``poly_id, level, qj, qi`` of the largest cells wholly inside each polygon, from its disjoint runs."""
    spark = runs.sparkSession
    rounds = Rounds(spark, "cover")
    left = runs.filter("lo < hi").select("poly_id", "row", "lo", "hi")
    covers = []
    for level in range(top, -1, -1):
        pieces = rounds.put(_dealt(left, level))
        if pieces.isEmpty():
            break
        full = pieces.groupBy(*KEYS).agg(F.sum(F.col("hi") - F.col("lo")).alias("_n"))
        whole = cut(full.filter(F.col("_n") == F.lit(4**level)).drop("_n"), f"cover-{level}")
        covers.append(whole.withColumn("level", F.lit(level)).select("poly_id", "level", "qj", "qi"))
        left = pieces.join(whole, KEYS, "left_anti").select("poly_id", "row", "lo", "hi")
    out = covers[0] if covers else left.select("poly_id", F.lit(0).alias("level"), "row", "lo").toDF(
        "poly_id", "level", "qj", "qi"
    )
    for more in covers[1:]:
        out = out.unionByName(more)
    return out


def cover_cells(cover: DataFrame) -> DataFrame:
    """The grid cells of a cover, as 1-based ``poly_id, j, i``."""
    side = F.expr("shiftleft(1, level)")
    first_j, first_i = F.expr("shiftleft(qj, level)") + 1, F.expr("shiftleft(qi, level)") + 1
    rows = cover.select(
        "poly_id", first_i.alias("_i"), side.alias("_n"), F.explode(F.sequence(first_j, first_j + side - 1)).alias("j")
    )
    return rows.select("poly_id", "j", F.explode(F.sequence(F.col("_i"), F.col("_i") + F.col("_n") - 1)).alias("i"))


def join_cover(rows: DataFrame, cover: DataFrame) -> DataFrame:
    """Rows with 1-based grid indices ``j, i``, next to the ``poly_id`` of every polygon that holds them.

    A row looks for its cell of each level that the cover has: as many equal keys as levels, no comparison with an
    outline.
    """
    levels = sorted(r.level for r in cover.select("level").distinct().collect())  # TOP + 1 at most
    if not levels:
        none = F.lit(None).cast(cover.schema["poly_id"].dataType)
        return rows.withColumn("poly_id", none).filter(F.lit(False))
    tried = rows.withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels])))
    tried = tried.withColumns({
        "qj": F.expr("shiftright(j - 1, level)"), "qi": F.expr("shiftright(i - 1, level)"),
    })
    return lookup_join(tried, cover, ["level", "qj", "qi"]).drop("level", "qj", "qi")
