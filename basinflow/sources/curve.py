"""Feature tables stored along a Hilbert curve, and box reads that push ranges of the curve.

A feature's key is the place of its box's centre on a curve of ``2**ORDER`` by ``2**ORDER`` cells over an extent; centres
outside take the cell at the edge. Rows are range-partitioned and sorted by key, so each row group holds a
short piece of the curve. A box read widens the box by the largest half size of any feature, splits it into ranges of
keys, and filters by them: the scan skips row groups by their statistics. The exact box is tested after, so ranges only
save reading. Beyond ``max_ranges`` the ranges with the smallest gaps between them are joined: more is read, nothing lost.

Defined results: features meet a box if they share a point, edges included. Features with a null bound meet none, and
are stored with a null key. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ORDER = 16
Box = tuple[float, float, float, float]


def _cell(value: Column, low: float, high: float) -> Column:
    top = (1 << ORDER) - 1
    scaled = F.floor((value - low) / (high - low) * float(top + 1)).cast("bigint")
    return F.when(value.isNotNull(), F.least(F.greatest(scaled, F.lit(0)), F.lit(top)).cast("bigint"))


def hilbert_key(x: Column, y: Column, extent: Box) -> Column:
    """Place of a point on the curve: one step per bit, turned as the quadrant asks for."""
    xmin, ymin, xmax, ymax = extent
    start = F.struct(_cell(x, xmin, xmax).alias("x"), _cell(y, ymin, ymax).alias("y"), F.lit(0).cast("bigint").alias("d"))

    def step(at: Column, bit: Column) -> Column:
        size = F.lit(1).cast("bigint")
        half = F.call_function("shiftleft", size, bit)
        u = F.call_function("shiftright", at["x"], bit).bitwiseAND(1)
        v = F.call_function("shiftright", at["y"], bit).bitwiseAND(1)
        a, b = at["x"].bitwiseAND(half - 1), at["y"].bitwiseAND(half - 1)
        flip = (u == 1) & (v == 0)
        a2, b2 = F.when(flip, half - 1 - a).otherwise(a), F.when(flip, half - 1 - b).otherwise(b)
        return F.struct(
            F.when(v == 0, b2).otherwise(a2).alias("x"), F.when(v == 0, a2).otherwise(b2).alias("y"),
            (at["d"] * 4 + (u * 3).bitwiseXOR(v)).alias("d"),
        )

    bits = F.array(*[F.lit(k) for k in range(ORDER - 1, -1, -1)])
    return F.when(x.isNotNull() & y.isNotNull(), F.aggregate(bits, start, step)["d"])


def key_ranges(box: Box, extent: Box, max_ranges: int = 64) -> list[tuple[int, int]]:
    """Ranges of keys, both ends included, that hold every cell which the box meets.

    Quadrants are divided from the top while they lie partly inside; a level further down is gone to only while the ranges
    found are at most four times ``max_ranges``.
    """
    xmin, ymin, xmax, ymax = extent
    top = 1 << ORDER

    def cell(v: float, low: float, high: float) -> int:
        return min(max(int((v - low) // ((high - low) / top)), 0), top - 1)

    # one cell more on every side: rounding differs between here and the stored keys
    x0, x1 = max(cell(box[0], xmin, xmax) - 1, 0), min(cell(box[2], xmin, xmax) + 1, top - 1)
    y0, y1 = max(cell(box[1], ymin, ymax) - 1, 0), min(cell(box[3], ymin, ymax) + 1, top - 1)
    if box[0] > box[2] or box[1] > box[3]:
        return []
    inside: list[tuple[int, int]] = []
    # a quadrant: its corner, its first axis and its second axis as they lie on the grid, its first key
    open_ = [((0, 0), (1, 0), (0, 1), 0)]
    size = top
    while open_ and size >= 1:
        after = []
        for corner, a, b, key in open_:
            far = (corner[0] + (a[0] + b[0]) * (size - 1), corner[1] + (a[1] + b[1]) * (size - 1))
            lx, hx, ly, hy = min(corner[0], far[0]), max(corner[0], far[0]), min(corner[1], far[1]), max(corner[1], far[1])
            if hx < x0 or lx > x1 or hy < y0 or ly > y1:
                continue
            if x0 <= lx and hx <= x1 and y0 <= ly and hy <= y1:
                inside.append((key, key + size * size - 1))
                continue
            after.append((corner, a, b, key))
        if not after or size == 1 or len(after) + len(inside) > 4 * max_ranges:
            inside += [(key, key + size * size - 1) for *_, key in after]
            break
        half = size // 2
        open_ = [q for corner, a, b, key in after for q in _quadrants(corner, a, b, key, half)]
        size = half
    joined: list[list[int]] = []
    for low, high in sorted(inside):
        if joined and low <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    while len(joined) > max_ranges:
        k = min(range(1, len(joined)), key=lambda i: joined[i][0] - joined[i - 1][1])
        joined[k - 1][1] = joined.pop(k)[1]
    return [(low, high) for low, high in joined]


def _quadrants(corner, a, b, key: int, half: int):
    """The four parts in the curve's order: the first and last turned, the middle two as the whole."""
    def at(i: int, j: int, di: int = 0, dj: int = 0):
        u, v = i * half + di, j * half + dj
        return corner[0] + a[0] * u + b[0] * v, corner[1] + a[1] * u + b[1] * v

    back = lambda v: (-v[0], -v[1])
    area = half * half
    return [
        (at(0, 0), b, a, key), (at(0, 1), a, b, key + area), (at(1, 1), a, b, key + 2 * area),
        (at(1, 0, half - 1, half - 1), back(b), back(a), key + 3 * area),
    ]


def write_along_curve(features: DataFrame, out: str, extent: Box, tie_breaker: str) -> None:
    """Store features ``(xmin, ymin, xmax, ymax, …)`` with their ``key``, and what box reads must know of them.

    The tie breaker takes part in the range split, so features piled on one point can be divided.
    """
    x, y = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    keyed = features.withColumn("key", hilbert_key(x, y, extent))
    seen = Observation()
    keyed.repartitionByRange("key", tie_breaker).sortWithinPartitions("key", tie_breaker).observe(
        seen, F.max((F.col("xmax") - F.col("xmin")) / 2).alias("dx"), F.max((F.col("ymax") - F.col("ymin")) / 2).alias("dy"),
    ).write.mode("overwrite").parquet(f"{out}/features")
    half = [float(v or 0) for v in (seen.get["dx"], seen.get["dy"])]
    names = "xmin double, ymin double, xmax double, ymax double, dx double, dy double"
    features.sparkSession.createDataFrame([(*map(float, extent), *half)], names).write.mode("overwrite").parquet(f"{out}/about")


def read_box(spark: SparkSession, path: str, box: Box, max_ranges: int = 64) -> DataFrame:
    """Features that meet ``box``, read by ranges of the curve."""
    about = spark.read.parquet(f"{path}/about").first()
    extent = (about.xmin, about.ymin, about.xmax, about.ymax)
    wide = (box[0] - about.dx, box[1] - about.dy, box[2] + about.dx, box[3] + about.dy)
    stored = spark.read.parquet(f"{path}/features")
    near = [F.col("key").between(low, high) for low, high in key_ranges(wide, extent, max_ranges)]
    here = reduce(lambda p, q: p | q, near) if near else F.lit(False)
    exact = (F.col("xmin") <= box[2]) & (F.col("xmax") >= box[0]) & (F.col("ymin") <= box[3]) & (F.col("ymax") >= box[1])
    return stored.filter(here & exact).drop("key")
