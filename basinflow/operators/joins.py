"""Joins of a large table with a side whose size is not known in advance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(
    large: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
) -> DataFrame:
    """Equi-join ``large`` with a ``side`` that is usually small.

    No side is measured beforehand and nothing is repeated: Spark broadcasts the side if what it has
    seen at run time fits ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits partitions that
    a frequent key makes large. ``how`` must not keep unmatched rows of the side.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"unsupported join type {how}")
    keys = list(on)
    match = F.lit(True) if condition is None else condition
    for k in keys:
        side = side.withColumnRenamed(k, f"_r_{k}")
        match = match & (F.col(k) == F.col(f"_r_{k}"))
    joined = large.join(side, match, how)
    return joined.drop(*[f"_r_{k}" for k in keys]) if how in {"inner", "left"} else joined
