"""Fixed-step time bins and windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.functions.timestamps import HOUR, hours, hours_between
from basinflow.operators.joins import lookup_join


def time_bins(spans: DataFrame, step_hours: int, keys: Sequence[str] = ()) -> DataFrame:
    """Groups ``(bin, bin_start, bin_end)`` of each span ``(start, end)``.

    Edges stand every ``step_hours`` from the start, plus the start and one hour past the end. A
    group runs from its edge to one hour before the next, both included, so each hour of the span
    is in exactly one group.
    """
    steps = F.sequence(F.col("start"), F.col("end"), hours(step_hours))
    past_end = F.col("end") + F.expr(HOUR)
    edges = F.array_sort(F.array_union(steps, F.array(F.col("start"), past_end)))
    spans = spans.select(*keys, edges.alias("_edges"))
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("_edges") - 1),
        lambda k: F.struct(
            F.element_at("_edges", k).alias("bin_start"),
            (F.element_at("_edges", k + 1) - F.expr(HOUR)).alias("bin_end"),
        ),
    )
    flat = spans.select(*keys, F.posexplode(pairs).alias("bin", "_pair"))
    return flat.select(*keys, "bin", "_pair.bin_start", "_pair.bin_end")


def bin_number(time: Column, start: Column, step_hours: int) -> Column:
    """Number of the group an hourly instant falls in."""
    return F.call_function(
        "div", hours_between(start, time), F.lit(step_hours).cast("bigint")
    ).cast("int")


def assign_bins(df: DataFrame, start: Column, end: Column, step_hours: int) -> DataFrame:
    """Add ``bin`` to hourly rows; rows outside ``[start, end]`` are dropped. No join, no shuffle."""
    inside = F.col("time").between(start, end)
    return df.filter(inside).withColumn("bin", bin_number(F.col("time"), start, step_hours))


def group_status(bins: DataFrame, written: DataFrame) -> DataFrame:
    """``(bin, bin_start, bin_end, expected, written, ok)`` of each group.

    ``written(bin, time)`` are the rows a job produced. A group is complete when every hour of it is
    there.
    """
    # one row per hour first: groups are bounded by the number of hours in a bin
    hours_done = written.select("bin", "time").distinct().groupBy("bin").agg(
        F.count("*").alias("written")
    )
    expected = hours_between(F.col("bin_start"), F.col("bin_end")) + 1
    done = F.coalesce(F.col("written"), F.lit(0).cast("bigint"))
    return bins.join(hours_done, "bin", "left").select(
        "bin", "bin_start", "bin_end", expected.alias("expected"), done.alias("written"),
        (expected == done).alias("ok"),
    )


def require_complete(status: DataFrame) -> DataFrame:
    """Return the status, or fail naming incomplete groups."""
    bad = [r.bin for r in status.filter(~F.col("ok")).orderBy("bin").limit(20).collect()]
    if bad:
        raise RuntimeError(f"incomplete time groups (first 20): {bad}")
    return status


def batch_windows(df: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows of each window ``(window_id, start, end)``, both ends included.

    Windows are unfolded to the days they touch and met on the day, so this is an equi-join; a row
    in several windows appears once for each.
    """
    days = windows.select(
        "window_id", "start", "end",
        F.explode(F.sequence(
            F.col("start").cast("date"), F.col("end").cast("date"), F.expr("INTERVAL '1' DAY")
        )).alias("_day"),
    )
    dated = df.withColumn("_day", F.col("time").cast("date"))
    hit = lookup_join(
        dated, days, ["_day"], "inner", F.col("time").between(F.col("start"), F.col("end")),
    )
    return hit.drop("_day", "start", "end")
