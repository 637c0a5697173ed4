"""Status of time groups while their hours arrive."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from basinflow.functions.timestamps import hours_between, ntz
from basinflow.operators.timebins import bin_number
from basinflow.session import ship_package

HOUR_MS = 3_600_000
REPORT = "bin int, written long, ok boolean"
EPOCH = datetime(1970, 1, 1)


def _hours(time: datetime) -> int:
    return int((time - EPOCH).total_seconds() // 3600)


def report_groups(
    arrivals: DataFrame, start: datetime, end: datetime, step_hours: int, grace_hours: int
) -> DataFrame:
    """``bin, written, ok`` of each group of the hours from ``start`` to ``end``, reported once.

    ``arrivals`` is a stream with the hourly ``time``. Each group keeps the hours it has got. It is reported complete as
    soon as it has all, or incomplete once an hour later than its last one by more than ``grace_hours`` has
    arrived. Hours may come in any order within that grace, and more than once. A group keeps its state until that
    deadline, complete or not, so a repeated hour does not open it again; hours that come later than that are dropped
    by the watermark. A group that no hour of arrives has no state and no report.
    """
    ship_package(arrivals.sparkSession)
    first, last = _hours(start), _hours(end)

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number = int(key[0])
        begin = first + number * step_hours
        until = min(begin + step_hours - 1, last)
        hours, done = state.get if state.exists else ([], False)
        if state.hasTimedOut:
            state.remove()
            if not done:
                yield pd.DataFrame({"bin": [number], "written": [len(hours)], "ok": [False]})
            return
        held = set(hours)
        for part in parts:
            held.update(part["hour"].tolist())
        whole = len(held) == until - begin + 1
        if whole and not done:
            yield pd.DataFrame({"bin": [number], "written": [len(held)], "ok": [True]})
        state.update((sorted(held), whole))
        state.setTimeoutTimestamp(max(until * HOUR_MS, state.getCurrentWatermarkMs() + 1))

    hour = hours_between(ntz(EPOCH), F.col("time")).cast("long")
    timed = arrivals.select("time", hour.alias("hour"), F.timestamp_seconds(hour * 3600).alias("arrived"))
    # an hour as old as the watermark would be late: a second more lets it in
    dated = timed.withWatermark("arrived", f"{grace_hours} hours 1 second")
    # asked of the watermark's own column, so the filter stays behind it and later hours move the watermark on
    bounds = [F.timestamp_seconds(F.lit(h * 3600)) for h in (first, last)]
    inside = dated.filter(F.col("arrived").between(*bounds))
    return inside.withColumn("bin", bin_number(F.col("time"), ntz(start), step_hours)).select(
        "bin", "hour", "arrived"
    ).groupBy("bin").applyInPandasWithState(
        update, REPORT, "hours array<long>, done boolean", "append", GroupStateTimeout.EventTimeTimeout
    )


def stream_status(
    arrivals: DataFrame, start: datetime, end: datetime, step_hours: int, grace_hours: int, out: str, checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Append the reports to ``out``; state and progress survive a restart from the same ``checkpoint``."""
    writer = (
        report_groups(arrivals, start, end, step_hours, grace_hours)
        .writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def reported_status(bins: DataFrame, reports: DataFrame) -> DataFrame:
    """The reports in the form of ``group_status``: a group without a report has nothing written so far."""
    expected = hours_between(F.col("bin_start"), F.col("bin_end")) + 1
    return bins.join(reports, "bin", "left").select(
        "bin", "bin_start", "bin_end", expected.alias("expected"),
        F.coalesce("written", F.lit(0).cast("bigint")).alias("written"), F.coalesce("ok", F.lit(False)).alias("ok"),
    )
