"""Status of time groups from a stream, and repair of those that failed."""

import os
from datetime import datetime, timedelta

import pytest
from support import rows

from basinflow import schemas
from basinflow.functions.timestamps import ntz
from basinflow.operators import timebins as T
from basinflow.plans import jobs
from basinflow.plans import views as V
from basinflow.plans.queries_jobs import END, START, forcing_manifest, grid
from basinflow.sources.sinks import write_hourly
from basinflow.streaming.clip import stream_chunks
from basinflow.streaming.status import REPORT, reported_status, stream_status

BASE = datetime(2024, 5, 1)


def hour(k):
    return BASE + timedelta(hours=k)


def test_out_of_order_files_and_a_restart(spark, tmp_path):
    folder, out, log = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")
    schema = "time timestamp_ntz"
    kind = schemas.CHUNKS["time"].dataType
    span = spark.createDataFrame([(hour(0), hour(13))], "start timestamp_ntz, end timestamp_ntz")

    def arrive(*hours):
        spark.createDataFrame([(hour(k),) for k in hours], schema).coalesce(1).write.mode("append").parquet(folder)

    def run():
        source = stream_chunks(spark, folder, schemas.T.StructType([schemas.T.StructField("time", kind)]), files_per_trigger=1)
        stream_status(source, hour(0), hour(13), 4, 3, out, log, available_now=True).awaitTermination()
        return rows(spark.read.schema(REPORT).parquet(out))

    arrive(3, 1)
    arrive(5, 0, 0)
    assert run() == []
    arrive(2, 4)  # completes the first group, after a restart
    assert run() == [(0, 4, True)]
    arrive(2, 6)
    arrive(10, 9)
    arrive(16)  # 16 - 3 is past the end of groups 1 and 2
    got = run()
    assert got == [(0, 4, True), (1, 3, False), (2, 2, False)]
    arrive(7, 13)  # 7 comes too late, 13 does not
    arrive(40)
    assert run() == [*got, (3, 1, False)]
    written = spark.createDataFrame([(hour(k),) for k in (3, 1, 5, 0, 0, 2, 4, 2, 6, 10, 9, 13)], schema)
    bins = T.time_bins(span, 4)
    want = T.group_status(bins, T.assign_bins(written, ntz(hour(0)), ntz(hour(13)), 4))
    assert rows(reported_status(bins, spark.read.schema(REPORT).parquet(out))) == rows(want)


def test_groups_without_hours_are_not_ok(spark):
    span = spark.createDataFrame([(hour(0), hour(3))], "start timestamp_ntz, end timestamp_ntz")
    status = reported_status(T.time_bins(span, 2), spark.createDataFrame([(0, 2, True)], REPORT))
    assert rows(status, "bin", "written", "ok") == [(0, 2, True), (1, 0, False)]


def stamps(folder):
    found = {}
    for base, _, names in os.walk(folder):
        if "part=" in base:
            for n in names:
                if n.endswith(".parquet"):
                    found.setdefault(base.split("part=")[1][:10], set()).add((n, os.stat(os.path.join(base, n)).st_mtime_ns))
    return found


def test_only_failed_groups_are_written_again(spark, sf, tmp_path):
    out = str(tmp_path / "hourly")
    chunks = V.chunks(spark, sf)
    parts = {"manifest": forcing_manifest(spark, sf), "axes": V.axis_tables(spark, sf),
             "polygons": V.polygons(spark, sf), "grid": grid(spark, sf)}
    lost = chunks.filter("hour(time) NOT IN (15, 16)")
    write_hourly(jobs.forcing_hourly(chunks=lost, start=START, end=END, **parts), out)
    with pytest.raises(RuntimeError, match="incomplete"):
        jobs.repair_forcing_hourly(spark, out, START, END, chunks=lost, **parts)
    before = stamps(out)
    status = jobs.repair_forcing_hourly(spark, out, START, END, chunks=chunks, **parts)
    after = stamps(out)
    assert all(r.ok for r in status.collect())
    first = {f"20240101{h:02}" for h in range(3, 13)}
    assert {k: v for k, v in after.items() if k in first} == {k: v for k, v in before.items() if k in first}
    assert set(after) - set(before) == {"2024010115", "2024010116"}
    whole = jobs.forcing_hourly(chunks=chunks, start=START, end=END, **parts)
    columns = ["part", "j", "i", "x"]
    assert rows(spark.read.parquet(out), *columns) == rows(whole, *columns)
    again = stamps(out)
    jobs.repair_forcing_hourly(spark, out, START, END, chunks=chunks, **parts)
    assert stamps(out) == again  # nothing to do
