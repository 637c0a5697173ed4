"""Blocks and weights stored by block origin: no exchange in front of the join, days pruned, hours added."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from support import plan_of, rows

from basinflow import schemas
from basinflow.operators.zonal import zonal_mean_chunks, zonal_mean_placed
from basinflow.session import scratch_path
from basinflow.sources import layout

T0 = datetime(2024, 1, 1)


def blocks(spark, hours):
    """Blocks of 3 by 4 over a grid of 7 by 10, smaller at its edges, some cells without value."""
    out = []
    for h in hours:
        for y0 in range(1, 8, 3):
            for x0 in range(1, 11, 4):
                ny, nx = min(3, 8 - y0), min(4, 11 - x0)
                data = [None if (h + y0 + k) % 5 == 0 else float(h * 100 + y0 * 10 + x0 + k) for k in range(ny * nx)]
                out.append(("a", T0 + timedelta(hours=h), y0, x0, ny, nx, data))
    return spark.createDataFrame(out, schemas.CHUNKS)


@pytest.fixture
def stored(spark):
    folder = scratch_path(spark, "layout")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    zones = spark.createDataFrame(
        [(k % 3, k % 7 + 1, k % 10 + 1, 0.5 + k % 4) for k in range(70)] + [(9, 50, 50, 1.0)], "id long, j int, i int, w double")
    layout.store_zones(zones, (3, 4), name, folder, 4)
    layout.add_blocks(blocks(spark, range(0, 30)), name, folder, 4)
    layout.add_blocks(blocks(spark, range(30, 60)), name, folder, 4)
    yield name, zones, folder
    spark.sql(f"DROP TABLE {name}_blocks")
    spark.sql(f"DROP TABLE {name}_zones")


@pytest.mark.parametrize("first, last", [(0, 59), (3, 20), (24, 47), (28, 33), (70, 80)])
def test_means_of_a_period(spark, stored, first, last):
    name, zones, _ = stored
    ends = [T0 + timedelta(hours=h) for h in (first, last)]
    got = zonal_mean_placed(*layout.stored_period(spark, name, *ends))
    plain = zonal_mean_chunks(blocks(spark, range(first, min(last, 59) + 1)), zones, (3, 4))
    cols = ("id", "time", "var", F.round("mean", 9), "n_cells")
    assert rows(got, *cols) == rows(plain, *cols)
    assert got.isEmpty() == (first > 59)


def test_no_exchange_before_the_join(spark, stored):
    name, _, _ = stored
    got = zonal_mean_placed(*layout.stored_period(spark, name, T0 + timedelta(hours=25), T0 + timedelta(hours=40)))
    plan = plan_of(got)
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    assert plan.split("Arguments: hashpartitioning(")[1:] and all(
        part.startswith("id#") for part in plan.split("Arguments: hashpartitioning(")[1:])
    assert plan.count("Bucketed: true") == 2 and "PartitionFilters: [isnotnull(day" in plan
    read = [f for f in spark.table(f"{name}_blocks").filter(F.col("day") == F.lit(T0.date())).inputFiles()]
    assert read and all("day=2024-01-0" in f for f in read)


def test_other_bucket_number_is_refused(spark, stored):
    name, _, folder = stored
    with pytest.raises(Exception, match="(?i)bucket"):
        layout.add_blocks(blocks(spark, [99]), name, folder, 8)
