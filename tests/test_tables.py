import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basinflow.functions import names
from basinflow.functions import timestamps as TS
from basinflow.functions.gridindex import IndexBounds
from basinflow.operators import closure, joins, network, ordering, timebins, weights, zonal
from basinflow.operators import pyramid as PY
from basinflow.operators.catchments import configure_catchments
from basinflow.operators.cells import explode_cells
from basinflow.operators.cluster import clustered, with_zorder
from basinflow.operators.metadata import (
    describe_cells, describe_chunks, describe_table, metadata_documents,
)
from support import rows
from test_cells import blocks

T0 = datetime(2010, 1, 1)


# -- time ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("hours, step, want", [
    (9, 3, [(0, 2), (3, 5), (6, 8), (9, 9)]),
    (24, 10, [(0, 9), (10, 19), (20, 24)]),
    (0, 5, [(0, 0)]),
])
def test_time_bins(spark, hours, step, want):
    span = spark.createDataFrame(
        [(T0, T0 + timedelta(hours=hours))], "start timestamp_ntz, end timestamp_ntz"
    )
    got = timebins.time_bins(span, step).orderBy("bin").collect()
    assert [
        ((r.bin_start - T0).total_seconds() / 3600, (r.bin_end - T0).total_seconds() / 3600)
        for r in got
    ] == want


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 80), st.integers(1, 30))
def test_bins_hold_each_hour_once(spark, hours, step):
    end = T0 + timedelta(hours=hours)
    span = spark.createDataFrame([(T0, end)], "start timestamp_ntz, end timestamp_ntz")
    bins = timebins.time_bins(span, step).collect()
    seen = []
    for b in bins:
        n = int((b.bin_end - b.bin_start).total_seconds() // 3600) + 1
        seen += [(b.bin, b.bin_start + timedelta(hours=k)) for k in range(n)]
    assert sorted(t for _, t in seen) == [T0 + timedelta(hours=h) for h in range(hours + 1)]
    df = spark.createDataFrame([(t,) for _, t in seen], "time timestamp_ntz")
    assigned = timebins.assign_bins(df, TS.ntz(T0), TS.ntz(end), step)
    assert rows(assigned, "bin", "time") == sorted(seen)


def test_group_status(spark):
    span = spark.createDataFrame(
        [(T0, T0 + timedelta(hours=5))], "start timestamp_ntz, end timestamp_ntz"
    )
    bins = timebins.time_bins(span, 3)
    times = [T0 + timedelta(hours=h) for h in (0, 1, 1, 2, 4)]
    written = timebins.assign_bins(
        spark.createDataFrame([(t,) for t in times], "time timestamp_ntz"),
        TS.ntz(T0), TS.ntz(T0 + timedelta(hours=5)), 3,
    )
    status = timebins.group_status(bins, written)
    assert rows(status, "bin", "expected", "written", "ok") == [(0, 3, 3, True), (1, 3, 1, False)]
    with pytest.raises(RuntimeError, match=r"\[1\]"):
        timebins.require_complete(status)


@pytest.mark.parametrize("limit", [10**8, -1])
def test_batch_windows_overlap(spark, broadcasts, limit):
    broadcasts(limit)
    df = spark.createDataFrame([(T0 + timedelta(hours=h),) for h in range(72)], "time timestamp_ntz")
    w = [("a", T0, T0 + timedelta(hours=47)), ("b", T0 + timedelta(hours=40), T0 + timedelta(hours=50))]
    win = spark.createDataFrame(w, "window_id string, start timestamp_ntz, end timestamp_ntz")
    got = timebins.batch_windows(df, win).groupBy("window_id").count()
    assert rows(got) == [("a", 48), ("b", 11)]


def test_timestamps(spark):
    ts = F.lit("2010-03-14 02:30:15.5").cast("timestamp_ntz")
    got = spark.range(1).select(
        TS.stamp(ts).alias("a"), TS.stamp(ts, minutes=False).alias("b"), TS.hour_of(ts).alias("c"),
        TS.parse_stamp(F.lit("2010031402")).alias("d"), TS.parse_stamp(F.lit("x")).alias("e"),
        TS.from_epoch_ns(F.lit(1262304000123456789).cast("bigint")).alias("f"),
    ).first()
    assert (got.a, got.b) == ("201003140230", "2010031402")
    assert got.c == got.d == datetime(2010, 3, 14, 2) and got.e is None
    assert got.f == datetime(2010, 1, 1, 0, 0, 0, 123456)


def test_names(spark):
    p = F.lit("bucket/a/2010/x.y.z")
    got = spark.range(1).select(
        names.basename(p), names.first_stem(p), names.last_stem(p), names.joined_stem(p),
        names.bucket_url(p), names.last_stem(F.lit("a/nodot")),
    ).first()
    assert tuple(got) == (
        "x.y.z", "x", "x.y", "xy", "https://bucket.s3.amazonaws.com/a/2010/x.y.z", "",
    )


# -- weights ---------------------------------------------------------------------------------------

WTS = [
    (5, 5, 1, 0.5, 0.1), (6, 5, 1, 0.5, 0.2),            # whole
    (6, 6, 2, 0.7, 0.3), (99, 6, 2, 0.3, 0.4),           # partly outside
    (5, 6, 3, 0.6, 0.5), (5, 7, 3, 0.4, 0.6),            # whole, not kept
]
BOX = IndexBounds(5, 10, 5, 10)


def test_weights(spark):
    w = spark.createDataFrame(WTS, "i_index int, j_index int, IDmask long, weight double, regridweight double")
    polys = spark.createDataFrame([(1, 9), (2, 9), (3, 9), (4, 9)], "polyid long, overlaps int")
    assert rows(weights.full_basins(w, BOX), "IDmask") == [(1,), (3,)]
    keep = spark.createDataFrame([(1,), (2,), (2,), (4,)], "IDmask long")
    rect, counted = weights.subset_weights(w, polys, keep, BOX)
    assert rows(rect) == [(1, 1, 1, 0.5, 0.1), (2, 1, 1, 0.5, 0.2), (2, 2, 2, 1.0, 0.3)]
    assert rows(counted, "polyid", "overlaps") == [(1, 2), (2, 1), (4, 0)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 12), st.integers(1, 4),
                          st.floats(0.01, 1)), min_size=1, max_size=40))
def test_renormalised_weights_sum_to_one(spark, data):
    w = spark.createDataFrame(
        [(*d, 0.0) for d in data],
        "i_index int, j_index int, IDmask long, weight double, regridweight double",
    )
    polys = spark.createDataFrame([(k, 0) for k in range(1, 5)], "polyid long, overlaps int")
    keep = w.select("IDmask").distinct()
    rect, _ = weights.subset_weights(w, polys, keep, BOX)
    for r in rect.groupBy("IDmask").agg(F.sum("weight").alias("s")).collect():
        assert abs(r.s - 1) < 1e-9


# -- ordering --------------------------------------------------------------------------------------

@pytest.mark.parametrize("ranges", ["1", "7"])
def test_ranks_and_numbers(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_ranks(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def check_ranks(spark):
    r = random.Random(4)
    vals = [None, None, *[7] * 200, *[r.randint(0, 300) for _ in range(300)]]  # one hot value
    df = spark.createDataFrame(list(enumerate(vals)), "id int, v int")
    got = {x.id: x.rank for x in ordering.average_rank(df, "v", "rank").collect()}
    ordered = sorted(v for v in vals if v is not None)
    for k, v in enumerate(vals):
        if v is None:
            assert got[k] is None
        else:
            assert got[k] == ordered.index(v) + (ordered.count(v) - 1) / 2
    numbered = ordering.sequential_id(df.withColumn("key", F.col("id") * 3 - 500), "key", "n")
    assert rows(numbered, "id", "n") == [(k, k + 1) for k in range(len(vals))]


def test_average_rank_example(spark):
    df = spark.createDataFrame([(1,), (5,), (5,), (9,)], "v int")
    assert rows(ordering.average_rank(df, "v", "rank"), "rank") == [(0.0,), (1.5,), (1.5,), (3.0,)]


# -- network ---------------------------------------------------------------------------------------

def brute_upstream(edges, starts):
    seen, todo = set(starts), list(starts)
    above = {}
    for a, b in edges:
        above.setdefault(b, []).append(a)
    while todo:
        for a in above.get(todo.pop(), []):
            if a not in seen:
                seen.add(a)
                todo.append(a)
    return seen


def random_tree(seed, n, cycle=False, chain=False):
    r = random.Random(seed)
    edges = [(1, 0)]
    for k in range(2, n + 1):
        edges.append((k, k - 1 if chain else r.randint(max(1, k - 6), k - 1)))
    if cycle:
        edges += [(n + 1, n + 2), (n + 2, n + 3), (n + 3, n + 1), (n + 4, n + 2), (n + 5, n + 5)]
    return edges


@pytest.mark.parametrize("edges, starts", [
    (random_tree(1, 30), [3, 17]),
    (random_tree(2, 40, chain=True), [30]),
    (random_tree(3, 40, cycle=True), [2, 41]),
    (random_tree(4, 40, cycle=True), [5, 1, 9]),
    (random_tree(5, 10), [999]),
])
def test_closure(spark, edges, starts):
    links = spark.createDataFrame(edges, "link long, to long")
    s = spark.createDataFrame([(k,) for k in starts], "link long")
    proper = [(a, b) for a, b in edges if b]
    want = brute_upstream(proper, starts)
    labelled = closure.first_start_below(links, s)
    got = {r.link: r.first_start for r in labelled.collect()}
    assert set(got) == want
    down = dict(proper)
    for link, first in got.items():
        at = link
        while at not in starts:
            at = down[at]
        assert at == first
    again = closure.upstream(links, closure.upstream(links, s))
    assert {r.link for r in again.collect()} == want
    reach = set()
    for k in starts:
        at = k
        while at in dict(edges) and at not in reach:
            reach.add(at)
            at = down.get(at)
    assert {r.link for r in closure.downstream(links, s).collect()} == reach


def test_long_chain(spark):
    n = 3000
    links = spark.range(1, n + 1).select(F.col("id").alias("link"), (F.col("id") - 1).alias("to"))
    s = spark.createDataFrame([(10,)], "link long")
    assert closure.upstream(links, s).count() == n - 9
    assert closure.downstream(links, spark.createDataFrame([(n,)], "link long")).count() == n


@pytest.mark.parametrize("edges, starts", [
    ([(1, 3), (1, 4), (2, 4), (3, 5), (4, 5), (5, 3)], [3]),
    ([e for e in random_tree(3, 20, cycle=True) if e[1]], [2, 21]),
])
def test_closure_where_flow_divides(spark, edges, starts):
    df = spark.createDataFrame(edges, "link long, to long")
    s = spark.createDataFrame([(k,) for k in starts], "link long")
    got = [r.link for r in closure.upstream_any(df, s).collect()]
    assert set(got) == brute_upstream(edges, starts) and len(got) == len(set(got))
    with pytest.raises(RuntimeError):
        closure.upstream_any(df, s, max_rounds=1)


LINK_SCHEMA = "link long, to long, lon double, lat double, gages string, ascendingIndex int, NHDWaterbodyComID long"


def test_links_and_buckets(spark):
    links = spark.createDataFrame([
        (1, 0, 0.0, 0.0, "", 9, 0), (2, 1, 5.0, 5.0, "", 5, 0), (3, 2, 6.0, 6.0, "", 5, 0),
        (4, 99, 5.0, 5.5, "", 1, 0), (5, None, 50.0, 5.0, "", 7, 0),
    ], LINK_SCHEMA)
    env = spark.createDataFrame([(4.0, 7.0, 4.0, 7.0)], "lon_min double, lon_max double, lat_min double, lat_max double")
    inside = network.links_in_envelope(links, env)
    assert rows(inside) == [(2,), (3,), (4,)]
    basins = spark.createDataFrame([(5,), (2,), (77,)], "IDmask long")
    sub = network.subset_links(links, network.kept_ids(basins, inside))
    assert rows(sub, "link", "to", "ascendingIndex") == [
        (2, 0, 1.5), (3, 2, 1.5), (4, 0, 0.0), (5, 0, 3.0)
    ]
    ids = {r.link for r in sub.collect()} | {0}
    assert all(r.to in ids for r in sub.collect())
    buckets = spark.createDataFrame([(5, 1, 10), (9, 2, 20), (2, 3, 30)], "ComID long, Basin int, ind long")
    assert rows(network.subset_buckets(buckets, basins), "ComID", "Basin") == [(2, 2), (5, 1)]


def test_lakes(spark):
    # 1 <- 2 <- 3 <- 4 and 2 <- 5; 6 <- 7: lake 10 lets out at 2, 20 at 3, 30 at 6, 40 nowhere
    full = spark.createDataFrame([
        (1, 0, 0, 0), (2, 1, 10, 1), (3, 2, 20, 1), (4, 3, 20, 1), (5, 2, 0, 1), (6, 0, 30, 1),
        (7, 6, 40, 0),
    ], "link long, to long, NHDWaterbodyComID long, keep int")
    types = spark.createDataFrame([(2, 1), (3, 1), (6, 1), (4, 2)], "LINKID long, TYPEL int")
    lakes = spark.createDataFrame([(10, 4), (20, 8), (30, 6), (40, 1)], "lake_id long, ascendingIndex int")
    # without 5 lake 10 loses part of its area, lake 20 does not; 7 is above the outlet of 30
    sub = full.filter("link IN (1, 2, 3, 4, 6)")
    kept, links = network.retain_lakes(lakes, types, sub, full)
    assert rows(kept, "lake_id", "ascendingIndex") == [(20, 0.0)]
    assert rows(links, "link", "NHDWaterbodyComID") == [(1, 0), (2, -9999), (3, 20), (4, 20), (6, -9999)]
    kept, links = network.retain_lakes(lakes, types, full, full)
    assert rows(kept, "lake_id") == [(10,), (20,), (30,), (40,)]


def test_stations(spark):
    links = spark.createDataFrame([(1, "   07"), (2, "     "), (3, "   07")], "link long, gages string")
    st_ = spark.createDataFrame(
        [("     07", [1.0], [[2.0]]), ("08", [3.0], [[4.0]]), ("    ", [0.0], [[0.0]])],
        "stationId string, qThresh array<double>, expCoeff array<array<double>>",
    )
    got = network.subset_stations(st_, links).collect()
    assert [(r.qThresh, r.expCoeff) for r in got] == [([1.0], [[2.0]])]


def test_hydrofabric(spark):
    edges = spark.createDataFrame(
        [("wb-1", "nex-0"), ("wb-2", "nex-1"), ("nex-1", "wb-1"), ("wb-3", "nex-9"), ("nex-9", "wb-9")],
        "id string, toid string",
    )
    cats = spark.createDataFrame([("cat-1",), ("cat-2",), ("cat-3",)], "divide_id string")
    got = network.subset_hydrofabric({"edges": edges, "attrs": cats}, edges, "wb-1")
    assert rows(got["edges"], "id") == [("nex-1",), ("wb-1",), ("wb-2",)]
    assert rows(got["attrs"]) == [("cat-1",), ("cat-2",)]


# -- zones, overviews, descriptions ------------------------------------------------------------------

@pytest.mark.parametrize("limit", [10**8, -1])
def test_zonal_mean(spark, broadcasts, limit):
    broadcasts(limit)
    zones = spark.createDataFrame(
        [(1, 2, 2, 1.0), (1, 7, 10, 3.0), (2, 4, 4, 0.5), (3, 50, 50, 1.0)],
        "id long, j int, i int, w double",
    )
    grid = blocks(spark, hours=2)
    want = [(1, (202.0 + 3 * 710.0) / 4, 2), (2, 404.0, 1)] * 2
    by_cell = zonal.zonal_mean(explode_cells(grid), zones)
    by_block = zonal.zonal_mean_chunks(grid, zones, (3, 4))
    for means in (by_cell, by_block):
        assert rows(means, "id", "mean", "n_cells") == sorted(want)


@pytest.mark.parametrize("method", ["nearest", "mean"])
def test_pyramid(spark, method):
    grid = explode_cells(blocks(spark, nrow=7, ncol=10))
    levels = PY.overview_levels(*PY.grid_shape(grid), tile=3)
    assert levels == 2
    tiles = PY.build_pyramid(grid, levels, 3, method)
    value = {(j, i): 100.0 * (j + 1) + i + 1 for j in range(7) for i in range(10)}
    for level in range(levels + 1):
        f = 2**level
        want = {}
        for (j, i), v in value.items():
            want.setdefault((j // f, i // f), []).append(v)
        got = {(r.row, r.col): r for r in tiles.filter(F.col("level") == level).collect()}
        assert set(got) == set(want)
        for k, vs in want.items():
            assert got[k].value == pytest.approx(vs[0] if method == "nearest" else sum(vs) / len(vs))
            assert (got[k].tile_row, got[k].tile_col) == (k[0] // 3, k[1] // 3)
    assert {r.level for r in PY.read_overview(tiles).collect()} == {2}
    assert {r.level for r in PY.read_overview(tiles, 1).collect()} == {1}
    assert PY.decimated_shape(7, 10, 4) == (1, 2)


def test_zorder(spark):
    boxes = spark.createDataFrame(
        [(k, float(k % 4), float(k // 4), float(k % 4), float(k // 4)) for k in range(16)],
        "id int, xmin double, ymin double, xmax double, ymax double",
    )
    z = {r.id: r.z for r in with_zorder(boxes, (0.0, 0.0, 4.0, 4.0)).collect()}
    assert [k for k, _ in sorted(z.items(), key=lambda p: p[1])] == [
        0, 1, 4, 5, 2, 3, 6, 7, 8, 9, 12, 13, 10, 11, 14, 15
    ]
    assert clustered(boxes, (0.0, 0.0, 4.0, 4.0), "id").count() == 16


def test_descriptions(spark):
    grid = blocks(spark, hours=3)
    a = rows(describe_cells(explode_cells(grid), "d"))
    assert a == rows(describe_chunks(grid, "d"))
    assert a[0][:9] == ("d", "v", 210, 101.0, 710.0, 1, 7, 1, 10)
    wide = spark.createDataFrame([(1, 2.0), (3, None)], "p int, q double")
    assert rows(describe_table(wide, "t", ["p", "q"])) == [
        ("t", "p", 2, 1.0, 3.0), ("t", "q", 1, 2.0, 2.0)
    ]
    docs = metadata_documents(describe_table(wide, "t", ["p"])).first()
    assert docs.document == '{"dataset":"t","variable":"p","n":2,"value_min":1.0,"value_max":3.0}'


def test_catchments(spark):
    cats = spark.createDataFrame([(1,), (2,)], "id long")
    attrs = spark.createDataFrame([(1, "x")], "id long, kind string")
    forcing = spark.createDataFrame([(1, T0, "v", 1.0), (7, T0, "v", 2.0)], "id long, time timestamp_ntz, var string, mean double")
    config, inputs = configure_catchments(cats, attrs, forcing)
    assert rows(config, "id", "n_steps", "config_name") == [(1, 1, "cat-1"), (2, 0, "cat-2")]
    assert rows(inputs, "id") == [(1,)]


def test_lookup_join_refuses_side_rows(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        joins.lookup_join(df, df, ["a"], "full")


@pytest.mark.parametrize("how, want", [("inner", 400), ("left", 401), ("left_semi", 400), ("left_anti", 1)])
@pytest.mark.parametrize("limit", [10**8, -1])
def test_lookup_join_on_a_hot_key(spark, broadcasts, how, want, limit):
    broadcasts(limit)
    large = spark.range(400).select(F.lit(1).alias("k"), "id").union(
        spark.createDataFrame([(2, 900)], "k int, id long")
    )
    side = spark.createDataFrame([(1, "a"), (3, "b")], "k int, name string")
    got = joins.lookup_join(large, side, ["k"], how)
    assert got.count() == want
    assert got.columns == (["k", "id", "name"] if how in ("inner", "left") else ["k", "id"])


def test_ids_of_any_length_and_repeated_edges(spark):
    long = "wb-" + "9" * 60
    edges = [(long, "nex-1"), ("nex-1", "wb-1"), ("wb-1", "nex-0")] * 3
    edges = spark.createDataFrame(edges, "id string, toid string")
    cats = spark.createDataFrame([("cat-" + "9" * 60,), ("cat-1",), ("cat-2",)], "divide_id string")
    got = network.subset_hydrofabric({"attrs": cats}, edges, "wb-1")
    assert rows(got["attrs"]) == [("cat-1",), ("cat-" + "9" * 60,)]


def test_closures_of_repeated_and_dividing_links(spark):
    chain = [(i, i - 1) for i in range(1, 41)] * 2
    links = spark.createDataFrame(chain, "link long, to long")
    start = spark.createDataFrame([(20,)], "link long")
    assert closure.upstream(links, start).count() == 21
    assert closure.first_start_below(links, start).count() == 21
    assert closure.downstream(links, start).count() == 20
    split = spark.createDataFrame([*chain, (30, 5), (5, 99)], "link long, to long")
    with pytest.raises(ValueError):
        closure.first_start_below(split, start)
    below = spark.createDataFrame([(30,)], "link long")
    assert {r.link for r in closure.downstream(split, below).collect()} == set(range(1, 31))
    assert {r.link for r in closure.upstream(split, spark.createDataFrame([(5,)], "link long")).collect()} == set(range(5, 41))


def test_plain_numbers(spark):
    from basinflow.functions.gridindex import plain_number

    values = [0.0083333333333, 1e-10, 1e20, -1.5e-7, 250.0, 1234567.25, -12345678.0, 123456789.125, 0.0, 1e7]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(plain_number(F.col("v"))).collect()]
    assert [float(x) for x in got] == values and not any("E" in x for x in got)
    assert got[:5] == ["0.0083333333333", "0.0000000001", "100000000000000000000", "-0.00000015", "250"]


def test_weights_round_trip(spark, tmp_path):
    from basinflow.sources import sinks, tables

    w = spark.createDataFrame(WTS, "i_index int, j_index int, IDmask long, weight double, regridweight double")
    polys = spark.createDataFrame([(1, 9)], "polyid long, overlaps int")
    rect, counted = weights.subset_weights(w, polys, spark.createDataFrame([(1,)], "IDmask long"), BOX)
    sinks.write_weights(rect, counted, str(tmp_path))
    a, b = tables.read_weights(spark, str(tmp_path))
    assert a.count() == 2 and rows(b) == [(1, 2)]


def test_steps_count_times(spark):
    forcing = spark.createDataFrame([(1, T0, "a", 1.0), (1, T0, "b", 1.0)], "id long, time timestamp_ntz, var string, mean double")
    config, _ = configure_catchments(forcing.select("id"), forcing.select("id").distinct(), forcing)
    assert rows(config, "id", "n_steps") == [(1, 1)]
