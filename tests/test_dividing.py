"""Closures of networks whose flow divides."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basinflow.operators import closure

LINKS = 'link long, "to" long'.replace('"', "`")


def brute(edges, starts, down=False):
    found = set(starts)
    while True:
        new = {(b if down else a) for a, b in edges if (a if down else b) in found and a != b and b} - found
        if not new:
            return found
        found |= new


def frames(spark, edges, starts):
    return spark.createDataFrame(edges, LINKS), spark.createDataFrame([(s,) for s in starts], "link long")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 14), st.integers(0, 14)), min_size=1, max_size=30),
       st.lists(st.integers(1, 16), min_size=1, max_size=3))
def test_any_network(spark, edges, starts):
    links, some = frames(spark, edges, starts)
    got = [r.link for r in closure.upstream_dividing(links, some).collect()]
    assert sorted(got) == sorted(brute(edges, starts))


def islands(n):
    """A river of ``n`` islands: each link divides into two ways that meet again; side arms that end nowhere, a circle
    and a lone start."""
    edges = []
    for k in range(n):
        a = 10 * k + 10
        edges += [(a, a + 1), (a, a + 2), (a + 1, a + 10), (a + 2, a + 3), (a + 3, a + 10), (a + 4, a + 3)]
        edges += [(a + 5, a + 5 - 1), (a + 5, 10**6 + a)]
    return edges + [(5, 6), (6, 7), (7, 5), (8, 5), (8, 10)]


@pytest.mark.parametrize("depth", [670])
def test_two_thousand_levels_in_tens_of_jobs(spark, depth):
    edges = islands(depth)
    end = 10 * depth + 10
    links, some = frames(spark, edges, [end, 99])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("islands", "closure")
    try:
        got = {r.link for r in closure.upstream(links, some).collect()}
        jobs = len(tracker.getJobIdsForGroup("islands"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == brute(edges, [end, 99]) and {8, 10, 14, 15} <= got and not {5, 6, 7} & got
    assert jobs < 200  # level by level it takes five jobs for each of 2,000 levels


def test_both_ways_and_repeats(spark):
    edges = islands(4) * 2
    links, some = frames(spark, edges, [30, 30])
    assert {r.link for r in closure.upstream(links, some).collect()} == brute(edges, [30])
    found = {r.link for r in closure.downstream(links, some).collect()}
    assert found == brute(edges, [30], down=True) & {a for a, _ in edges}


def test_no_starts_or_links(spark):
    links, some = frames(spark, islands(2), [10])
    assert closure.upstream_dividing(links, some.limit(0)).count() == 0
    assert [r.link for r in closure.upstream_dividing(links.limit(0), some).collect()] == [10]
