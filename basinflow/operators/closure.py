"""Reachability on drainage networks, where each link drains to at most one other.

Each link holds a pointer down the network. In every round the pointers are followed three times
over the same table, so the distance covered grows fourfold: a chain of n links takes about log4(n)
rounds. The joins are equi-joins of fixed-width rows whose right side is unique per key; a pointer
shared by most links only repeats on the left, where AQE splits it, and links whose way has ended are spread
over all tasks. Every round's state is written to the shared folder.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.session import Rounds, cut, scratch_path


def _pointers(links: DataFrame) -> DataFrame:
    """``(link, jump)``, one row per link however often it is stored; sinks, sentinels and self loops have
    no pointer. ``ways`` counts the different links that a link drains to."""
    to = F.col("to")
    # compared as text: ids are numbers in river tables and text in hydrofabrics
    known = F.when((to.cast("string") != "0") & (to != F.col("link")), to)
    return links.select("link", known.alias("jump")).groupBy("link").agg(
        F.max("jump").alias("jump"), F.count_distinct("jump").alias("ways")
    )


def _single(links: DataFrame) -> tuple[DataFrame, bool]:
    """The pointers, written once, and whether no link divides."""
    pointers = cut(_pointers(links), "pointers")
    return pointers.drop("ways"), pointers.filter("ways > 1").isEmpty()


# Lookups per round.
HOPS = 3

# Keys that links without a pointer are dealt to.
SPREAD = 1024


def _rounds(n: int) -> int:
    """Rounds after which every chain of ``n`` links has been walked."""
    return math.ceil(math.log(max(n, 2), HOPS + 1)) + 1


def _looked_up(rows: DataFrame, here: str, ahead: DataFrame) -> DataFrame:
    """``rows`` next to ``ahead(_at, ...)`` where ``here`` is ``_at``; others keep their place.

    Rows whose way has ended have no pointer. As one key they would all meet in one task, so a second key is
    taken from the pointer or else from the link. A fixed one would be folded into a filter.
    """

    def second(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(SPREAD)).cast("int")

    keyed = rows.withColumn("_k", F.when(F.col(here).isNull(), second(F.col("link"))).otherwise(second(F.col(here))))
    met = (F.col(here) == F.col("_at")) & (F.col("_k") == F.col("_k_at"))
    return keyed.join(ahead.withColumn("_k_at", second(F.col("_at"))), met, "left").drop("_k", "_k_at", "_at")


def first_start_below(links: DataFrame, starts: DataFrame) -> DataFrame:
    """``(link, first_start)`` of every link that drains to a start.

    ``first_start`` is the first member of ``starts(link)`` met on the way down, the link itself
    included. One row per link whatever the number of starts: the links above a start are those
    labelled with it or with a start above it. Rows that repeat a link count once; a link that drains to
    two others has no single way down and is an error.
    """
    pointers, single = _single(links)
    if not single:
        raise ValueError("a link drains to several others")
    return _first_start_below(pointers, starts)


def _first_start_below(pointers: DataFrame, starts: DataFrame) -> DataFrame:
    marked = starts.select("link", F.col("link").alias("hit")).distinct()
    # a start that is only ever drained into has no row of its own
    lone = marked.join(pointers, "link", "left_anti").select("link", F.col("hit").alias("jump"))
    rounds = Rounds(pointers.sparkSession, "ways-down")
    state = rounds.put(
        pointers.unionByName(lone).join(marked, "link", "left")
        .select("link", "hit", F.when(F.col("hit").isNull(), F.col("jump")).alias("jump"))
    )
    for _ in range(_rounds(state.count())):
        moved = state.filter("jump IS NOT NULL")
        if moved.isEmpty():
            break
        ahead = state.select(
            F.col("link").alias("_at"), F.col("hit").alias("_hit"), F.col("jump").alias("_jump")
        )
        for _ in range(HOPS):
            # a link that has met a start has no pointer left and passes through unmatched
            moved = _looked_up(moved, "jump", ahead).select(
                "link", F.coalesce("hit", "_hit").alias("hit"), F.col("_jump").alias("jump")
            )
        state = rounds.put(state.filter("jump IS NULL").unionByName(moved))
    # pointers left now can only run in circles that hold no start
    return state.filter("hit IS NOT NULL").select("link", F.col("hit").alias("first_start"))


def upstream(links: DataFrame, starts: DataFrame) -> DataFrame:
    """Links draining to any of ``starts(link)``, the starts included, as ``(link)``.

    Where links divide, their graph is contracted first (``upstream_dividing``).
    """
    pointers, single = _single(links)
    if single:
        return _first_start_below(pointers, starts).select("link")
    return upstream_dividing(links, starts)


def downstream(links: DataFrame, starts: DataFrame) -> DataFrame:
    """Links reached on the way down from any of ``starts(link)``, the starts included."""
    steps = ["_s1", "_s2", "_s3", "_s4"]
    pointers, single = _single(links)
    if not single:
        turned = links.select(F.col("to").alias("link"), F.col("link").alias("to")).distinct()
        found = upstream_dividing(turned, starts)
        return found.join(links.select("link").distinct(), "link", "left_semi")
    pointers = pointers.filter("jump IS NOT NULL")
    ways, found = Rounds(links.sparkSession, "paths"), Rounds(links.sparkSession, "reached")
    reached = found.put(starts.select("link").distinct())
    size = reached.count()
    while True:
        path = pointers.select("link", F.col("jump").alias(steps[0]))
        for here, there in zip(steps, steps[1:]):
            ahead = pointers.select(F.col("link").alias("_at"), F.col("jump").alias(there))
            path = _looked_up(path, here, ahead)
        path = ways.put(path)
        # the fourth step is the first of the next round
        visited = F.array_compact(F.array("link", *steps[:3]))
        reached = found.put(
            reached.join(path, "link", "left").select(F.explode(visited).alias("link")).distinct()
        )
        grown = reached.count()
        if grown == size:  # nothing new at this distance, so nothing further on either
            break
        size = grown
        pointers = path.filter(F.col(steps[3]).isNotNull()).select(
            "link", F.col(steps[3]).alias("jump")
        )
    return reached.join(links.select("link").distinct(), "link", "left_semi")


def _ways(edges: DataFrame) -> DataFrame:
    """``edges(link, to)`` with ``ways``, the number of different links that the link drains to."""
    return edges.join(edges.groupBy("link").agg(F.count("*").alias("ways")), "link")


def upstream_dividing(links: DataFrame, starts: DataFrame) -> DataFrame:
    """Upstream closure where a link may drain to several others, as ``(link)``.

    A link with one way down is above a start exactly if the next start or dividing link on its way is, so it is
    contracted to that one in a logarithmic number of rounds. What is left are dividing links and the ways between
    them. Ways that meet again, as around an island, have become one; so the links that now have one way are
    contracted too, until every link left divides. Only these are closed level by level. Then each contraction
    is undone: a link is in the closure if the one it was contracted to is. Jobs grow with the depth of what cannot be
    contracted, not with the length of the network. Circles end: a link that only runs in circles is above no start.
    """
    marks = cut(starts.select("link").distinct(), "starts")
    to = F.col("to")
    edges = links.filter((to.cast("string") != "0") & (to != F.col("link"))).select("link", "to").distinct()
    edges = cut(_ways(edges.join(marks, "link", "left_anti")), "ways")
    contracted: list[DataFrame] = []
    while True:
        divided = edges.filter("ways > 1").select("link").distinct()
        if edges.filter("ways = 1").isEmpty():
            break
        pointers = edges.filter("ways = 1").select("link", F.col("to").alias("jump"))
        ends = marks.unionByName(divided).distinct()
        labels = cut(_first_start_below(pointers, ends), "contracted")
        contracted.append(labels)
        there = labels.select(F.col("link").alias("to"), F.col("first_start").alias("_end"))
        left = edges.filter("ways > 1").join(there, "to").select("link", F.col("_end").alias("to"))
        edges = cut(_ways(left.filter(F.col("to") != F.col("link")).distinct()), "ways")
    found = upstream_any(edges.select("link", "to"), marks)
    for labels in reversed(contracted):
        above = labels.join(found.select(F.col("link").alias("first_start")), "first_start", "left_semi")
        found = cut(above.select("link").unionByName(found).distinct(), "closed")
    return found


def upstream_any(edges: DataFrame, starts: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Upstream closure where a link may drain to several others: one round per level.

    ``edges(link, to)``. Only the links found last are joined in each round; known links are left
    out, so circles end. Every round adds one folder to a table of known links.
    """
    spark = edges.sparkSession
    known = scratch_path(spark, "upstream")
    found = starts.select("link").distinct()
    done = 0
    while True:
        found.write.parquet(f"{known}/level={done}")
        frontier = spark.read.schema(found.schema).parquet(f"{known}/level={done}")
        seen = spark.read.schema(found.schema).parquet(f"{known}/level=*")
        if frontier.isEmpty():
            return seen
        done += 1
        if max_rounds is not None and done > max_rounds:
            raise RuntimeError(f"closure not complete after {max_rounds} rounds")
        found = (
            edges.join(frontier.withColumnRenamed("link", "to"), "to", "left_semi")
            .select("link").distinct().join(seen, "link", "left_anti")
        )
