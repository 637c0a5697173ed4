"""Links whose way has ended are spread over the tasks of a lookup."""

import pytest
from pyspark.sql import functions as F
from support import rows

from basinflow.operators import closure


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ended_ways_do_not_meet_in_one_task(spark, broadcasts, kind):
    broadcasts(-1)
    before = {n: spark.conf.get(n, None) for n in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = spark.range(4000).select(
            F.col("id").cast(kind).alias("link"), F.when(F.col("id") % 100 == 0, F.col("id") + 1).cast(kind).alias("jump"))
        ahead = made.select(F.col("link").alias("_at"), F.concat(F.lit("x"), "link").alias("there"))
        got = closure._looked_up(made, "jump", ahead)
        per_task = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(per_task) == 4000 and max(per_task) < 1000
        want = [(str(k), f"x{k + 1}" if k % 100 == 0 else None) for k in range(4000)]
        assert sorted((r[0], r[1]) for r in got.select(F.col("link").cast("string"), "there").collect()) == sorted(want)
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_long_and_short_ways_down(spark):
    """A star of ended ways beside a chain, with starts on both."""
    links = [(k, 1) for k in range(2, 200)] + [(1, 0)] + [(k, k + 1) for k in range(300, 340)] + [(340, 0), (500, 500)]
    frame = spark.createDataFrame(links, "link long, to long")
    starts = spark.createDataFrame([(1,), (320,)], "link long")
    want = sorted([(k, 1) for k in range(1, 200)] + [(k, 320) for k in range(300, 321)])
    assert rows(closure.first_start_below(frame, starts)) == want
    below = closure.downstream(frame, spark.createDataFrame([(7,), (310,)], "link long"))
    assert rows(below) == sorted([(1,), (7,)] + [(k,) for k in range(310, 341)])
