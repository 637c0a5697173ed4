"""Queries on time bins, windows and listings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.functions.names import joined_stem, last_stem
from basinflow.functions.timestamps import from_epoch_ns, hour_of
from basinflow.operators import timebins as T
from basinflow.operators.cells import time_slice
from basinflow.plans import views as V
from basinflow.plans.catalog import query
from basinflow.plans.jobs import run_windows
from basinflow.plans.views import with_views
from basinflow.sources.manifest import list_forcing
from basinflow.sources.netcdf import reference_lines
from basinflow.sources.sinks import hourly_parts as add_part
from basinflow.session import scratch_path
from basinflow.sources.sinks import RunLayout, part_documents, read_parts, write_parts

STEP = 10

# Example windows of two days each.
WINDOWS = [
    ("w1", datetime(2024, 1, 3), datetime(2024, 1, 4, 23)),
    ("w2", datetime(2024, 1, 4, 12), datetime(2024, 1, 6, 11)),
    ("w3", datetime(2024, 1, 20), datetime(2024, 1, 21, 23)),
]


def user_spans(spark: SparkSession, sf: str) -> DataFrame:
    return V.series(spark, sf).groupBy("loc").agg(
        F.min("time").alias("start"), F.max("time").alias("end")
    )


def whole_span(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "events").agg(
        hour_of(F.min("ts")).alias("start"), hour_of(F.max("ts")).alias("end")
    )


def span_bounds(span: DataFrame) -> tuple[Column, Column]:
    """Both ends from one scalar subquery."""
    both = span.select(F.struct("start", "end")).scalar()
    return both.getField("start"), both.getField("end")


def bins_sql(spans: str, keys: str = "") -> str:
    """Time groups of every row of ``spans``, as a common table expression."""
    part = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""edges AS (
        SELECT {lead}unnest(generate_series("start", "end", INTERVAL {STEP} HOUR)) AS edge FROM {spans}
        UNION
        SELECT {lead}"end" + INTERVAL 1 HOUR FROM {spans}),
    pairs AS (
        SELECT {lead}CAST(row_number() OVER ({part} ORDER BY edge) - 1 AS INTEGER) AS bin,
               edge AS bin_start,
               lead(edge) OVER ({part} ORDER BY edge) - INTERVAL 1 HOUR AS bin_end
        FROM edges),
    bins AS (SELECT * FROM pairs WHERE bin_end IS NOT NULL)"""


SPAN_SQL = 'span AS (SELECT min(time) AS "start", max(time) AS "end" FROM series)'


@query(with_views("series", f""",
    spans AS (SELECT loc, min(time) AS "start", max(time) AS "end" FROM series GROUP BY loc),
    {bins_sql("spans", "loc")}
    SELECT loc, bin, bin_start, bin_end FROM bins"""))
def time_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Ten-hour groups over the active span of every user."""
    return T.time_bins(user_spans(spark, sf), STEP, ["loc"])


@query(with_views("series", f""", {SPAN_SQL}, {bins_sql("span")}
    SELECT b.bin, s.var, count(*) AS n, round(sum(s.value), 4) AS total
    FROM series s JOIN bins b ON s.time BETWEEN b.bin_start AND b.bin_end GROUP BY b.bin, s.var"""))
def binned_series(spark: SparkSession, sf: str) -> DataFrame:
    """The series summed per time group."""
    start, end = span_bounds(whole_span(spark, sf))
    binned = T.assign_bins(V.series(spark, sf), start, end, STEP)
    return binned.groupBy("bin", "var").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query(with_views("series", f""", {SPAN_SQL}, {bins_sql("span")},
    done AS (SELECT bin, count(DISTINCT time) AS written
             FROM bins JOIN series ON time BETWEEN bin_start AND bin_end AND var = 'error'
             GROUP BY bin)
    SELECT bin, bin_start, bin_end, date_diff('hour', bin_start, bin_end) + 1 AS expected,
           coalesce(written, 0) AS written,
           date_diff('hour', bin_start, bin_end) + 1 = coalesce(written, 0) AS ok
    FROM bins LEFT JOIN done USING (bin)"""))
def group_status(spark: SparkSession, sf: str) -> DataFrame:
    """Which time groups have an error event in every hour."""
    span = whole_span(spark, sf)
    errors = V.series(spark, sf).filter("var = 'error'")
    written = T.assign_bins(errors, *span_bounds(span), STEP)
    return T.group_status(T.time_bins(span, STEP), written)


@query(with_views("series", """,
    windows(window_id, a, b) AS (VALUES
        ('w1', TIMESTAMP '2024-01-03 00:00:00', TIMESTAMP '2024-01-04 23:00:00'),
        ('w2', TIMESTAMP '2024-01-04 12:00:00', TIMESTAMP '2024-01-06 11:00:00'),
        ('w3', TIMESTAMP '2024-01-20 00:00:00', TIMESTAMP '2024-01-21 23:00:00'))
    SELECT window_id, event_id, time, var, loc, value
    FROM series JOIN windows ON time BETWEEN a AND b"""))
def batch_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Three overlapping or separate windows in one pass."""
    windows = spark.createDataFrame(
        WINDOWS, "window_id STRING, start TIMESTAMP_NTZ, end TIMESTAMP_NTZ"
    )
    return T.batch_windows(V.series(spark, sf), windows)


@query(with_views("series", """,
    windows(window_id, a, b) AS (VALUES
        ('w1', TIMESTAMP '2024-01-03 00:00:00', TIMESTAMP '2024-01-04 23:00:00'),
        ('w2', TIMESTAMP '2024-01-04 12:00:00', TIMESTAMP '2024-01-06 11:00:00'),
        ('w3', TIMESTAMP '2024-01-20 00:00:00', TIMESTAMP '2024-01-21 23:00:00'))
    SELECT window_id, event_id, time, var, loc, value
    FROM series JOIN windows ON time BETWEEN a AND b"""))
def windows_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same written, one folder per window, and read back."""
    windows = spark.createDataFrame(
        WINDOWS, "window_id STRING, start TIMESTAMP_NTZ, end TIMESTAMP_NTZ"
    )
    out = RunLayout(scratch_path(spark, "runs"), "windows").forcing
    run_windows(V.series(spark, sf), windows, out)
    return spark.read.parquet(out)


@query("""SELECT event_id, ts AS time, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-11'""")
def hourly_slice(spark: SparkSession, sf: str) -> DataFrame:
    """A slice with a date-only end: through the end of that day."""
    rows = V.table(spark, sf, "events").select("event_id", F.col("ts").alias("time"), "value")
    return time_slice(rows, "2024-01-05", "2024-01-10")


@query(with_views("series", """
    SELECT strftime(time, '%Y%m%d%H%M') || '.LDASIN_DOMAIN1' AS part, count(*) AS n,
           round(sum(value), 4) AS total
    FROM series GROUP BY time"""))
def hourly_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Size of every hourly output."""
    return add_part(V.series(spark, sf)).groupBy("part").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query("""SELECT t AS valid_time,
           'archive/forcing/' || year(t) || '/' || strftime(t, '%Y%m%d%H') || '.LDASIN_DOMAIN1.json' AS path,
           'https://archive.s3.amazonaws.com/forcing/' || year(t) || '/' || strftime(t, '%Y%m%d%H')
             || '.LDASIN_DOMAIN1.json' AS url
    FROM (SELECT TIMESTAMP '2009-12-31' + to_hours(page_id) AS t FROM pages)
    WHERE t BETWEEN TIMESTAMP '2009-12-31 06:00:00' AND TIMESTAMP '2010-01-05 12:00:00'""")
def file_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Archive files of a period across the turn of the year."""
    return list_forcing(
        V.listing(spark, sf), datetime(2009, 12, 31, 6), datetime(2010, 1, 5, 12)
    )


@query(with_views("series", f""", {SPAN_SQL}, {bins_sql("span")}
    SELECT bin AS part, '{{"end":"' || strftime(bin_end, '%Y-%m-%dT%H:%M:%S') || '","start":"'
           || strftime(bin_start, '%Y-%m-%dT%H:%M:%S') || '"}}' AS document
    FROM bins"""))
def parts_json(spark: SparkSession, sf: str) -> DataFrame:
    """Time groups as JSON documents."""
    return part_documents(T.time_bins(whole_span(spark, sf), STEP))


@query("""WITH files AS (
        SELECT 'pages/' || lpad(CAST(page_id AS VARCHAR), 8, '0') || '.nc' AS path,
               lpad(CAST(page_id AS VARCHAR), 8, '0') || '.json' AS name,
               url, strlen(html) AS size FROM pages)
    SELECT path, name, 0 AS ord, '.zgroup' AS key,
           '{"version":1,"refs":{".zgroup":"{\\"zarr_format\\":2}"' AS line FROM files
    UNION ALL
    SELECT path, name, 1, 'html/.zattrs',
           ',"html/.zattrs":"{\\"url\\":\\"' || url || '\\"}"' FROM files
    UNION ALL
    SELECT path, name, 1, 'html/0', ',"html/0":["' || path || '",64,' || size || ']' FROM files
    UNION ALL
    SELECT path, name, 2, '', '}}' FROM files""")
def refs_json(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk references of every page, as the lines of one JSON document per page."""
    files = V.table(spark, sf, "pages").select(
        F.concat(
            F.lit("pages/"), F.lpad(F.col("page_id").cast("string"), 8, "0"), F.lit(".nc")
        ).alias("path"),
        "url", F.octet_length("html").alias("size"),
    )
    none = F.lit(None).cast("string")

    def entry(key, inline, offset, length):
        return F.struct(
            F.lit(key).alias("key"), inline.alias("inline"),
            offset.cast("bigint").alias("offset"), length.cast("bigint").alias("length"),
        )

    refs = files.select("path", F.inline(F.array(
        entry(".zgroup", F.lit('{"zarr_format":2}'), F.lit(0), F.lit(0)),
        entry("html/.zattrs", F.concat(F.lit('{"url":"'), "url", F.lit('"}')), F.lit(0), F.lit(0)),
        entry("html/0", none, F.lit(64), F.col("size")),
    )))
    return reference_lines(refs)


@query(with_views("series", f""", {SPAN_SQL}, {bins_sql("span")}
    SELECT bin AS part, bin_start AS start, bin_end AS "end" FROM bins"""))
def parts_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Time groups written as one document each and read back."""
    out = scratch_path(spark, "parts")
    write_parts(T.time_bins(whole_span(spark, sf), STEP), out)
    return read_parts(spark, out)


@query("SELECT event_id, ts AS time FROM events")
def epoch_times(spark: SparkSession, sf: str) -> DataFrame:
    """Times of all events from nanoseconds since the epoch."""
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return V.table(spark, sf, "events").select("event_id", from_epoch_ns(ns).alias("time"))


@query("""SELECT page_id, regexp_replace(name, '\\.[^.]*$', '') AS stem,
           replace(regexp_replace(name, '\\.[^.]*$', ''), '.', '') AS joined
    FROM (SELECT page_id, regexp_extract(url, '[^/]*$') || '.v1.nc' AS name FROM pages)""")
def file_stems(spark: SparkSession, sf: str) -> DataFrame:
    """Names of files without their last extension, and without any dot."""
    path = F.concat("url", F.lit(".v1.nc"))
    return V.table(spark, sf, "pages").select(
        "page_id", last_stem(path).alias("stem"), joined_stem(path).alias("joined")
    )
