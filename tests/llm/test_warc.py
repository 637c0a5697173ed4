"""Archives: round trips, versions, revisits."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from basinflow.llm import warc
from basinflow.session import qualified, scratch_path

PAGES = "page_id long, url string, html string, id long, digest string, block string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", "y") for r in rows], PAGES)


ODD = [
    (1, "http://a/x y", "é" * 600), (2, "http://a/#f", "é" * 600), (3, None, None), (4, "", ""),
    (5, "http://b/\nline", "short\n\nWARC/1.0\r\n\r\n"), (6, "http://b/%41", "short\n\nWARC/1.0\r\n\r\n"),
    (7, "http://c", "z" * 999), (8, "http://c", "z" * 999), (9, "http://d", "q" * 3_000_000), (2, "http://a/#f", "é" * 600),
    (None, "http://e", "é" * 600), (10, "~", "y" * 2000), (None, "http://f", "n" * 1500),
]


@pytest.mark.parametrize("version", [1, 2])
def test_pages(spark, version):
    got = warc.page_records(pages(spark, ODD), version=version).collect()
    assert len(got) == len(ODD)
    most = {}
    for i, _, html in ODD:
        data = (html or "").encode()
        if len(data) >= 1000:
            most[data] = max(most.get(data, -1), -1 if i is None else i)
    want = []
    for i, _, html in ODD:
        data = (html or "").encode()
        top = most.get(data)
        again = top is not None and top != (-1 if i is None else i)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    found = [(r.id, r.payload_bytes, r.digest, r.type, r.refers_to) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    for r in got:
        if r.type == "response":
            assert hashlib.sha1(r.block).hexdigest() == r.digest and len(r.block) == r.payload_bytes
        else:
            assert r.block == b""


@pytest.mark.parametrize("ids", [(9 * 10**18 + 1, 2 * 10**18 - 1, 5), (-7, 3, -2**63), (-9, -4, None), (2**63 - 1, -(2**63), 10**18)])
def test_page_of_greatest_id_keeps_the_body(spark, ids):
    got = warc.page_records(pages(spark, [(i, "http://a", "b" * 1500) for i in ids])).collect()
    most = max(i for i in ids if i is not None)
    assert {(r.id, r.type, r.refers_to) for r in got} == {
        (i, "response", None) if i == most else (i, "revisit", most) for i in ids}


def test_no_rows(spark):
    assert warc.page_records(pages(spark, [])).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_file(version):
    data = warc.arc_opening(version, "n.arc", "19960101000000")
    bodies = [b"", b"a\n\nb", b"URL x\n" * 3]
    for i, body in enumerate(bodies):
        data += warc.arc_record(version, f"http://x/{i}", "20000102030405", "text/html", body, len(data), "n.arc")
    for held in (data, gzip.compress(data)):
        rows = list(warc.parse_arc(held))
        assert [r["body"] for r in rows] == bodies and rows[1]["url"] == "http://x/1"
    with pytest.raises(ValueError):
        list(warc.parse_arc(data[:-5]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(data.replace(b"URL IP-address", b"URL Address", 1)))


def test_warc_fields(spark):
    arcs, warcs = (qualified(spark, scratch_path(spark, k)) for k in ("a", "w"))
    rows = spark.createDataFrame(
        [("http://x/1", "20000102030405", "text/html", bytearray(b"k" * 2000)), ("http://x/2", "20010102030405", "text/plain", bytearray(b"k" * 2000))],
        "url string, date string, type string, body binary",
    ).coalesce(1)
    written = warc.write_arc(rows, arcs, version=1).collect()
    assert [r.records for r in written] == [2]
    [out] = warc.convert(spark, arcs, warcs).collect()
    content = spark.read.format("binaryFile").load(out.path).first().content
    (one, block), (two, rest) = sorted(warc.parse_warc(bytes(content)), key=lambda x: x[0]["WARC-Target-URI"])
    assert (one["WARC-Type"], two["WARC-Type"]) == ("revisit", "response")
    assert one["WARC-Refers-To"] == two["WARC-Record-ID"] and one["WARC-Refers-To-Target-URI"] == "http://x/2"
    assert one["WARC-Date"] == "2000-01-02T03:04:05Z" and block == b"" and rest == b"k" * 2000
    assert one["WARC-Payload-Digest"] == two["WARC-Payload-Digest"] == two["WARC-Block-Digest"]
    again = warc.convert(spark, arcs, warcs).collect()
    assert spark.read.format("binaryFile").load(again[0].path).first().content == content


def test_many_archives(spark):
    rows = spark.range(0, 300, 1, 6).select(
        F.concat(F.lit("http://x/"), "id").alias("url"), F.lit("20000101000000").alias("date"),
        F.lit("t").alias("type"), F.encode(F.repeat(F.concat(F.col("id") % 7), 2000), "UTF-8").alias("body"),
    )
    arcs, warcs = (qualified(spark, scratch_path(spark, k)) for k in ("a", "w"))
    assert warc.write_arc(rows, arcs, roll=20_000).count() > 6
    assert warc.convert(spark, arcs, warcs).agg(F.sum("records")).first()[0] == 300
    got = warc.read_warc(spark, warcs).groupBy("type").count().collect()
    assert {(r.type, r["count"]) for r in got} == {("response", 7), ("revisit", 293)}


def test_empty_pages_roll(spark):
    """Archives end at bytes of records, so pages without content fill several."""
    rows = spark.range(0, 100_000, 1, 4).select(F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"),
                                                F.lit(None).cast("string").alias("html"))
    arcs = qualified(spark, scratch_path(spark, "a"))
    records = rows.select(F.concat(F.lit("http://x/"), "page_id").alias("url"), F.lit("20000101000000").alias("date"),
                          F.lit("t").alias("type"), F.lit(None).cast("binary").alias("body"))
    assert warc.write_arc(records, arcs, roll=1 << 20).count() > 8
    got = warc.page_records(rows).agg(
        F.count("*"), F.countDistinct("id"), F.sum("payload_bytes"), F.min("type"), F.max("type"), F.count("refers_to")).first()
    assert tuple(got) == (100_000, 100_000, 0, "response", "response", 0)


def test_streams_of_members():
    """A record may lie in a member of its own, share one, or be cut by the end of one."""
    data = warc.arc_opening(1, "n.arc", "19960101000000")
    for i in range(50):
        data += warc.arc_record(1, f"http://x/{i}", "20000102030405", "text/html", bytes([i]) * 997 * i, len(data), "n.arc")
    whole = [r["body"] for r in warc.parse_arc(data)]
    for size in (100, 5000, len(data)):
        held = b"".join(gzip.compress(data[i : i + size]) for i in range(0, len(data), size))
        assert [r["body"] for r in warc.parse_arc(held)] == whole


@pytest.mark.parametrize("path", ["file:/tmp/x", "file:///tmp/x", "dbfs:/tmp/x"])
def test_stores(path):
    files, where = warc._stored(path)
    assert type(files).__name__ == "LocalFileSystem" and where.endswith("/tmp/x")
