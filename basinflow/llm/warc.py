"""From legacy ARC archives to WARC, and back to records.

``write_arc`` stores payloads in ARC files of version 1 or 2; ``convert`` parses them and writes WARC
files; ``read_warc`` reads those. An ARC file opens with a ``filedesc:`` record whose lines name the
version and the fields of the header lines that follow: five in version 1, ten in version 2. A header
line ends with the length of the body after it, so a body may hold anything. For each ARC record the
converter makes a WARC record: an identifier that depends only on the record's name, date and body, the
date in WARC form, the type ``response`` or ``revisit``, and SHA-1 digests. A body that occurred before, and is
at least ``least`` bytes long, is stored once; the other records revisit it by identifier and digest.

Which record keeps a body is settled from digests and lengths alone, aggregated before they are
joined, so a body that a third of all records share is one row on one side of the join.
Archives are rolled at ``roll`` bytes of records, header lines included, hold one gzip member per record, and are
written by tasks under names that depend on their content; a repeated task writes the same file again. They are
decompressed as a stream. To convert, only paths and decisions are shuffled; the task opens the archive itself.

Defined results: a null body counts as empty. A null name is written as ``~`` and read back as null, in a
form that keeps spaces and line ends out of header lines. Ids are integers; a null id is kept, and never the record
that others revisit unless no other has the body. Rows that repeat an id and a body are all of one
type: response. Further columns are ignored. No rows give archives without records and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.session import cut, qualified, scratch_path, ship_package

# Field names of header lines by version, and the line that opens a WARC record.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
OPENING = b"WARC/1.0\r\n"
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
ROLL = 8 << 20


def _stored(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path with a scheme, such as those that Spark returns for its folders.

    Spark's connectors name some stores differently from pyarrow.
    """
    for pattern, name in (("^file:/(?!/)", "file:///"), ("^s3[an]://", "s3://"), ("^dbfs:/+", "file:///dbfs/")):
        path = re.sub(pattern, name, path)
    return fs.FileSystem.from_uri(path)


def _plain(data: bytes) -> io.BufferedIOBase:
    """An archive's content as a stream, decompressed piece by piece where it is compressed."""
    held = io.BytesIO(data)
    return gzip.GzipFile(fileobj=held) if data[:2] == b"\x1f\x8b" else held


def _store(folder: str, name: str, data: bytes) -> None:
    """Write a file under a passing name and rename it, so that no half file is ever seen."""
    files, where = _stored(folder)
    files.create_dir(where, recursive=True)
    passing = f"{where}/_{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(passing) as out:
        out.write(data)
    files.move(passing, f"{where}/{name}")


def _named(text: str | None) -> str:
    return "~" if text is None else quote(text, safe=":/?#[]@!$&'()*+,;=%") if text else "."


def _name(text: str) -> str | None:
    return None if text == "~" else "" if text == "." else text


# ---------------------------------------------------------------------------------------------- ARC


def arc_opening(version: int, name: str, date: str) -> bytes:
    """The first record of an ARC file."""
    body = f"{version} 0 basinflow\n{FIELDS[version]}\n\n".encode()
    if version == 1:
        head = f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n"
    else:
        head = f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(body)}\n"
    return head.encode() + body


def arc_record(version: int, url: str | None, date: str, kind: str, body: bytes, offset: int, name: str) -> bytes:
    """A header line, the body and the line end that follows it."""
    fields = [_named(url), "0.0.0.0", date, kind]
    if version == 2:
        fields += ["200", base64.b32encode(hashlib.sha1(body).digest()).decode(), "-", str(offset), name]
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body + b"\n"


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of one ARC file: ``url, date, type, body``. Header lines are read by the fields that the
    file's own opening names, bodies by their declared length."""
    plain = _plain(data)
    first = plain.readline()
    body = io.BytesIO(plain.read(int(first.rsplit(b" ", 1)[1])))
    version = int(body.readline().split(b" ", 1)[0])
    names = body.readline().decode().split()
    if names != FIELDS[version].split():
        raise ValueError(f"fields of version {version} expected, found {names}")
    while head := plain.readline():
        if head == b"\n":
            continue
        values = head.rstrip(b"\n").decode().split(" ")
        if len(values) != len(names):
            raise ValueError(f"header line of {len(values)} fields, {len(names)} expected")
        row = dict(zip(names, values))
        length = int(row["Archive-length"])
        held = plain.read(length)
        if len(held) < length:
            raise ValueError("the archive ends within a record")
        yield {"url": _name(row["URL"]), "date": row["Archive-date"], "type": row["Content-type"], "body": held}


def write_arc(rows: DataFrame, folder: str, version: int = 2, roll: int = ROLL) -> DataFrame:
    """Write ``rows (url, date, type, body)`` as ARC files; returns ``path, records`` per file.

    ``date`` is text of 14 digits, ``body`` binary or null.
    """
    ship_package(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, seen, count, held, offset = [], hashlib.sha256(), 0, 0, 0

        def out() -> pa.RecordBatch:
            name = f"{seen.hexdigest()[:32]}.arc.gz"
            opening = gzip.compress(arc_opening(version, name, "19960101000000"), mtime=0)
            _store(folder, name, opening + b"".join(members))
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([count], pa.int64())], names=["path", "records"]
            )

        for batch in batches:
            for url, date, kind, body in zip(*(batch.column(i) for i in range(4))):
                data = body.as_py() or b""
                record = arc_record(version, url.as_py(), date.as_py(), kind.as_py(), data, offset, "-")
                members.append(gzip.compress(record, 6, mtime=0))
                seen.update(record)
                offset += len(members[-1])
                count, held = count + 1, held + len(record)
                if held >= roll:
                    yield out()
                    members, seen, count, held, offset = [], hashlib.sha256(), 0, 0, 0
        if count:
            yield out()

    return rows.select("url", "date", "type", "body").mapInArrow(run, "path string, records long")


def _archives(spark: SparkSession, folder: str, ending: str, *columns: str) -> DataFrame:
    """``path, content`` of the archives in a folder, or the named columns."""
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{ending}").schema(
        "path string, modificationTime timestamp, length long, content binary"
    ).load(folder).select(*columns or ("path", "content"))


# --------------------------------------------------------------------------------------------- WARC


def record_id(url: str | None, date: str, digest: str) -> str:
    """The identifier that a record gets whenever it is converted."""
    return uuid.uuid5(NAMES, f"{_named(url)} {date} {digest}").urn


def warc_record(row: dict, refers_to: dict | None) -> bytes:
    """One WARC record; a revisit if ``refers_to`` names the record that holds the body. The block of a response is
    its payload, so both have the digest of ``row``."""
    body = row["body"] if refers_to is None else b""
    digest = f"sha1:{base64.b32encode(bytes.fromhex(row['digest'])).decode()}"
    d = row["date"]
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{row['id']}>"),
        ("WARC-Date", f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"),
        ("WARC-Target-URI", _named(row["url"])),
        ("WARC-Payload-Digest", digest),
        ("X-Payload-Length", str(row["length"])),
    ]
    if refers_to is None:
        head.append(("WARC-Block-Digest", digest))
    else:
        head += [
            ("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<{refers_to['id']}>"),
            ("WARC-Refers-To-Target-URI", _named(refers_to["url"])),
        ]
    head += [("Content-Type", row["type"]), ("Content-Length", str(len(body)))]
    return OPENING + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields and block of the records of one WARC file."""
    plain = _plain(data)
    while line := plain.readline():
        if line == b"\r\n":
            continue
        if line != OPENING:
            raise ValueError("not the start of a WARC record")
        head = {}
        while (line := plain.readline()) != b"\r\n":
            if not line:
                raise ValueError("the archive ends within a record")
            name, _, value = line.decode().partition(":")
            head[name.strip()] = value.strip()
        block = plain.read(int(head["Content-Length"]))
        if len(block) < int(head["Content-Length"]):
            raise ValueError("the archive ends within a record")
        yield head, block


PARSED = "path string, nth int, url string, date string, digest string, second string, length long"


def arc_index(spark: SparkSession, folder: str) -> DataFrame:
    """What the records of ARC files are, without their bodies: ``path, nth, url, date, digest, second,
    length``, with the SHA-1 and the SHA-256 of each body."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows = [
                    (path.as_py(), i, r["url"], r["date"], hashlib.sha1(r["body"]).hexdigest(),
                     hashlib.sha256(r["body"]).hexdigest(), len(r["body"]))
                    for i, r in enumerate(parse_arc(content.as_py()))
                ]
                kinds = [pa.string(), pa.int32(), *[pa.string()] * 4, pa.int64()]
                columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in PARSED.split(", ")])

    ship_package(spark)
    return _archives(spark, folder, ".arc.gz").mapInArrow(run, PARSED)


def convert(spark: SparkSession, arcs: str, warcs: str, least: int = 1000, per_task: int = 4) -> DataFrame:
    """Convert the ARC files of a folder to WARC files; returns ``path, records`` per file, ``per_task`` files a task.

    Of equal bodies of at least ``least`` bytes the record with the greatest date, then the greatest
    name by number where it ends in one of up to 38 digits, is the response. A sign counts after ``#page=``.
    """
    index = cut(arc_index(spark, arcs), "arc-index")
    number = [
        F.regexp_extract(F.coalesce("url", F.lit("")), end, 1).try_cast("decimal(38,0)")
        for end in (r"#page=(-?\d+)$", r"(\d+)$")
    ]
    order = F.struct("date", F.coalesce(*number).alias("number"), F.col("url").alias("url"))
    long = index.filter(F.col("length") >= least)
    first = long.groupBy("digest", "second", "length").agg(F.max(order).alias("kept"))
    found = long.join(first, ["digest", "second", "length"]).filter(~F.struct("date", "url").eqNullSafe(
        F.struct(F.col("kept.date"), F.col("kept.url"))))
    revisits = found.select("path", F.struct("nth", F.col("kept.date").alias("date"), F.col("kept.url").alias("url")).alias("r"))
    per_file = revisits.groupBy("path").agg(F.collect_list("r").alias("revisits"))
    paths = _archives(spark, arcs, ".arc.gz", "path")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, told in zip(batch.column(0), batch.column(1)):
                kept = {r["nth"]: r for r in told.as_py() or ()}
                files, where = _stored(path.as_py())
                with files.open_input_stream(where) as held:
                    content = held.read()
                members = []
                for i, row in enumerate(parse_arc(content)):
                    digest = hashlib.sha1(row["body"]).hexdigest()
                    row |= {"digest": digest, "length": len(row["body"]), "id": record_id(row["url"], row["date"], digest)}
                    to = kept.get(i)
                    if to:
                        to = {"url": to["url"], "id": record_id(to["url"], to["date"], digest)}
                    members.append(gzip.compress(warc_record(row, to), 6, mtime=0))
                name = path.as_py().rsplit("/", 1)[1].replace(".arc.gz", ".warc.gz")
                _store(warcs, name, b"".join(members))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{warcs.rstrip('/')}/{name}"]), pa.array([len(members)], pa.int64())],
                    names=["path", "records"],
                )

    tasks = -(-paths.count() // per_task)
    files = paths.join(per_file, "path", "left").select("path", "revisits").repartition(max(tasks, 1))
    return files.mapInArrow(run, "path string, records long")


READ = "id string, type string, url string, date string, digest string, length long, refers_url string, block binary"


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the WARC files of a folder; ``digest`` is SHA-1 in hex, ``length`` that of the whole body."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = zip(*[x.split() for x in READ.split(", ")])
        types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for head, block in parse_warc(content.as_py()):
                    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if head["WARC-Type"] == "response" and hashlib.sha1(block).hexdigest() != digest:
                        raise ValueError(f"digest of {head['WARC-Record-ID']} differs")
                    to = head.get("WARC-Refers-To-Target-URI")
                    rows.append((
                        head["WARC-Record-ID"], head["WARC-Type"], _name(head["WARC-Target-URI"]), head["WARC-Date"],
                        digest, int(head["X-Payload-Length"]), None if to is None else _name(to), block,
                    ))
                columns = [pa.array([r[i] for r in rows], types[k]) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=list(names))

    ship_package(spark)
    return _archives(spark, folder, ".warc.gz").mapInArrow(run, READ)


def page_records(pages: DataFrame, least: int = 1000, version: int = 2, id_col: str = "page_id",
                 body_col: str = "html", url_col: str = "url") -> DataFrame:
    """Pages through ARC and WARC archives and back: ``id, type, payload_bytes, digest, refers_to, url, block``.

    A record is named by its page's address with the page's id as the last field of the fragment.
    """
    spark = pages.sparkSession
    arcs, warcs = (qualified(spark, scratch_path(spark, kind)) for kind in ("arc", "warc"))
    number = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rows = pages.select(
        F.concat(F.coalesce(F.col(url_col), F.lit("~")), F.lit("#page="), number).alias("url"),
        F.lit("20000101000000").alias("date"), F.lit("text/html").alias("type"),
        F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8").alias("body"),
    )
    _files(write_arc(rows, arcs, version), arcs)
    _files(convert(spark, arcs, warcs, least), warcs)
    page = r"#page=(\d+|-\d+|null)$"
    kind = pages.schema[id_col].dataType
    back = read_warc(spark, warcs)
    return back.select(
        F.regexp_extract("url", page, 1).try_cast(kind).alias("id"), F.col("type"),
        F.col("length").alias("payload_bytes"), "digest",
        F.regexp_extract("refers_url", page, 1).try_cast(kind).alias("refers_to"),
        F.regexp_replace("url", page, "").alias("url"), "block",
    )


def _files(written: DataFrame, folder: str) -> None:
    """Run the tasks that write archives; where there was nothing to write, leave an empty folder."""
    if not written.agg(F.sum("records")).first()[0]:
        files, where = _stored(folder)
        files.create_dir(where, recursive=True)
