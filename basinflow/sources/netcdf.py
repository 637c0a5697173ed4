"""Chunk references from the headers of classic NetCDF files.

The classic format (CDF-1, CDF-2 and CDF-5) is specified publicly by Unidata. Only headers are read:
files are listed by Spark, spread over tasks, and each task reads the first bytes of its files.
Output follows the public Zarr version 2 and reference-file conventions.
"""

from __future__ import annotations

import json
import math
import re
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.functions.names import last_stem
from basinflow.functions.timestamps import stamp
from basinflow.session import cut, delete, qualified
from basinflow.sources.manifest import list_folder

# tasks get this module's functions with the job, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REFERENCES = "path STRING, key STRING, inline STRING, `offset` BIGINT, length BIGINT"

# Type codes of the format, with Zarr type names and sizes in bytes.
TYPES = {
    1: ("|i1", 1), 2: ("|S1", 1), 3: (">i2", 2), 4: (">i4", 4), 5: (">f4", 4), 6: (">f8", 8),
    7: ("|u1", 1), 8: (">u2", 2), 9: (">u4", 4), 10: (">i8", 8), 11: (">u8", 8),
}
# List tags of the format.
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12

# Reference documents that one task writes, about.
DOCUMENTS_PER_TASK = 1000


class _Header:
    """A cursor over the start of a file that fetches more bytes as it runs out."""

    def __init__(self, stream, step: int = 65536):
        self.stream, self.step, self.buffer, self.at = stream, step, b"", 0

    def take(self, n: int) -> bytes:
        while len(self.buffer) < self.at + n:
            more = self.stream.read(max(self.step, self.at + n - len(self.buffer)))
            if not more:
                raise ValueError("file ends inside its header")
            self.buffer += more
        out = self.buffer[self.at:self.at + n]
        self.at += n
        return out

    def unpack(self, code: str) -> int:
        return struct.unpack(f">{code}", self.take(struct.calcsize(f">{code}")))[0]


def parse_header(stream) -> dict:
    """Dimensions, attributes and variables of a classic NetCDF file."""
    head = _Header(stream)
    magic, version = head.take(3), head.take(1)[0]
    if magic != b"CDF" or version not in (1, 2, 5):
        raise ValueError("not a classic NetCDF file")
    count = "q" if version == 5 else "i"
    offset = "i" if version == 1 else "q"

    def name() -> str:
        n = head.unpack(count)
        text = head.take(n).decode("utf-8")
        head.take(-n % 4)
        return text

    def items(tag: int, read) -> list:
        found, n = head.unpack("i"), head.unpack(count)
        if found not in (0, tag):
            raise ValueError("damaged header")
        return [read() for _ in range(n)]

    def attribute() -> tuple[str, object]:
        label, kind, n = name(), head.unpack("i"), head.unpack(count)
        dtype, size = TYPES[kind]
        raw = head.take(n * size)
        head.take(-(n * size) % 4)
        if kind == 2:
            return label, raw.decode("utf-8", "replace").rstrip("\0")
        codes = {"i": {1: "b", 2: "h", 4: "i", 8: "q"}, "u": {1: "B", 2: "H", 4: "I", 8: "Q"},
                 "f": {4: "f", 8: "d"}}
        values = list(struct.unpack(f">{n}{codes[dtype[1]][size]}", raw))
        return label, values[0] if n == 1 else values

    records = head.unpack(count)
    dims = items(DIMENSIONS, lambda: (name(), head.unpack(count)))
    attrs = dict(items(ATTRIBUTES, attribute))

    def variable() -> dict:
        label = name()
        ids = [head.unpack(count) for _ in range(head.unpack(count))]
        own = dict(items(ATTRIBUTES, attribute))
        kind = head.unpack("i")
        head.unpack(count)  # the stored size is unreliable for large variables: recomputed below
        dtype, size = TYPES[kind]
        return {"name": label, "dims": ids, "attrs": own, "dtype": dtype, "size": size,
                "begin": head.unpack(offset)}

    variables = items(VARIABLES, variable)
    # a streamed file leaves its record count unknown (all bits set)
    return {"records": max(records, 0), "streaming": records < 0, "dims": dims, "attrs": attrs,
            "vars": variables}


def _references(header: dict, file_length: int) -> Iterator[tuple[str, str | None, int, int]]:
    """``(key, inline JSON or None, offset, length)`` of a file."""
    dims = header["dims"]
    record_vars = []
    for v in header["vars"]:
        v["is_record"] = bool(v["dims"]) and dims[v["dims"][0]][1] == 0
        shape = [dims[d][1] for d in v["dims"]]
        v["inner"] = shape[1:] if v["is_record"] else shape
        n = v["size"]
        for length in v["inner"]:
            n *= length
        v["bytes"] = n
        if v["is_record"]:
            record_vars.append(v)
    # records are interleaved; a lone record variable is stored without padding
    padded = len(record_vars) > 1
    stride = sum(v["bytes"] + (-v["bytes"] % 4 if padded else 0) for v in record_vars)
    records = header["records"]
    if header["streaming"] and stride:
        records = (file_length - min(v["begin"] for v in record_vars)) // stride
    yield ".zgroup", json.dumps({"zarr_format": 2}), 0, 0
    yield ".zattrs", json.dumps(header["attrs"], sort_keys=True), 0, 0
    for v in header["vars"]:
        names = [dims[d][0] for d in v["dims"]]
        shape = ([records] if v["is_record"] else []) + v["inner"]
        chunks = ([1] if v["is_record"] else []) + v["inner"]
        fill = v["attrs"].get("_FillValue")
        array = {"chunks": chunks, "compressor": None, "dtype": v["dtype"], "fill_value": fill,
                 "filters": None, "order": "C", "shape": shape, "zarr_format": 2}
        yield f"{v['name']}/.zarray", json.dumps(array, sort_keys=True), 0, 0
        own = {k: a for k, a in v["attrs"].items() if k != "_FillValue"}
        own["_ARRAY_DIMENSIONS"] = names
        yield f"{v['name']}/.zattrs", json.dumps(own, sort_keys=True), 0, 0
        tail = ["0"] * len(v["inner"])
        if v["is_record"]:
            for r in range(records):
                yield f"{v['name']}/{'.'.join([str(r), *tail])}", None, v["begin"] + r * stride, v["bytes"]
        else:
            yield f"{v['name']}/{'.'.join(tail) or '0'}", None, v["begin"], v["bytes"]


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        for path, length in zip(batch["path"], batch["length"]):
            system, inner = fs.FileSystem.from_uri(path)
            with system.open_input_stream(inner) as stream:
                header = parse_header(stream)
            rows = [(path, *r) for r in _references(header, int(length))]
            yield pd.DataFrame(rows, columns=["path", "key", "inline", "offset", "length"])


def _file_bytes(var: str, ny: int, nx: int, data) -> bytes:
    """One block as a classic NetCDF file: a float variable over (y, x)."""

    def name(text: str) -> bytes:
        raw = text.encode("utf-8")
        return struct.pack(">i", len(raw)) + raw + b"\0" * (-len(raw) % 4)

    absent = struct.pack(">ii", 0, 0)
    dims = struct.pack(">ii", DIMENSIONS, 2) + name("y") + struct.pack(">i", ny) + name("x")
    dims += struct.pack(">i", nx)
    variable = struct.pack(">ii", VARIABLES, 1) + name(var) + struct.pack(">iii", 2, 0, 1) + absent
    head = b"CDF\x01" + struct.pack(">i", 0) + dims + absent + variable
    values = np.asarray(data, dtype=">f4").tobytes()
    return head + struct.pack(">iii", 5, len(values), len(head) + 12) + values


def _open_uri(spark: SparkSession, path: str) -> str:
    """The path as pyarrow opens it."""
    return re.sub("^file:/(?!/)", "file:///", qualified(spark, path))


def write_blocks(chunks: DataFrame, out: str) -> None:
    """Every block as a small classic NetCDF file ``{hour}.{var}.{y0}.{x0}.nc``.

    Files are named by content, so a task that runs again overwrites what it wrote before.
    """

    where = _open_uri(chunks.sparkSession, out)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(where)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for row in batch.itertuples():
                with system.open_output_stream(f"{root}/{row.name}") as stream:
                    stream.write(_file_bytes(row.var, row.ny, row.nx, row.data))
            yield pd.DataFrame({"files": [len(batch)]})

    name = F.concat_ws(
        ".", stamp(F.col("time"), minutes=False), "var", F.col("y0").cast("string"),
        F.col("x0").cast("string"), F.lit("nc"),
    )
    named = chunks.select(name.alias("name"), "var", "ny", "nx", "data")
    named.mapInPandas(write, "files BIGINT").agg(F.sum("files")).collect()


def scan_headers(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """References ``(path, key, inline, offset, length)`` of every file in a folder.

    ``inline`` is JSON for metadata keys and NULL for data chunks.
    """
    files = list_folder(spark, folder, pattern).select("path", "length")
    # opening a file takes longer than its path is long: with a number, the paths are not joined into one small part
    return files.repartition(spark.sparkContext.defaultParallelism, "path").mapInPandas(_scan, REFERENCES)


def reference_lines(refs: DataFrame) -> DataFrame:
    """JSON reference documents, line by line: ``(path, name, ord, key, line)``.

    A document is its lines in the order of ``ord, key``. No document is ever held in one value, so a
    file with millions of chunks is no special case. Every file opens with its ``.zgroup`` entry.
    """
    chunk = F.to_json(F.array(F.col("path"), F.col("offset").cast("string"),
                              F.col("length").cast("string")))
    # offsets and lengths are numbers in the document
    chunk = F.regexp_replace(chunk, r'"(\d+)","(\d+)"\]$', "$1,$2]")
    quoted = F.to_json(F.struct(F.col("inline").alias("v")))
    text = F.regexp_extract(quoted, r"^\{\"v\":(.*)\}$", 1)
    entry = F.concat(F.lit('"'), F.col("key"), F.lit('":'),
                     F.when(F.col("inline").isNull(), chunk).otherwise(text))
    first = F.col("key") == ".zgroup"

    def row(order: int, key: Column, line: Column) -> Column:
        return F.struct(F.lit(order).alias("ord"), key.alias("key"), line.alias("line"))

    opening = row(0, F.col("key"), F.concat(F.lit('{"version":1,"refs":{'), entry))
    middle = row(1, F.col("key"), F.concat(F.lit(","), entry))
    ending = row(2, F.lit(""), F.lit("}}"))
    lines = F.when(first, F.array(opening, ending)).otherwise(F.array(middle))
    name = F.concat(last_stem(F.col("path")), F.lit(".json"))
    return refs.select("path", name.alias("name"), F.inline(lines))


def write_refs(refs: DataFrame, out: str) -> None:
    """One JSON document per input file, below ``name={file stem}.json``.

    Inputs sharing a stem would overwrite each other's document; that is an error here.
    """
    docs = cut(reference_lines(refs), "refs")  # headers are read once
    clash = (
        docs.filter("ord = 0").groupBy("name").agg(F.count("*").alias("n")).filter("n > 1")
        .limit(5).collect()
    )
    if clash:
        raise ValueError(f"several inputs share the documents {[r.name for r in clash]}")
    # A document is a file: tasks follow their number, not their bytes. Rows of a document stay together and are sorted
    # on disk, not in memory.
    spark = refs.sparkSession
    delete(spark, out)
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(docs.filter("ord = 0").count() / DOCUMENTS_PER_TASK))
    lines = docs.repartition(tasks, "name").sortWithinPartitions("name", "ord", "key").select("name", "line")
    lines.mapInPandas(_document_writer(spark, out), "files BIGINT").agg(F.sum("files")).collect()


# What Spark escapes in the folder names of a partitioned table.
ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def _document_writer(spark: SparkSession, out: str):
    """Writes sorted lines ``(name, line)``, a file below ``name=...`` each; a task that runs again overwrites it."""
    where = _open_uri(spark, out)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(where)
        system.create_dir(root, recursive=True)
        name, stream = None, None
        for batch in batches:
            opened = 0
            for row in batch.itertuples():
                if row.name != name:
                    if stream:
                        stream.close()
                    name, opened = row.name, opened + 1
                    folder = f"{root}/name=" + ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", name)
                    system.create_dir(folder, recursive=True)
                    stream = system.open_output_stream(f"{folder}/part-00000.txt")
                stream.write(f"{row.line}\n".encode())
            yield pd.DataFrame({"files": [opened]})
        if stream:
            stream.close()

    return write
