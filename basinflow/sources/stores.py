"""Chunked array stores as a Spark data source, and a writer for them.

A store is a folder in the public Zarr layout, version 2: ``{var}/.zarray`` describes a variable on the axes
time, row and column, ``{var}/t.y.x`` are its chunks, ``time`` is the axis of hours. Chunks are plain or zlib.

Reading plans input partitions only for chunks that meet the hours, rows and columns asked for: one per stored chunk,
small chunks together up to ``PARTITION_BYTES``, or as many as ``chunks_per_partition`` says. The planner reads the axis and one description per variable, never a
chunk. Rows are one per hour and chunk. The window is an option of the source, not a pushed filter: Spark 4.1 keeps
the chunks that a push has left with the loaded DataFrame, so a second query on it that pushes
nothing, or something else, would read those of the first.

Defined results: an absent chunk holds the fill value, and gives no rows where that is null. Under the fill value NaN,
NaN is read as NULL and NULL written as NaN. Chunks that reach beyond the grid are cut at its edge. A store
without hours gives no rows.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from basinflow import schemas
from basinflow.functions.gridindex import IndexBounds
from basinflow.session import qualified, ship_package

NAME = "basinflow_store"
EPOCH = "hours since 1970-01-01 00:00:00"
HOURS_PER_FILE = 1 << 16
PARTITION_BYTES = 8 << 20


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))


def _get(path: str) -> bytes | None:
    """A file's content, None where there is no such file."""
    files, where = _place(path)
    try:
        with files.open_input_stream(where, compression=None) as held:
            return held.read()
    except FileNotFoundError:
        return None


def _put(path: str, data: bytes) -> None:
    """Files are named by what they hold, so a task that is repeated writes the same file again."""
    files, where = _place(path)
    files.create_dir(where.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(where, compression=None) as out:
        out.write(data)


def describe(path: str, var: str) -> dict:
    """The description of a variable; refuses what this module cannot read."""
    held = _get(f"{path}/{var}/.zarray")
    if held is None:
        raise ValueError(f"{path} has no variable {var}")
    meta = json.loads(held)
    packed = (meta.get("compressor") or {}).get("id", "zlib")
    if meta["zarr_format"] != 2 or meta["order"] != "C" or meta.get("filters") or packed != "zlib":
        raise ValueError(f"{var} is stored in a form that is not read")
    return meta


def _chunk(path: str, meta: dict, key: str) -> np.ndarray | None:
    """A stored chunk in its full shape, None where it is absent and the fill value null."""
    held = _get(f"{path}/{key}")
    kind = np.dtype(meta["dtype"])
    if held is None:
        fill = meta["fill_value"]
        return None if fill is None else np.full(meta["chunks"], float(fill), kind)
    data = zlib.decompress(held) if meta["compressor"] else held
    return np.frombuffer(data, kind).reshape(meta["chunks"])


def hours_of(path: str) -> np.ndarray:
    """The axis of hours."""
    meta = describe(path, "time")
    if json.loads(_get(f"{path}/time/.zattrs") or b"{}").get("units") != EPOCH:
        raise ValueError(f"the axis must count {EPOCH}")
    n, size = meta["shape"][0], meta["chunks"][0]
    parts = [_chunk(f"{path}/time", meta, str(k)) for k in range(-(-n // size))]
    hours = np.concatenate([np.empty(0, np.int64), *parts])[:n]
    return hours.astype("datetime64[h]").astype("datetime64[us]")


@dataclass
class Chunks(D.InputPartition):
    """Chunks that a task reads: ``(var, t, y, x)``, with the hours of each ``t`` by the chunks' length."""

    keys: list[tuple[str, int, int, int]]
    hours: dict[tuple[int, int], np.ndarray]


@dataclass(frozen=True)
class Window:
    """Hours in microseconds since 1970, rows and columns, both ends included; an end that is None is open."""

    start: int | None = None
    end: int | None = None
    bounds: IndexBounds | None = None

    def hours(self, times: np.ndarray) -> np.ndarray:
        """Places of the hours inside."""
        micros = times.astype(np.int64)
        kept = np.ones(len(micros), bool)
        if self.start is not None:
            kept &= micros >= self.start
        if self.end is not None:
            kept &= micros <= self.end
        return np.flatnonzero(kept)

    def pieces(self, n: int, size: int, axis: str) -> range:
        """Chunks of ``size`` that meet the window on an axis of ``n`` cells, ``i`` or ``j``."""
        count = -(-n // size)
        if self.bounds is None:
            return range(count)
        first, last = getattr(self.bounds, f"{axis}min"), getattr(self.bounds, f"{axis}max")
        return range(max((first - 1) // size, 0), min((last - 1) // size + 1, count))


class Reader(D.DataSourceReader):
    def __init__(self, path: str, names: list[str], size: int | None, window: Window):
        self.path, self.names, self.size, self.window = path, names, size, window

    def partitions(self) -> list[Chunks]:
        times = hours_of(self.path)
        kept = self.window.hours(times)
        keys, hours, most = [], {}, 1
        for var in self.names:
            meta = describe(self.path, var)
            most = max(most, math.prod(meta["chunks"]) * np.dtype(meta["dtype"]).itemsize)
            (_, ny, nx), (ct, cy, cx) = meta["shape"], meta["chunks"]
            for t in np.unique(kept // ct).tolist():
                hours[(ct, t)] = times[t * ct : (t + 1) * ct]
                keys += [
                    (var, ct, t, y, x) for y in self.window.pieces(ny, cy, "j") for x in self.window.pieces(nx, cx, "i")
                ]
        out = []
        size = self.size or max(PARTITION_BYTES // most, 1)
        for start in range(0, len(keys), size):
            some = keys[start : start + size]
            out.append(Chunks([(v, t, y, x) for v, _, t, y, x in some], {(ct, t): hours[(ct, t)] for _, ct, t, _, _ in some}))
        return out or [Chunks([], {})]

    def read(self, partition: Chunks) -> Iterator[pa.RecordBatch]:
        described = {}
        for var, t, y, x in partition.keys:
            meta = described.get(var) or described.setdefault(var, describe(self.path, var))
            (_, ny, nx), (ct, cy, cx) = meta["shape"], meta["chunks"]
            held = _chunk(f"{self.path}/{var}", meta, f"{t}.{y}.{x}")
            if held is None:
                continue
            times = partition.hours[(ct, t)]
            kept = self.window.hours(times)
            rows, cols = min(cy, ny - y * cy), min(cx, nx - x * cx)
            cells = np.ascontiguousarray(held[kept, :rows, :cols], np.float32).ravel()
            lost = np.isnan(cells) if meta["fill_value"] == "NaN" else None
            n = len(kept)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * (rows * cols)), pa.array(cells, pa.float32(), mask=lost))
            ints = [pa.array(np.full(n, v, np.int32)) for v in (y * cy + 1, x * cx + 1, rows, cols)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([var] * n, pa.string()), pa.array(times[kept], pa.timestamp("us")), *ints, lists],
                names=schemas.CHUNKS.names)


class StoreSource(D.DataSource):
    """Options: ``path``, ``vars`` as JSON, ``chunks_per_partition``, ``start``, ``end``, ``bounds`` as JSON."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return schemas.CHUNKS

    def reader(self, schema) -> Reader:
        start, end = (json.loads(self.options.get(k, "null")) for k in ("start", "end"))
        box = json.loads(self.options.get("bounds", "null"))
        window = Window(start, end, box and IndexBounds(*box))
        return Reader(
            self.options["path"], json.loads(self.options["vars"]),
            json.loads(self.options.get("chunks_per_partition", "null")), window)


def variables(path: str) -> list[str]:
    """Names of the stored variables, the axis left out."""
    files, where = _place(path)
    found = files.get_file_info(fs.FileSelector(where))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory and f.base_name != "time")


def store_variables(spark: SparkSession, path: str) -> list[str]:
    """Names of the variables of a store at any path that Spark knows."""
    return variables(qualified(spark, path))


def read_store(
    spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None,
    bounds: IndexBounds | None = None, names: Sequence[str] | None = None, chunks_per_partition: int | None = None,
) -> DataFrame:
    """Blocks of a store, with the columns of ``chunks``: hours from ``start`` through ``end``, chunks that meet the
    index window, the named variables. What is left out is not limited, names must exist.
    """
    ship_package(spark)
    spark.dataSource.register(StoreSource)
    path = qualified(spark, path)
    micros = [t and (t - datetime(1970, 1, 1)) // timedelta(microseconds=1) for t in (start, end)]
    box = bounds and [bounds.imin, bounds.imax, bounds.jmin, bounds.jmax]
    return spark.read.format(NAME).options(
        path=path, vars=json.dumps(variables(path) if names is None else list(names)),
        chunks_per_partition=json.dumps(chunks_per_partition), start=json.dumps(micros[0]), end=json.dumps(micros[1]),
        bounds=json.dumps(box),
    ).load()


def write_store(
    chunks: DataFrame, path: str, shape: tuple[int, int], chunk: tuple[int, int, int], packed: bool = False
) -> None:
    """Write blocks as a store whose chunks hold ``chunk`` hours, rows and columns of a grid of ``shape``.

    Each stored chunk is put together by one task from the blocks inside it; a block that crosses chunks is refused,
    rechunk it first. The axis holds every hour from the first to the last one there is. Times must be
    whole hours. Of blocks in the same place and hour any one stays.
    """
    spark = chunks.sparkSession
    path = qualified(spark, path)
    ship_package(spark)
    hour = F.unix_micros(F.col("time").cast("timestamp")) / 3_600_000_000
    placed = chunks.withColumn("hour", F.when(hour == F.floor(hour), F.floor(hour)).otherwise(
        F.raise_error(F.lit("times must be whole hours")).cast("bigint")))
    found = placed.agg(F.min("hour").alias("a"), F.max("hour").alias("b"), F.collect_set("var").alias("vars")).first()
    first, n = (0, 0) if found.a is None else (found.a, found.b - found.a + 1)
    ct, cy, cx = chunk
    compressor = {"id": "zlib", "level": 1} if packed else None

    def described(var: str, sizes, pieces, kind: str, fill) -> None:
        meta = {
            "zarr_format": 2, "shape": list(sizes), "chunks": list(pieces), "dtype": kind, "order": "C",
            "compressor": compressor, "fill_value": fill, "filters": None,
        }
        _put(f"{path}/{var}/.zarray", json.dumps(meta).encode())

    def pack(data: bytes) -> bytes:
        return zlib.compress(data, 1) if packed else data

    _put(f"{path}/.zgroup", json.dumps({"zarr_format": 2}).encode())
    described("time", [n], [HOURS_PER_FILE], "<i8", 0)
    _put(f"{path}/time/.zattrs", json.dumps({"units": EPOCH, "_ARRAY_DIMENSIONS": ["time"]}).encode())
    for start in range(0, n, HOURS_PER_FILE):
        axis = first + np.arange(start, start + HOURS_PER_FILE, dtype="<i8")
        _put(f"{path}/time/{start // HOURS_PER_FILE}", pack(axis.tobytes()))
    for var in found.vars:
        described(var, (n, *shape), chunk, "<f4", "NaN")
        _put(f"{path}/{var}/.zattrs", json.dumps({"_ARRAY_DIMENSIONS": ["time", "y", "x"]}).encode())

    def write(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        var, t, y, x = (k.as_py() for k in key)
        held = np.full(chunk, np.nan, "<f4")
        for batch in batches:
            spots = (batch.column(c).to_pylist() for c in ("hour", "y0", "x0", "ny", "nx"))
            for i, (h, y0, x0, ny, nx) in enumerate(zip(*spots)):
                top, left = y0 - 1 - y * cy, x0 - 1 - x * cx
                if top + ny > cy or left + nx > cx or y0 + ny - 1 > shape[0] or x0 + nx - 1 > shape[1]:
                    raise ValueError(f"the block at {y0}, {x0} crosses stored chunks or the grid's edge")
                values = batch.column("data")[i].values.to_numpy(zero_copy_only=False)
                held[h - first - t * ct, top : top + ny, left : left + nx] = values.reshape(ny, nx)
        _put(f"{path}/{var}/{t}.{y}.{x}", pack(held.tobytes()))
        yield pa.RecordBatch.from_pydict({"done": pa.array([1], pa.int64())})

    keys = [
        "var", F.floor((F.col("hour") - first) / ct).alias("t"), F.floor((F.col("y0") - 1) / cy).alias("y"),
        F.floor((F.col("x0") - 1) / cx).alias("x"),
    ]
    rows = placed.select(*keys, "hour", "y0", "x0", "ny", "nx", "data")
    rows.groupBy("var", "t", "y", "x").applyInArrow(write, "done long").agg(F.sum("done")).collect()
