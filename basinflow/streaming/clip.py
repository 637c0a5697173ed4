"""Clip of forcing files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from basinflow import schemas
from basinflow.functions.gridindex import IndexBounds
from basinflow.operators.cells import hyperslab


def stream_chunks(
    spark: SparkSession,
    folder: str,
    schema: StructType = schemas.CHUNKS,
    pattern: str | None = None,
    files_per_trigger: int | None = None,
    table: str | None = None,
) -> DataFrame:
    """New Parquet files of a folder as a stream.

    ``table`` names one entry of the folder, which may be a single file or itself a folder of files.
    """
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # as a glob: a stream's plain path must be a folder, what a glob finds may be a file too
    return reader.parquet(f"{folder}/{{{table}}}" if table else folder)


def stream_clip(
    chunks: DataFrame,
    bounds: IndexBounds,
    out: str,
    checkpoint: str,
    available_now: bool = False,
    **options: object,
) -> StreamingQuery:
    """Cut every arriving block to ``bounds`` and append it to ``out``.

    The cut keeps no state; the checkpoint and the file sink's log make each input file count once,
    also after a restart.
    """
    writer = (
        hyperslab(chunks, bounds, **options)
        .writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()
