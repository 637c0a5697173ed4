"""Streams over tables that are one file or a folder of files."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from support import rows

from basinflow import schemas
from basinflow.plans import queries_grid, queries_jobs
from basinflow.streaming.clip import stream_chunks


def stored(folder, parts):
    """Twelve blocks of an hourly grid as ``embeddings.parquet``: one file, or a folder of ``parts`` files."""
    folder.mkdir()
    made = pa.table({
        "vec_id": pa.array(range(240), pa.int64()),
        "embedding": pa.array([[float(k + v) for k in range(64)] for v in range(240)], pa.list_(pa.float32())),
        "label": pa.array([0] * 240, pa.int32()),
    })
    if parts == 1:
        pq.write_table(made, folder / "embeddings.parquet")
    else:
        (folder / "embeddings.parquet").mkdir()
        for k in range(parts):
            pq.write_table(made.slice(k * 240 // parts, 240 // parts), folder / "embeddings.parquet" / f"part-{k}.parquet")
    pq.write_table(pa.table({"page_id": [1]}), folder / "pages.parquet")
    return str(folder)


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_clip_of_a_file_or_a_folder(spark, tmp_path, parts):
    sf = stored(tmp_path / "in", parts)
    got, want = queries_grid.stream_clip(spark, sf), queries_grid.forcing_clip(spark, sf)
    assert rows(got) == rows(want) and got.count()


@pytest.mark.parametrize("parts", [1, 3])
def test_group_status_of_a_file_or_a_folder(spark, tmp_path, parts):
    assert queries_jobs.stream_group_status(spark, stored(tmp_path / "in", parts)).count()


def test_only_the_named_table_is_read(spark, tmp_path):
    sf = stored(tmp_path / "in", 2)
    pq.write_table(pa.table({"vec_id": [1000]}), tmp_path / "in" / "embeddings.parquet2")
    kind = schemas.T.StructType([schemas.T.StructField("vec_id", schemas.T.LongType())])
    query = stream_chunks(spark, sf, kind, table="embeddings.parquet").writeStream.format("memory").queryName("named")
    query.trigger(availableNow=True).start().awaitTermination()
    assert [r[0] for r in rows(spark.table("named"))] == list(range(240))
