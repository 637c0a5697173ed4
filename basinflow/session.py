"""Session settings and shared scratch space."""

from __future__ import annotations

import atexit
import hashlib
import io
import pathlib
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. AQE coalesces small shuffles and splits skewed ones.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def get_session(app: str = "basinflow", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the SQL settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent, as in tests, a folder below the warehouse stands in: the other place
    that a session's executors share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", folder)
        atexit.register(_quietly, delete, spark, folder)
    return folder


def _quietly(fn, *args) -> None:
    """Tidying up at the end must not hide how a program ended; the session may be gone already."""
    try:
        fn(*args)
    except Exception:  # noqa: BLE001
        pass


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, with Spark's own file system."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per Spark context.

    Functions that run there are then found by import, wherever the executors run.
    """
    context = spark.sparkContext
    root = pathlib.Path(__file__).parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            entry = zipfile.ZipInfo(f"{root.name}/{source.relative_to(root).as_posix()}")
            archive.writestr(entry, source.read_bytes())
    name = f"{root.name}-{hashlib.sha256(held.getvalue()).hexdigest()[:16]}.zip"
    if any(str(x).endswith(name) for x in context._python_includes):
        return
    path = f"{shared_dir(spark).rstrip('/')}/{name}"
    files, where = _file_system(spark, path)
    if not files.exists(where):
        out = files.create(where, True)
        out.write(bytearray(held.getvalue()))
        out.close()
    context.addPyFile(files.makeQualified(where).toString())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark uses for it."""
    files, where = _file_system(spark, path)
    return files.makeQualified(where).toString()


class Rounds:
    """The state of a loop: each round is written before the one before is deleted."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.path = spark, name, None

    def put(self, df: DataFrame) -> DataFrame:
        """Write ``df``, which may read the round before, and return it as read back."""
        before, self.path = self.path, scratch_path(self.spark, self.name)
        df.write.parquet(self.path)
        if before:
            delete(self.spark, before)
        return self.spark.read.schema(df.schema).parquet(self.path)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and return it as read back, without its lineage.

    Lost executors re-read files instead of repeating the steps before, and Spark knows the size of
    what it joins next.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
