"""Dataset descriptions: count, range and extent of every variable."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_DESCRIBED = (
    "variable string, n bigint, value_min double, value_max double, j_min int, j_max int, i_min int, i_max int, "
    "first bigint, last bigint"
)


def describe_cells(cells: DataFrame, dataset: str) -> DataFrame:
    """Per variable of a long cell table: count, range, index extent and time range."""
    return cells.groupBy(F.lit(dataset).alias("dataset"), F.col("var").alias("variable")).agg(
        F.count("value").alias("n"),
        F.min("value").cast("double").alias("value_min"),
        F.max("value").cast("double").alias("value_max"),
        F.min("j").alias("j_min"), F.max("j").alias("j_max"),
        F.min("i").alias("i_min"), F.max("i").alias("i_max"),
        F.min("time").alias("time_first"), F.max("time").alias("time_last"),
    )


def described_while_written(
    cells: DataFrame, dataset: str, variables: Sequence[str], write: Callable[[DataFrame], None]
) -> DataFrame:
    """Run ``write`` on the cells and return what ``describe_cells`` would say of them, without reading them again.

    The figures are gathered by the tasks that write. ``variables`` are the names that may occur; one that does not
    occur has no row, a cell of any other fails the job after writing. Figures of each variable come back
    to the driver, ten numbers for each name.
    """
    spark: SparkSession = cells.sparkSession
    names = list(dict.fromkeys(variables))
    value = F.col("value").cast("double")
    figures = [F.count(F.when(~F.coalesce(F.col("var").isin(names), F.lit(False)), 1)).alias("others")]
    for k, name in enumerate(names):
        def of(column, here=F.col("var") == name):
            return F.when(here, column)
        figures += [F.count(of(F.lit(1))).alias(f"rows_{k}"), F.count(of(value)).alias(f"n_{k}")]
        for column, label in ((value, "value"), (F.col("j"), "j"), (F.col("i"), "i")):
            figures += [F.min(of(column)).alias(f"{label}_min_{k}"), F.max(of(column)).alias(f"{label}_max_{k}")]
        hour = F.unix_micros(F.col("time").cast("timestamp"))
        figures += [F.min(of(hour)).alias(f"first_{k}"), F.max(of(hour)).alias(f"last_{k}")]
    seen = Observation()
    write(cells.observe(seen, *figures))
    got = seen.get
    if got["others"]:
        raise ValueError(f"{got['others']} cells of variables that are not named")
    at = ("n", "value_min", "value_max", "j_min", "j_max", "i_min", "i_max", "first", "last")
    rows = [
        (name, *(got[f"{a}_{k}"] for a in at)) for k, name in enumerate(names) if got[f"rows_{k}"]
    ]
    found = spark.createDataFrame(rows, _DESCRIBED)
    times = [F.timestamp_micros(c).cast("timestamp_ntz").alias(f"time_{c}") for c in ("first", "last")]
    return found.select(F.lit(dataset).alias("dataset"), *found.columns[:-2], *times)


def describe_chunks(chunks: DataFrame, dataset: str) -> DataFrame:
    """The same from stored blocks: arrays are reduced in place, cells are never unfolded."""
    filled = F.filter("data", lambda v: v.isNotNull())
    return chunks.withColumn("_v", filled).groupBy(
        F.lit(dataset).alias("dataset"), F.col("var").alias("variable")
    ).agg(
        F.sum(F.size("_v")).cast("bigint").alias("n"),
        F.min(F.array_min("_v")).cast("double").alias("value_min"),
        F.max(F.array_max("_v")).cast("double").alias("value_max"),
        F.min("y0").alias("j_min"), F.max(F.col("y0") + F.col("ny") - 1).alias("j_max"),
        F.min("x0").alias("i_min"), F.max(F.col("x0") + F.col("nx") - 1).alias("i_max"),
        F.min("time").alias("time_first"), F.max("time").alias("time_last"),
    )


def describe_table(df: DataFrame, dataset: str, variables: Sequence[str]) -> DataFrame:
    """Per numeric column of a wide table: count and range, all in a single pass."""
    stats = df.agg(*[
        F.struct(
            F.count(v).alias("n"),
            F.min(v).cast("double").alias("value_min"), F.max(v).cast("double").alias("value_max"),
        ).alias(v)
        for v in variables
    ])
    rows = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.col(f"{v}.n"), F.col(f"{v}.value_min"),
                 F.col(f"{v}.value_max"))
        for v in variables
    ])
    return stats.select(F.lit(dataset).alias("dataset"), F.inline(rows))


def metadata_documents(description: DataFrame) -> DataFrame:
    """One JSON document per dataset and variable, keys in the order of the columns."""
    return description.select(
        "dataset", "variable", F.to_json(F.struct(*description.columns)).alias("document")
    )
