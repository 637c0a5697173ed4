"""File-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def first_stem(path: Column) -> Column:
    """Base name up to its first dot."""
    return F.substring_index(basename(path), ".", 1)


def last_stem(path: Column) -> Column:
    """Base name without its last extension; empty when there is no dot."""
    name = basename(path)
    return F.when(F.contains(name, F.lit(".")), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(
        F.lit("")
    )


def joined_stem(path: Column) -> Column:
    """Base name without its last extension and with the remaining dots removed."""
    return F.replace(last_stem(path), F.lit("."), F.lit(""))


def bucket_url(path: Column) -> Column:
    """``bucket/key`` as the bucket's public virtual-host URL."""
    return F.concat(
        F.lit("https://"), F.substring_index(path, "/", 1), F.lit(".s3.amazonaws.com/"),
        F.regexp_replace(path, r"^[^/]*/", ""),
    )
