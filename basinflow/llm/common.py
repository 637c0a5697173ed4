"""Words, normal forms and names shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space of every operator here: space, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: Column | str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def squeezed(text: Column | str) -> Column:
    """Every run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(whole(text), SPACES, " ")


def word_line(text: Column | str) -> Column:
    """The words joined by one space; null counts as empty."""
    return F.trim(squeezed(text))


def word_count(text: Column | str) -> Column:
    """Number of words; null has none."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def unit_hash(*parts: Column) -> Column:
    """A repeatable 60-bit number of the parts, the same in any engine that has MD5."""
    line = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Cut a text at white space into pieces of about ``size`` bytes, so that a very long text never
    becomes one list of words. A word longer than ``size`` stays whole."""
    if len(data) <= size:
        yield data
        return
    spaces = b" \t\n\x0b\x0c\r"
    start = 0
    while start < len(data):
        end = min(start + size, len(data))
        while end < len(data) and data[end] not in spaces:
            end += 1
        yield data[start:end]
        start = end
