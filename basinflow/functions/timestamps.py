"""Zone-free timestamp helpers."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = "INTERVAL '1' HOUR"
_ORIGIN = datetime(1900, 1, 1)


def ntz(value: datetime | str | Column) -> Column:
    """A zone-free timestamp Column from a datetime, text or Column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def hours(n: Column | int) -> Column:
    """``n`` hours as an interval."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(hours=n.cast("int"))


def hours_between(start: Column, end: Column) -> Column:
    """Whole hours from ``start`` to ``end``."""
    return F.call_function("div", end - start, F.expr(HOUR))


def hour_of(ts: Column) -> Column:
    """The timestamp cut down to its hour."""
    origin = ntz(_ORIGIN)
    return origin + hours(hours_between(origin, ts))


def stamp(ts: Column, minutes: bool = True) -> Column:
    """Digits of the timestamp: ``yyyyMMddHHmm``, or ``yyyyMMddHH`` without minutes."""
    text = F.substring(ts.cast("string"), 1, 16 if minutes else 13)
    return F.translate(text, "- :", "")


def parse_stamp(text: Column) -> Column:
    """Zone-free timestamp from ``yyyyMMddHH`` or ``yyyyMMddHHmm``, NULL when it does not parse.

    Put together from its digits, so no session time zone takes part.
    """
    digits = F.when(text.rlike(r"^\d{10}(\d{2})?$"), text)

    def part(start: int, n: int) -> Column:
        return F.substring(digits, start, n).cast("int")

    minute = F.when(F.length(digits) == 12, F.substring(digits, 11, 2)).otherwise("00").cast("int")
    return F.try_make_timestamp_ntz(
        part(1, 4), part(5, 2), part(7, 2), part(9, 2), minute, F.lit(0).cast("decimal(16,6)")
    )


def from_epoch_ns(ns: Column) -> Column:
    """Nanoseconds since the epoch to a timestamp (micro-second precision)."""
    epoch = ntz(datetime(1970, 1, 1))
    micros = F.call_function("div", ns, F.lit(1000).cast("bigint"))
    seconds = F.call_function("div", micros, F.lit(1_000_000).cast("bigint"))
    rest = (micros - seconds * 1_000_000).cast("decimal(18,6)") / 1_000_000
    days = F.call_function("div", seconds, F.lit(86400).cast("bigint"))
    secs = (seconds - days * 86400).cast("decimal(18,6)") + rest.cast("decimal(18,6)")
    return epoch + F.make_dt_interval(days=days.cast("int"), secs=secs)


def slice_bounds(start: str | datetime, end: str | datetime) -> tuple[datetime, datetime, bool]:
    """Bounds of an inclusive label slice.

    A date-only end means "through the end of that day": the bound becomes the next midnight and is
    exclusive. Returns ``(start, end, end_inclusive)``. Dates must be complete (``YYYY-MM-DD``).
    """
    first = start if isinstance(start, datetime) else datetime.fromisoformat(start)
    if isinstance(end, datetime):
        return first, end, True
    if len(end) == 10:
        day = date.fromisoformat(end)
        return first, datetime(day.year, day.month, day.day) + timedelta(days=1), False
    return first, datetime.fromisoformat(end), True
