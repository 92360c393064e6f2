from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the accepted range of candle years
FIRST_YEAR, LAST_YEAR = 2000, 2100


def _epoch(value: Column | str, unit: int, convert) -> Column:
    """A time from ``unit`` parts of a second, NULL outside years 1 to 9999. Beyond them a
    conversion overflows or gives dates that neither Python nor folders can hold."""
    number = (F.col(value) if isinstance(value, str) else value).try_cast("long")
    inside = number.between(-62_135_596_800 * unit, 253_402_300_800 * unit - 1)
    return convert(F.when(inside, number))


def from_millis(value: Column | str) -> Column:
    return _epoch(value, 1_000, F.timestamp_millis)


def from_micros(value: Column | str) -> Column:
    return _epoch(value, 1_000_000, F.timestamp_micros)


def bucket_start(ts: Column | str, seconds: int) -> Column:
    """Start of the epoch-aligned window holding ``ts``.

    The same windows as ``F.window(ts, ...)``, but one timestamp instead of a struct:
    cheaper to group by, and usable as a partitioning column.
    """
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000)))


def sane_time(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.isNotNull() & F.year(ts).between(FIRST_YEAR, LAST_YEAR)


def utc_date(ts: Column | str) -> Column:
    return F.to_date(ts)


def utc_hour(ts: Column | str) -> Column:
    return F.date_format(ts, "HH")
