from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidelake.schemas import AMOUNT


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_decimal(value: Column | str, kind: DecimalType) -> Column:
    """Text or number to decimal; anything unreadable (``abc``, ``nan``) is NULL.

    A plain cast raises under ANSI mode, so bad input would fail the whole job.
    """
    return _col(value).try_cast(kind)


def amount(value: Column | str) -> Column:
    return as_decimal(value, AMOUNT)


def share(part: Column | str, whole: Column | str) -> Column:
    """part / whole, NULL unless the whole is positive."""
    return F.when(_col(whole) > 0, _col(part) / _col(whole))
