"""Row filters and membership joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions import in_universe, sane_time
from tidelake.operators.skew import broadcast_checked
from tidelake.session import materialize


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column is present."""
    return df.filter(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns)))


def rejects(df: DataFrame, *columns: str) -> DataFrame:
    """The complement of :func:`require`, for counting what a load leaves out."""
    return df.filter(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns)))


def sane(df: DataFrame, time: str = "open_time") -> DataFrame:
    return df.filter(sane_time(time))


def of_interval(candles: DataFrame, interval: str) -> DataFrame:
    """On a stored fact table this prunes partitions."""
    return candles.filter(F.col("interval_code") == interval)


def universe(tickers: DataFrame, quote: str = "USDT") -> DataFrame:
    return tickers.filter(in_universe("symbol", F.col("quoteVolume").try_cast("decimal(30,12)"), quote))


def members(df: DataFrame, entities: DataFrame, on: str) -> DataFrame:
    """Rows whose key is listed in ``entities``; the list never visits the driver. It is
    stored, so that counting it does not make it twice."""
    listed = materialize(entities.select(on).distinct(), "listed")
    return df.join(broadcast_checked(listed), on, "left_semi")


def strangers(df: DataFrame, known: DataFrame, on: str, known_on: str | None = None) -> DataFrame:
    """Rows whose key is not in ``known``."""
    listed = materialize(known.select(F.col(known_on or on).alias(on)).distinct(), "known")
    return df.join(broadcast_checked(listed), on, "left_anti")
