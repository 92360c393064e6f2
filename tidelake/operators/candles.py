"""Candles from ticks, and candles of longer intervals from shorter ones."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import bucket_start
from tidelake.schemas import AMOUNT, FACT_KLINES

# fixed values: interval codes and their length in seconds
INTERVALS = {
    "1m": 60,
    "5m": 300,
    "15m": 900,
    "30m": 1_800,
    "1h": 3_600,
    "4h": 14_400,
    "1d": 86_400,
}
TARGETS = tuple(code for code in INTERVALS if code != "1m")
# Candles of a task that makes all targets: each becomes up to a row per target in its aggregate.
ROWS_PER_TASK = 50_000


def ohlcv(time: str = "open_time") -> list[Column]:
    """Aggregates that combine candles of one symbol and window.

    First and last are picked by a plain timestamp: with only fixed-width values in the
    buffer Spark keeps the hash aggregate (a struct would force a sort).
    """
    return [
        F.max_by("close_time", time).alias("close_time"),
        F.min_by("open_price", time).alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", time).alias("close_price"),
        F.sum("volume_base").cast(AMOUNT).alias("volume_base"),
        F.sum("volume_quote").cast(AMOUNT).alias("volume_quote"),
        F.sum("num_trades").alias("num_trades"),
        F.sum("taker_buy_quote_volume").cast(AMOUNT).alias("taker_buy_quote_volume"),
    ]


def _as_candles(df: DataFrame, interval: str) -> DataFrame:
    df = df.withColumn("interval_code", F.lit(interval))
    return df.select(*FACT_KLINES.fieldNames())


def from_ticks(
    ticks: DataFrame, interval: str = "1m", *, tie_break: str | None
) -> DataFrame:
    """Candles from (symbol_id, ts, price, qty, is_taker_buy).

    ``tie_break`` names a non-negative id ordering ticks of equal time; without one (None) the
    first and last price among equal times are arbitrary. Time and id are
    packed into one decimal, again to stay with the hash aggregate.
    """
    seconds = INTERVALS[interval]
    when: Column = F.unix_micros("ts")
    if tie_break:
        when = when.cast("decimal(18,0)") * F.lit("1" + "0" * 19).cast("decimal(20,0)") + F.col(
            tie_break
        ).cast("decimal(19,0)")
    value = F.col("price") * F.col("qty")
    bars = (
        ticks.select(
            "symbol_id",
            bucket_start("ts", seconds).alias("open_time"),
            when.alias("_at"),
            F.col("price").cast(AMOUNT).alias("price"),
            F.col("qty").cast(AMOUNT).alias("qty"),
            value.cast(AMOUNT).alias("value"),
            F.when(F.col("is_taker_buy"), value).otherwise(0).cast(AMOUNT).alias("taker"),
        )
        .groupBy("symbol_id", "open_time")
        .agg(
            F.min_by("price", "_at").alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", "_at").alias("close_price"),
            F.sum("qty").cast(AMOUNT).alias("volume_base"),
            F.sum("value").cast(AMOUNT).alias("volume_quote"),
            F.count(F.lit(1)).alias("num_trades"),
            F.sum("taker").cast(AMOUNT).alias("taker_buy_quote_volume"),
        )
        .withColumn(
            "close_time",
            F.timestamp_millis(F.unix_millis("open_time") + F.lit(seconds * 1000 - 1)),
        )
    )
    return _as_candles(bars, interval)


def resample(candles: DataFrame, interval: str) -> DataFrame:
    """Candles of ``interval`` from candles of any interval that divides it."""
    bars = (
        candles.withColumn("_start", bucket_start("open_time", INTERVALS[interval]))
        .groupBy("symbol_id", "_start")
        .agg(*ohlcv())
        .withColumnRenamed("_start", "open_time")
    )
    return _as_candles(bars, interval)


def resample_all(candles_1m: DataFrame, targets=TARGETS, rows: int | None = None) -> DataFrame:
    """All target intervals of 1-minute candles in one frame, from two shuffles in total.

    The shortest target is aggregated first, with map-side combine. Its result, a
    fraction of the input, is hash partitioned by (symbol, day), and every longer window
    lies inside one day: so one local aggregate over (interval, window) yields all
    targets without another exchange and without branches. A (symbol, day) holds at most
    288 five-minute bars, so a busy symbol is spread over as many tasks as it has days.

    With ``rows``, a number of candles that is not exceeded, the candles themselves are
    partitioned so, into a partition per ``ROWS_PER_TASK``, and all aggregates are local:
    one shuffle, and a task holds the bars of no more candles however many there are.
    """
    shortest = min(targets, key=INTERVALS.get)
    spans = F.array(
        *[F.struct(F.lit(t).alias("code"), F.lit(INTERVALS[t] * 1_000_000).alias("width")) for t in targets]
    )
    micros = F.unix_micros("open_time")
    if rows is None:
        bars = (
            resample(candles_1m, shortest)
            .drop("interval_code")
            .withColumn("_day", bucket_start("open_time", INTERVALS["1d"]))
            .repartition("symbol_id", "_day")
        )
    else:
        bars = (
            candles_1m.withColumn("_day", bucket_start("open_time", INTERVALS["1d"]))
            .repartition(max(1, ceil(rows / ROWS_PER_TASK)), "symbol_id", "_day")
            .withColumn("_start", bucket_start("open_time", INTERVALS[shortest]))
            .groupBy("symbol_id", "_day", "_start")
            .agg(*ohlcv())
            .withColumnRenamed("_start", "open_time")
        )
    bars = (
        bars.select("*", F.explode(spans).alias("_span"))
        .withColumn("interval_code", F.col("_span.code"))
        .withColumn("_start", F.timestamp_micros(micros - F.pmod(micros, F.col("_span.width"))))
        .groupBy("symbol_id", "_day", "interval_code", "_start")
        .agg(*ohlcv())
        .withColumnRenamed("_start", "open_time")
    )
    return bars.select(*FACT_KLINES.fieldNames())
