"""Percentile-based composite score, signals and the top-N mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import sane_time, share
from tidelake.functions.times import FIRST_YEAR, LAST_YEAR
from tidelake.operators.candles import INTERVALS
from tidelake.operators.ranks import SINGLE_TASK_ROWS, percent_ranks, row_numbers, top_n
from tidelake.schemas import MART_TOP_COINS, SCORE

# fixed values: the five ranked metrics, their weights, and the neutral fill of ratios
WEIGHTS = {
    "total_volume_quote": 0.2,
    "avg_taker_buy_ratio": 0.2,
    "money_flow_filled": 0.2,
    "whale_buy_ratio": 0.2,
    "bullish_ratio": 0.2,
}
RANK_NAMES = {
    "total_volume_quote": "pr_volume",
    "avg_taker_buy_ratio": "pr_taker",
    "money_flow_filled": "pr_flow",
    "whale_buy_ratio": "pr_whale",
    "bullish_ratio": "pr_bullish",
}
NEUTRAL = 0.5
# fixed values: signal bounds (all strict) and the optional score adjustment
ACCUMULATE_WHALE, ACCUMULATE_BULLISH = 0.60, 0.60
DISTRIBUTE_WHALE, DISTRIBUTE_BULLISH = 0.40, 0.35
RISING_TREND, TREND_BONUS, WHALE_PENALTY = 1.2, 0.05, 0.10

# Groups up to this many rows are numbered by an ordinary window.
_GROUP_ROWS = 1_000_000


def _sums() -> list[Column]:
    rising = F.when(F.col("close_price") > F.col("open_price"), 1).otherwise(0)
    return [
        F.sum("volume_quote").alias("total_volume_quote"),
        F.sum("num_trades").alias("total_num_trades"),
        F.avg(share("taker_buy_quote_volume", "volume_quote")).alias("avg_taker_buy_ratio"),
        F.count(F.lit(1)).alias("candle_count"),
        F.sum(rising).alias("bullish_candles"),
    ]


def candle_totals(candles: DataFrame) -> DataFrame:
    """Volume, trades, candle count, mean taker share and bullish share per symbol."""
    sums = candles.groupBy("symbol_id").agg(*_sums())
    return sums.withColumn("bullish_ratio", share("bullish_candles", "candle_count"))


def number_candles(candles: DataFrame, interval: str = "1d") -> DataFrame:
    """Add row_num and total_rows per symbol in time order.

    Times are unique per symbol and lie in the accepted years, so the interval bounds
    the rows of a symbol (36 890 for 1d). Where that bound is high the numbering is
    range partitioned instead, and a busy symbol is spread over many tasks.
    """
    seconds = (LAST_YEAR - FIRST_YEAR + 1) * 366 * INTERVALS["1d"]
    return row_numbers(
        candles,
        [F.col("open_time")],
        ["symbol_id"],
        group_total="total_rows",
        single_task=seconds // INTERVALS[interval] <= _GROUP_ROWS,
    )


def with_half(numbered: DataFrame) -> DataFrame:
    """First or second half of a symbol's candles; the middle one counts as second."""
    first = F.col("row_num") * 2 <= F.col("total_rows")
    return numbered.withColumn("half", F.when(first, F.lit("first")).otherwise(F.lit("second")))


def _half_means() -> list[Column]:
    return [F.avg(F.when(F.col("half") == h, F.col("volume_quote"))).alias(f"_{h}") for h in ("first", "second")]


def _trend() -> Column:
    ratio = F.try_divide(F.col("_second"), F.col("_first")).try_cast(SCORE)
    return F.when(F.col("_first") > 0, ratio).otherwise(F.lit(1).cast(SCORE)).alias("volume_trend")


def volume_trend(candles: DataFrame, interval: str = "1d") -> DataFrame:
    """Mean volume of the second half over that of the first; 1.0 without a first half."""
    halves = with_half(number_candles(candles, interval)).groupBy("symbol_id").agg(*_half_means())
    return halves.select("symbol_id", _trend())


def candle_metrics(candles: DataFrame, interval: str = "1d") -> DataFrame:
    """:func:`candle_totals` and :func:`volume_trend` from one pass: candles are numbered,
    which puts a symbol's candles together, and aggregated where they are."""
    numbered = with_half(number_candles(candles, interval))
    sums = numbered.groupBy("symbol_id").agg(*_sums(), *_half_means())
    whole = sums.select("*", share("bullish_candles", "candle_count").alias("bullish_ratio"), _trend())
    return whole.drop("_first", "_second")


def combine(
    candles: DataFrame, metrics: DataFrame, dim: DataFrame, interval: str = "1d"
) -> DataFrame:
    """One row per known symbol with all metrics; missing ones filled neutrally.

    ``whale_ratio_raw`` and ``money_flow`` keep the unfilled values.
    """
    candles = candles.filter(sane_time("open_time"))

    def ratio(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(NEUTRAL))

    return (
        candle_metrics(candles, interval)
        .join(metrics.select("symbol_id", "money_flow", "whale_buy_ratio"), "symbol_id", "left")
        .join(dim.select("symbol_id", "symbol_code"), "symbol_id", "inner")
        .withColumn("whale_ratio_raw", F.col("whale_buy_ratio"))
        .withColumn("whale_buy_ratio", ratio("whale_buy_ratio"))
        .withColumn("avg_taker_buy_ratio", ratio("avg_taker_buy_ratio"))
        .withColumn("bullish_ratio", ratio("bullish_ratio"))
        .withColumn("money_flow_filled", F.coalesce(F.col("money_flow"), F.lit(0)))
    )


def score(
    combined: DataFrame,
    weights: dict[str, float] | None = None,
    adjust: bool = False,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add the percent ranks and ``long_term_score``, their weighted sum.

    ``adjust`` adds a bonus for a rising volume trend and a penalty for a low, actually
    measured whale ratio, then clamps to [0, 1].
    """
    weights = weights or WEIGHTS
    ranked = percent_ranks(combined, "symbol_id", RANK_NAMES, single_task_rows)
    value = None
    for metric, name in RANK_NAMES.items():
        term = F.lit(weights[metric]) * F.col(name)
        value = term if value is None else value + term
    if adjust:
        value = value + F.when(F.col("volume_trend") > RISING_TREND, TREND_BONUS).otherwise(0.0)
        value = value - F.when(
            F.col("whale_ratio_raw") < DISTRIBUTE_WHALE, WHALE_PENALTY
        ).otherwise(0.0)
        value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
    return ranked.withColumn("long_term_score", value)


def signal(whale: Column | str = "whale_buy_ratio", bullish: Column | str = "bullish_ratio") -> Column:
    whale = F.col(whale) if isinstance(whale, str) else whale
    bullish = F.col(bullish) if isinstance(bullish, str) else bullish
    return (
        F.when((whale > ACCUMULATE_WHALE) & (bullish > ACCUMULATE_BULLISH), "ACCUMULATING")
        .when((whale < DISTRIBUTE_WHALE) | (bullish < DISTRIBUTE_BULLISH), "DISTRIBUTING")
        .otherwise("NEUTRAL")
    )


def top_coins(
    candles: DataFrame,
    metrics: DataFrame,
    dim: DataFrame,
    n: int = 10,
    timeframe: str = "1d",
    adjust: bool = False,
    computed_at: Column | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """The top-N mart: ranked by score, equal scores by symbol id."""
    scored = score(combine(candles, metrics, dim, timeframe), None, adjust, single_task_rows)
    best = top_n(scored, [F.col("long_term_score").desc(), F.col("symbol_id").asc()], n)
    return (
        best.withColumn("signal", signal())
        .withColumn("timeframe", F.lit(timeframe))
        .withColumn("computed_at", F.current_timestamp() if computed_at is None else computed_at)
        .select(*[F.col(f.name).cast(f.dataType) for f in MART_TOP_COINS])
    )


def latest_snapshot(history: DataFrame, timeframe: str = "1d") -> DataFrame:
    """Rows of the newest run in a history table, by rank."""
    rows = history.filter(F.col("timeframe") == timeframe)
    newest = rows.agg(F.max("computed_at")).scalar()
    return rows.filter(F.col("computed_at") == newest).orderBy("rank")


def top_symbols(tickers: DataFrame, n: int = 100, code: str = "symbol", volume: str = "quoteVolume") -> DataFrame:
    """Most traded symbols of a ticker frame, by quote volume and then code."""
    return tickers.orderBy(F.col(volume).desc(), F.col(code).asc()).limit(n)
