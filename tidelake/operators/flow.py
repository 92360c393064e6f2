"""Money flow and whale (large trade) metrics per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidelake.functions import share
from tidelake.operators.skew import BROADCAST_ROWS, HOT_ROWS, lookup_join
from tidelake.schemas import AMOUNT, MART_TRADE_METRICS
from tidelake.session import materialize

# fixed values: a whale trade exceeds mean + 2 sigma and three times the mean
SIGMAS, MEANS = 2.0, 3.0

_SUM = DecimalType(38, 12)


def _sum_if(condition: Column) -> Column:
    """Sum of quote_qty where the condition holds; unknown maker flags add nothing.

    Other rows are NULL rather than 0, which spares the decimal addition.
    """
    total = F.sum(F.when(condition, F.col("quote_qty")))
    return F.coalesce(total, F.lit(0)).cast(AMOUNT)


def whale_threshold(average: Column, deviation: Column) -> Column:
    """In double precision; a single trade has no deviation, which counts as 0."""
    spread = F.coalesce(deviation, F.lit(0.0))
    mean = average.cast("double")
    return F.greatest(mean + F.lit(SIGMAS) * spread, mean * F.lit(MEANS))


def trade_totals(trades: DataFrame) -> DataFrame:
    """Everything that needs no threshold, plus the threshold itself, in one pass.

    Fully combined on the map side, so the shuffle carries one row per symbol and task.
    """
    sold = F.col("is_buyer_maker")
    return trades.groupBy("symbol_id").agg(
        _sum_if(~sold).alias("total_buy_volume"),
        _sum_if(sold).alias("total_sell_volume"),
        F.count(F.lit(1)).alias("total_trades"),
        whale_threshold(F.avg("quote_qty"), F.stddev_samp("quote_qty")).alias("whale_threshold"),
    )


def whale_volumes(
    trades: DataFrame,
    totals: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Bought and sold volume of trades strictly above their symbol's threshold.

    ``totals`` must be stored. Rows are filtered right after the lookup, so only whale
    trades reach the aggregate.
    """
    sold = F.col("is_buyer_maker")
    limits = totals.select("symbol_id", "whale_threshold", "total_trades")
    return (
        lookup_join(
            trades.select("symbol_id", "quote_qty", "is_buyer_maker"),
            limits, ["symbol_id"], "total_trades", broadcast_rows, hot_rows,
        )
        .filter(F.col("quote_qty").cast("double") > F.col("whale_threshold"))
        .groupBy("symbol_id")
        .agg(
            _sum_if(~sold).alias("whale_buy_volume"),
            _sum_if(sold).alias("whale_sell_volume"),
        )
    )


def trade_metrics(
    trades: DataFrame,
    computed_at: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The trade-metrics mart: one row per symbol from (symbol_id, quote_qty, is_buyer_maker).

    Trades are scanned twice and never shuffled as rows; the per-symbol totals are stored
    in between, which is also where their size is checked.
    """
    totals = materialize(trade_totals(trades), "trade-totals")
    whales = whale_volumes(trades, totals, broadcast_rows, hot_rows)
    zero = F.lit(0).cast(AMOUNT)
    # As wide as sums are: Spark then divides straight to 6 places, without rounding twice.
    bought = F.col("whale_buy_volume").cast(_SUM)
    sold = F.col("whale_sell_volume").cast(_SUM)
    return (
        totals.join(whales, "symbol_id", "left")
        .withColumn("whale_buy_volume", F.coalesce("whale_buy_volume", zero))
        .withColumn("whale_sell_volume", F.coalesce("whale_sell_volume", zero))
        .withColumn("money_flow", F.col("total_buy_volume") - F.col("total_sell_volume"))
        .withColumn("whale_buy_ratio", share(bought, bought + sold))
        .withColumn("computed_at", F.current_timestamp() if computed_at is None else computed_at)
        .select(*[F.col(f.name).cast(f.dataType) for f in MART_TRADE_METRICS])
    )
