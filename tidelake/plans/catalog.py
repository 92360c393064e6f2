"""The named queries: each a Spark plan over the test tables, most with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from tidelake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame, **digits: int) -> DataFrame:
    """Decimals as doubles (2 places unless named), timestamps without zone: values that
    compare equal across engines."""
    out = []
    for f in df.schema:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            col = F.round(col.cast("double"), digits.get(f.name, 2))
        elif f.name in digits:
            col = F.round(col, digits[f.name])
        elif isinstance(f.dataType, TimestampType):
            col = col.cast("timestamp_ntz")
        out.append(col.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, **digits: int):
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(use_utc(spark), sf_dir.rstrip("/")), **digits)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


# ------------------------------------------------------------------- shared SQL parts

TICKS = """ticks AS (
  SELECT user_id AS symbol_id, ts, event_id, CAST(epoch_us(ts) AS HUGEINT) * 100000000000 + event_id AS tick_order, CAST(value AS DECIMAL(18,2)) AS price, event_type,
         event_type IN ('click', 'purchase') AS taker
  FROM events)"""

TRADES = """trades AS (
  SELECT l_suppkey AS symbol_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(10,0)) AS q,
         l_returnflag = 'R' AS maker
  FROM lineitem)"""

CODES = """codes AS (
  SELECT user_id AS symbol_id, 'U' || user_id ||
         CASE user_id % 6 WHEN 0 THEN 'USDT' WHEN 1 THEN 'BUSD' WHEN 2 THEN 'FDUSD'
                          WHEN 3 THEN 'BTC' WHEN 4 THEN 'ETH' ELSE 'XYZ' END AS symbol_code
  FROM (SELECT DISTINCT user_id FROM events))"""


def half_up(part: str, whole: str, places: int) -> str:
    """part / whole of two integers, rounded half up: an integer of 10^-places."""
    unit = 10**places
    return f"((2 * CAST({part} AS HUGEINT) * {unit} + {whole}) // (2 * CAST({whole} AS HUGEINT)))"


BUCKETS = {
    "1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "30m": "30 minutes",
    "1h": "1 hour", "4h": "4 hours", "1d": "1 day",
}


def candles_sql(interval: str, name: str = "candles") -> str:
    """Candles of an interval straight from ticks."""
    return f"""{name} AS (
  SELECT symbol_id, time_bucket(INTERVAL '{BUCKETS[interval]}', ts) AS open_time,
         time_bucket(INTERVAL '1 minute', max(ts)) + INTERVAL '59999 milliseconds' AS close_time,
         arg_min(price, tick_order) AS open_price, max(price) AS high_price,
         min(price) AS low_price, arg_max(price, tick_order) AS close_price,
         count(*) AS volume_base, sum(price) AS volume_quote, count(*) AS num_trades,
         sum(CASE WHEN taker THEN price ELSE 0 END) AS taker_buy_quote_volume
  FROM ticks GROUP BY 1, 2)"""


def candle_columns(interval: str, source: str = "candles") -> str:
    return f"""SELECT symbol_id, '{interval}' AS interval_code, open_time, close_time,
  CAST(open_price AS DOUBLE) AS open_price, CAST(high_price AS DOUBLE) AS high_price,
  CAST(low_price AS DOUBLE) AS low_price, CAST(close_price AS DOUBLE) AS close_price,
  CAST(volume_base AS DOUBLE) AS volume_base, CAST(volume_quote AS DOUBLE) AS volume_quote,
  num_trades, CAST(taker_buy_quote_volume AS DOUBLE) AS taker_buy_quote_volume
FROM {source}"""


def all_candles_sql(intervals, prefix: str = "WITH") -> str:
    """Union of several intervals."""
    parts = ",\n".join(candles_sql(i, f"c_{i}") for i in intervals)
    union = "\nUNION ALL\n".join(candle_columns(i, f"c_{i}") for i in intervals)
    return f"{prefix} {TICKS},\n{parts}\n{union}"
