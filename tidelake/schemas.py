"""One explicit schema per dataset; nothing in the engine infers a schema."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

AMOUNT = DecimalType(30, 12)   # prices, volumes, flows
PERCENT = DecimalType(18, 8)
RATIO = DecimalType(10, 6)
SCORE = DecimalType(10, 4)


def _struct(fields: str, types: dict[str, object]) -> StructType:
    """``"a:long b:string"`` -> StructType; every field nullable."""
    pairs = (item.split(":") for item in fields.split())
    return StructType([StructField(name, types[kind], True) for name, kind in pairs])


_T = {
    "long": LongType(),
    "int": IntegerType(),
    "string": StringType(),
    "bool": BooleanType(),
    "ts": TimestampType(),
    "amount": AMOUNT,
    "percent": PERCENT,
    "ratio": RATIO,
    "score": SCORE,
}

# --- fixed values: column names and order of the three CSV datasets -----------------
# Times of klines and tickers are epoch milliseconds, of trades epoch microseconds.
# Trades carry no symbol: it is part of the file name.
CSV_KLINES = _struct(
    "open_time:long open:string high:string low:string close:string volume:string "
    "close_time:long quote_asset_volume:string num_trades:long taker_buy_base_vol:string "
    "taker_buy_quote_vol:string ignore:string symbol:string open_time_dt:string",
    _T,
)
CSV_TRADES = _struct(
    "trade_id:long price:string qty:string quote_qty:string time:long "
    "is_buyer_maker:bool is_best_match:bool",
    _T,
)
CSV_TICKER = _struct(
    "symbol:string priceChange:string priceChangePercent:string weightedAvgPrice:string "
    "prevClosePrice:string lastPrice:string lastQty:string bidPrice:string bidQty:string "
    "askPrice:string askQty:string openPrice:string highPrice:string lowPrice:string "
    "volume:string quoteVolume:string openTime:long closeTime:long firstId:long "
    "lastId:long count:long",
    _T,
)

# --- fixed values: JSON value of one streamed 1-minute candle ------------------------
STREAM_CANDLE = _struct(
    "symbol_id:long open_time:ts close_time:ts open_price:amount high_price:amount "
    "low_price:amount close_price:amount volume_base:amount volume_quote:amount "
    "num_trades:long taker_buy_quote_volume:amount",
    _T,
)
# The same with what tells versions of one candle apart, where a producer sends it.
STREAM_VERSIONS = StructType([
    *STREAM_CANDLE.fields,
    StructField("is_closed", BooleanType()),
    StructField("event_time", LongType()),
])

# --- raw (bronze) and normalised (silver) records per topic; numerics are text at rest
RAW_KLINE = _struct(
    "symbol:string event_time:long open_time:long close_time:long interval:string "
    "open:string high:string low:string close:string volume:string quote_volume:string "
    "num_trades:long taker_buy_base_volume:string taker_buy_quote_volume:string "
    "is_closed:bool source:string timestamp:string",
    _T,
)
RAW_TICKER = _struct(
    "symbol:string event_time:long price_change:string price_change_pct:string "
    "weighted_avg_price:string prev_close_price:string last_price:string last_qty:string "
    "bid_price:string ask_price:string open_price:string high_price:string "
    "low_price:string volume:string quote_volume:string open_time:long close_time:long "
    "num_trades:long source:string timestamp:string",
    _T,
)
RAW_TRADE = _struct(
    "symbol:string event_time:long trade_id:long price:string qty:string quote_qty:string "
    "first_trade_id:long last_trade_id:long time:long is_buyer_maker:bool "
    "is_best_match:bool source:string timestamp:string",
    _T,
)
RAW = {"klines": RAW_KLINE, "ticker": RAW_TICKER, "trades": RAW_TRADE}

# --- warehouse tables ----------------------------------------------------------------
DIM_SYMBOLS = _struct(
    "symbol_id:long symbol_code:string base_asset:string quote_asset:string "
    "created_at:ts updated_at:ts",
    _T,
)
FACT_KLINES = _struct(
    "symbol_id:long interval_code:string open_time:ts close_time:ts open_price:amount "
    "high_price:amount low_price:amount close_price:amount volume_base:amount "
    "volume_quote:amount num_trades:long taker_buy_quote_volume:amount",
    _T,
)
FACT_TICKER = _struct(
    "symbol_id:long snapshot_time:ts price_change:amount price_change_percent:percent "
    "last_price:amount high_price:amount low_price:amount volume_base_24h:amount "
    "volume_quote_24h:amount trade_count:long ingested_at:ts",
    _T,
)
FACT_RECENT_TRADES = _struct(
    "symbol_id:long trade_id:long trade_time:ts price:amount qty_base:amount "
    "quote_qty:amount is_buyer_maker:bool is_best_match:bool ingested_at:ts",
    _T,
)
MART_TRADE_METRICS = _struct(
    "symbol_id:long total_buy_volume:amount total_sell_volume:amount money_flow:amount "
    "total_trades:long whale_threshold:amount whale_buy_volume:amount "
    "whale_sell_volume:amount whale_buy_ratio:ratio computed_at:ts",
    _T,
)
MART_TOP_COINS = _struct(
    "timeframe:string rank:int symbol_id:long symbol_code:string "
    "total_volume_quote:amount total_num_trades:long avg_taker_buy_ratio:ratio "
    "bullish_ratio:ratio volume_trend:score money_flow:amount whale_buy_ratio:ratio "
    "long_term_score:score signal:string computed_at:ts",
    _T,
)

# Declared keys and mandatory columns, for the quality checks and the merge sinks.
KEYS = {
    "dim_symbols": ["symbol_code"],
    "fact_klines": ["symbol_id", "interval_code", "open_time"],
    "fact_ticker_24h_snapshots": ["symbol_id", "snapshot_time"],
    "fact_recent_trades": ["symbol_id", "trade_id"],
    "mart_trade_metrics": ["symbol_id"],
    "mart_top_coins": ["timeframe", "rank", "computed_at"],
}
NOT_NULL = {
    "dim_symbols": ["symbol_id", "symbol_code"],
    "fact_klines": [
        "symbol_id", "interval_code", "open_time", "close_time",
        "open_price", "high_price", "low_price", "close_price",
    ],
    "fact_ticker_24h_snapshots": ["symbol_id", "snapshot_time"],
    "fact_recent_trades": ["symbol_id", "trade_id", "trade_time", "price", "qty_base"],
    "mart_trade_metrics": ["symbol_id"],
    "mart_top_coins": ["timeframe", "rank", "symbol_id", "symbol_code"],
}
