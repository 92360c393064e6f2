"""Field-name contracts: aliases, ingest rules, wire formats and typed projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake.functions import amount, as_decimal, from_micros, from_millis, utc_date, utc_hour
from tidelake.operators.filters import require
from tidelake.schemas import (
    AMOUNT, FACT_KLINES, FACT_TICKER, PERCENT, RAW, STREAM_CANDLE, STREAM_VERSIONS,
)

UNKNOWN_SYMBOL = "UNKNOWN"

# --- fixed values: names readers accept (alias -> canonical), per dataset -------------
READ_ALIASES = {
    "klines": {"taker_buy_quote_volume": "taker_buy_quote_vol"},
    "ticker": {
        "price_change": "priceChange",
        "price_change_percent": "priceChangePercent",
        "price_change_pct": "priceChangePercent",
        "last_price": "lastPrice",
        "high_price": "highPrice",
        "low_price": "lowPrice",
        "quote_volume": "quoteVolume",
        "num_trades": "count",
    },
    "trades": {"quote_volume": "quote_qty"},
}
# --- fixed values: names the landing step restores (old -> new), per dataset ----------
INGEST_NAMES = {
    "klines": {"taker_buy_quote_volume": "taker_buy_quote_vol"},
    "ticker": {
        "price_change": "priceChange",
        "price_change_pct": "priceChangePercent",
        "weighted_avg_price": "weightedAvgPrice",
        "prev_close_price": "prevClosePrice",
        "last_price": "lastPrice",
        "last_qty": "lastQty",
        "bid_price": "bidPrice",
        "ask_price": "askPrice",
        "open_price": "openPrice",
        "high_price": "highPrice",
        "low_price": "lowPrice",
        "quote_volume": "quoteVolume",
        "num_trades": "count",
    },
    "trades": {},
}
# --- fixed values: where a record's event time is looked for, in order ----------------
EVENT_TIMES = {
    "klines": ("open_time", "t"),
    "ticker": ("event_time", "E"),
    "trades": ("event_time", "time", "E", "T"),
}
# --- fixed values: fields kept as text in silver, normalised and short wire names -----
TEXT_FIELDS = {
    "klines": (
        "open", "high", "low", "close", "volume", "quote_volume",
        "taker_buy_base_vol", "taker_buy_base_volume",
        "taker_buy_quote_vol", "taker_buy_quote_volume",
        "o", "h", "l", "c", "v", "q", "V", "Q",
    ),
    "ticker": (
        "priceChange", "priceChangePercent", "weightedAvgPrice", "prevClosePrice",
        "lastPrice", "lastQty", "bidPrice", "bidQty", "askPrice", "askQty",
        "openPrice", "highPrice", "lowPrice", "volume", "quoteVolume",
        "price_change", "price_change_pct", "weighted_avg_price", "prev_close_price",
        "last_price", "last_qty", "bid_price", "bid_qty", "ask_price", "ask_qty",
        "open_price", "high_price", "low_price", "quote_volume",
    ),
    "trades": ("price", "qty", "quoteQty", "quote_qty", "p", "q"),
}
# --- fixed values: short keys of pushed messages -> field -----------------------------
PUSHED_KLINE_TEXT = {
    "o": "open", "h": "high", "l": "low", "c": "close", "v": "volume", "q": "quote_volume",
    "V": "taker_buy_base_volume", "Q": "taker_buy_quote_volume",
}
PUSHED_TICKER_TEXT = {
    "p": "price_change", "P": "price_change_pct", "w": "weighted_avg_price",
    "x": "prev_close_price", "c": "last_price", "Q": "last_qty", "b": "bid_price",
    "a": "ask_price", "o": "open_price", "h": "high_price", "l": "low_price",
    "v": "volume", "q": "quote_volume",
}
PUSHED_KLINE_OTHER = {"t": "open_time", "T": "close_time", "i": "interval", "n": "num_trades", "x": "is_closed"}
PUSHED_TICKER_OTHER = {"O": "open_time", "C": "close_time", "n": "num_trades"}
PUSHED_TRADE = {"t": "trade_id", "p": "price", "q": "qty", "T": "time", "m": "is_buyer_maker"}
PUSHED_OUTER = {"s": "symbol", "E": "event_time"}
# --- fixed values: positions in a fetched candle array -> field -----------------------
FETCHED_KLINE = (
    "open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume",
    "num_trades", "taker_buy_base_volume", "taker_buy_quote_volume",
)
# --- fixed values: keys of a fetched ticker object that stay text -> field ------------
FETCHED_TICKER_TEXT = {
    "priceChange": "price_change", "priceChangePercent": "price_change_pct",
    "weightedAvgPrice": "weighted_avg_price", "prevClosePrice": "prev_close_price",
    "lastPrice": "last_price", "lastQty": "last_qty", "bidPrice": "bid_price",
    "askPrice": "ask_price", "openPrice": "open_price", "highPrice": "high_price",
    "lowPrice": "low_price", "volume": "volume", "quoteVolume": "quote_volume",
}


# ---------------------------------------------------------------- names and pinning

def resolve_aliases(df: DataFrame, names: dict[str, str], alias_first: bool = False) -> DataFrame:
    """Give every alias its canonical name in one projection.

    Where several columns mean the same field they are coalesced, the canonical one
    first (``alias_first`` reverses that), and the aliases dropped.
    """
    groups: dict[str, list[str]] = {}
    for column in df.columns:
        groups.setdefault(names.get(column, column), []).append(column)

    def merged(target: str, columns: list[str]) -> Column:
        columns = sorted(columns, key=lambda c: (c == target) == alias_first)
        parts = [F.col(f"`{c}`") for c in columns]
        return (parts[0] if len(parts) == 1 else F.coalesce(*parts)).alias(target)

    return df.select(*[merged(t, cs) for t, cs in groups.items()])


def normalise(df: DataFrame, dataset: str) -> DataFrame:
    """Reader-side aliases of one dataset."""
    return resolve_aliases(df, READ_ALIASES[dataset])


def pin_text(df: DataFrame, dataset: str) -> DataFrame:
    """Numeric fields as text, whatever the producer sent."""
    wanted = set(TEXT_FIELDS[dataset])
    return df.select(
        *[F.col(f"`{c}`").cast("string").alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns]
    )


# ---------------------------------------------------------------------------- ingest

def ingest_contract(df: DataFrame, dataset: str, fallback: Column | str) -> DataFrame:
    """Restore field names and derive ``event_ms``, ``date``, ``hour`` and ``symbol``.

    ``fallback`` is the epoch-millisecond time for records that carry none (broker or
    load time). It is a column, so repeating a load gives the same partitions. A time
    of 0 counts as missing, and a missing symbol becomes ``UNKNOWN``.
    """
    present = [c for c in EVENT_TIMES[dataset] if c in df.columns]
    candidates = [F.when(F.col(c) != 0, F.col(c).cast("long")) for c in present]
    last = F.col(fallback) if isinstance(fallback, str) else fallback
    df = df.withColumn("event_ms", F.coalesce(*candidates, last.cast("long")))
    if dataset == "trades" and "event_time" in df.columns:
        if "time" in df.columns:
            moved = F.col("time").isNull()
            df = df.withColumns({
                "time": F.coalesce("time", "event_time"),
                "event_time": F.when(~moved, F.col("event_time")),
            })
        else:
            df = df.withColumnRenamed("event_time", "time")
    df = resolve_aliases(df, INGEST_NAMES[dataset], alias_first=True)
    if "symbol" not in df.columns:
        df = df.withColumn("symbol", F.lit(None).cast("string"))
    return partition_keys(df, from_millis("event_ms"))


def partition_keys(df: DataFrame, at: Column | str) -> DataFrame:
    """UTC date and hour of ``at``, and a symbol that is never NULL."""
    return df.withColumns({
        "symbol": F.coalesce(F.col("symbol"), F.lit(UNKNOWN_SYMBOL)),
        "date": utc_date(at).cast("string"),
        "hour": utc_hour(at),
    })


# --------------------------------------------------------------------- wire formats
# Short keys differ only by case (t/T, q/Q), so objects are read as maps, whose keys
# are compared exactly; as struct fields they would be ambiguous.

def _object(payload: Column) -> Column:
    return F.from_json(payload, "map<string,string>")


def _text(message: Column, key: str, default: str) -> Column:
    """The text under ``key``; ``default`` if the message lacks the key, NULL if it has null there."""
    return F.when(F.map_contains_key(message, F.lit(key)), message[key]).otherwise(F.lit(default))


def _long(field: Column) -> Column:
    return field.try_cast("long")


def _zero(field: Column) -> Column:
    return F.coalesce(_long(field), F.lit(0).cast("long"))


_SHORT = {
    "klines": PUSHED_OUTER,
    "ticker": {**PUSHED_OUTER, **PUSHED_TICKER_TEXT, **PUSHED_TICKER_OTHER},
    "trades": {**PUSHED_OUTER, **PUSHED_TRADE},
}
_SHORT_CANDLE = {**PUSHED_KLINE_TEXT, **PUSHED_KLINE_OTHER}


def message_fields(df: DataFrame, dataset: str, payload: str) -> DataFrame:
    """``df`` plus ``_readable`` and the fields of one dataset, from messages with long or with
    short keys. A message is parsed once, as a map; what is no JSON object is not readable,
    and a field of another type than the dataset's is NULL."""
    m, inner = F.col("_m"), F.col("_k")
    df = df.withColumn("_m", _object(F.col(payload))).withColumn("_readable", F.col("_m").isNotNull())
    if dataset == "klines":
        df = df.withColumn("_k", _object(m["k"]))

    def field(name: str) -> Column:
        places = [m[name], *[m[key] for key, long in _SHORT[dataset].items() if long == name]]
        if dataset == "klines":
            places += [inner[key] for key, long in _SHORT_CANDLE.items() if long == name]
        return F.coalesce(*places) if len(places) > 1 else places[0]

    return df.select(
        *[c for c in df.columns if c not in ("_m", "_k")],
        *[field(f.name).try_cast(f.dataType).alias(f.name) for f in RAW[dataset]],
    )


def parse_pushed_klines(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Socket candle messages: outer symbol and event time, candle in the ``k`` object."""
    outer = df.select("*", _object(F.col(payload)).alias("_m"))
    inner = outer.withColumn("_k", _object(F.col("_m")["k"]))
    k, m = F.col("_k"), F.col("_m")
    return inner.select(
        m["s"].alias("symbol"),
        _long(m["E"]).alias("event_time"),
        _long(k["t"]).alias("open_time"),
        _long(k["T"]).alias("close_time"),
        k["i"].alias("interval"),
        *[_text(k, key, "0").alias(name) for key, name in PUSHED_KLINE_TEXT.items()],
        _zero(k["n"]).alias("num_trades"),
        F.coalesce(k["x"].try_cast("boolean"), F.lit(False)).alias("is_closed"),
        F.lit("websocket").alias("source"),
    )


def parse_pushed_tickers(df: DataFrame, payload: str = "payload") -> DataFrame:
    m = F.col("_m")
    return df.select(_object(F.col(payload)).alias("_m")).select(
        m["s"].alias("symbol"),
        _long(m["E"]).alias("event_time"),
        *[_text(m, key, "0").alias(name) for key, name in PUSHED_TICKER_TEXT.items()],
        _long(m["O"]).alias("open_time"),
        _long(m["C"]).alias("close_time"),
        _zero(m["n"]).alias("num_trades"),
        F.lit("websocket").alias("source"),
    )


def parse_pushed_trades(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Socket trades; the quote quantity is price times quantity."""
    m = F.col("_m")
    price, qty = _text(m, "p", "0"), _text(m, "q", "0")
    return df.select(_object(F.col(payload)).alias("_m")).select(
        m["s"].alias("symbol"),
        _long(m["E"]).alias("event_time"),
        _long(m["t"]).alias("trade_id"),
        price.alias("price"),
        qty.alias("qty"),
        times(price, qty).cast("string").alias("quote_qty"),
        _long(m["T"]).alias("time"),
        m["m"].try_cast("boolean").alias("is_buyer_maker"),
        F.lit("websocket").alias("source"),
    )


def parse_fetched_klines(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A response is an array of candle arrays; needs columns ``symbol`` and ``interval``."""
    rows = df.select(
        "symbol", "interval",
        F.explode(F.from_json(payload, "array<array<string>>")).alias("_a"),
    )
    longs = {"open_time", "close_time", "num_trades"}
    fields = [
        (_long(F.col("_a")[i]) if name in longs else F.col("_a")[i]).alias(name)
        for i, name in enumerate(FETCHED_KLINE)
    ]
    return rows.select(
        "symbol", "interval", *fields,
        F.lit(True).alias("is_closed"),
        F.lit(None).cast("long").alias("event_time"),
        F.lit("rest_historical").alias("source"),
    )


def parse_fetched_tickers(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A response is an array of ticker objects."""
    t = F.col("_t")
    return df.select(
        F.explode(F.from_json(payload, "array<map<string,string>>")).alias("_t")
    ).select(
        t["symbol"].alias("symbol"),
        *[t[key].alias(name) for key, name in FETCHED_TICKER_TEXT.items()],
        _long(t["openTime"]).alias("open_time"),
        _long(t["closeTime"]).alias("close_time"),
        _long(t["count"]).alias("num_trades"),
        F.lit(None).cast("long").alias("event_time"),
        F.lit("rest_snapshot").alias("source"),
    )


def parse_fetched_trades(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Aggregate trades: an array of short-key objects; needs column ``symbol``."""
    t = F.col("_t")
    return df.select(
        "symbol", F.explode(F.from_json(payload, "array<map<string,string>>")).alias("_t")
    ).select(
        "symbol",
        _long(t["a"]).alias("trade_id"),
        t["p"].alias("price"),
        t["q"].alias("qty"),
        _long(t["f"]).alias("first_trade_id"),
        _long(t["l"]).alias("last_trade_id"),
        _long(t["T"]).alias("time"),
        t["m"].try_cast("boolean").alias("is_buyer_maker"),
        t["M"].try_cast("boolean").alias("is_best_match"),
        F.lit("rest_agg_trade").alias("source"),
    )


def parse_json(
    df: DataFrame, schema: StructType | str = STREAM_CANDLE, value: str = "value"
) -> DataFrame:
    """JSON value to flat columns; a malformed value gives a row of NULLs."""
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return df.select(parsed.alias("d")).select("d.*")


def parse_candles(df: DataFrame, value: str = "value") -> DataFrame:
    return require(parse_json(df, STREAM_VERSIONS, value), "symbol_id", "open_time")


# ----------------------------------------------------------------- typed projections

def times(price: Column | str, qty: Column | str) -> Column:
    """price x quantity as an amount.

    Factors keep 12 places and must stay below 10^12, so that Spark has room for 13
    places of their product; with wider factors it would round to 6.
    """
    narrow = "decimal(24,12)"
    p = F.col(price) if isinstance(price, str) else price
    q = F.col(qty) if isinstance(qty, str) else qty
    return (p.try_cast(narrow) * q.try_cast(narrow)).try_cast(AMOUNT)


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


# What tells versions of a candle apart, where records carry it.
VERSION_FIELDS = ("is_closed", "event_time")


def kline_facts(raw: DataFrame, interval: str = "1m", versions: bool = False) -> DataFrame:
    """CSV or normalised kline records, already carrying symbol_id, as fact rows; with
    ``versions`` also those of :data:`VERSION_FIELDS` that there are."""
    further = [c for c in VERSION_FIELDS if versions and c in raw.columns]
    quote = "quote_asset_volume" if "quote_asset_volume" in raw.columns else "quote_volume"
    facts = raw.select(
        "symbol_id",
        F.lit(interval).alias("interval_code"),
        from_millis("open_time").alias("open_time"),
        from_millis("close_time").alias("close_time"),
        amount("open").alias("open_price"),
        amount("high").alias("high_price"),
        amount("low").alias("low_price"),
        amount("close").alias("close_price"),
        amount("volume").alias("volume_base"),
        amount(quote).alias("volume_quote"),
        F.col("num_trades").try_cast("long").alias("num_trades"),
        amount("taker_buy_quote_vol").alias("taker_buy_quote_volume"),
        *further,
    )
    typed = [F.col(f.name).cast(f.dataType) for f in FACT_KLINES]
    return require(facts.select(*typed, *further), "open_time")


def ticker_facts(
    raw: DataFrame, ingested_at: Column | None = None, hour_of: str = "openTime", at: Column | None = None
) -> DataFrame:
    """Ticker records as hourly snapshots; the hour is that of the window's start, or of the
    time ``at``, such as that of the record's folder."""
    facts = raw.select(
        "symbol_id",
        F.date_trunc("hour", from_millis(hour_of) if at is None else at).alias("snapshot_time"),
        amount("priceChange").alias("price_change"),
        as_decimal("priceChangePercent", PERCENT).alias("price_change_percent"),
        amount("lastPrice").alias("last_price"),
        amount("highPrice").alias("high_price"),
        amount("lowPrice").alias("low_price"),
        amount("volume").alias("volume_base_24h"),
        amount("quoteVolume").alias("volume_quote_24h"),
        F.col("count").try_cast("long").alias("trade_count"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )
    return require(_typed(facts, FACT_TICKER), "snapshot_time")


def trade_facts(raw: DataFrame) -> DataFrame:
    """Trade records as (symbol_id, quote_qty, is_buyer_maker).

    Aggregate trades carry no quote quantity; for them it is price times quantity.
    """
    quote = amount("quote_qty") if "quote_qty" in raw.columns else F.lit(None).cast(AMOUNT)
    facts = raw.select(
        "symbol_id",
        F.coalesce(quote, times("price", "qty")).alias("quote_qty"),
        F.col("is_buyer_maker").try_cast("boolean").alias("is_buyer_maker"),
    )
    return require(facts, "quote_qty")


def recent_trades(raw: DataFrame, ingested_at: Column | None = None, unit: str = "us") -> DataFrame:
    """Trade records as rows of the recent-trades table."""
    at = from_micros("time") if unit == "us" else from_millis("time")
    return raw.select(
        "symbol_id",
        "trade_id",
        at.alias("trade_time"),
        amount("price").alias("price"),
        amount("qty").alias("qty_base"),
        F.coalesce(amount("quote_qty"), times("price", "qty")).alias("quote_qty"),
        "is_buyer_maker",
        "is_best_match",
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )
