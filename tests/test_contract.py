from __future__ import annotations

import json

from pyspark.sql import functions as F

from tests.conftest import D, T, values
from tidelake import schemas
from tidelake.operators import contract


def test_alias_only_both_and_neither(spark):
    both = spark.createDataFrame(
        [("s", "new", "old"), ("t", None, "old")], "symbol string, quoteVolume string, quote_volume string"
    )
    assert values(contract.normalise(both, "ticker")) == [("s", "new"), ("t", "old")]
    only = spark.createDataFrame([("1",)], "taker_buy_quote_volume string")
    assert contract.normalise(only, "klines").columns == ["taker_buy_quote_vol"]
    none = spark.createDataFrame([("1",)], "price string")
    assert contract.normalise(none, "trades").columns == ["price"]


def test_both_spellings_of_the_percent_change(spark):
    for name in ("price_change_percent", "price_change_pct"):
        df = spark.createDataFrame([("1",)], f"{name} string")
        assert contract.normalise(df, "ticker").columns == ["priceChangePercent"]


def test_ingest_names_prefer_the_sent_field(spark):
    df = spark.createDataFrame(
        [("S", 1000, "new", "old")], "symbol string, event_time long, lastPrice string, last_price string"
    )
    assert contract.ingest_contract(df, "ticker", F.lit(0)).first().lastPrice == "old"


def test_event_time_choice(spark):
    day = 86_400_000
    trades = spark.createDataFrame(
        [(1, day, 2 * day), (2, None, 2 * day), (3, 0, 2 * day), (4, None, None)],
        "id long, event_time long, time long",
    )
    got = values(contract.ingest_contract(trades, "trades", F.lit(9 * day)), "id", "date", "hour", "symbol")
    assert got == [
        (1, "1970-01-02", "00", "UNKNOWN"), (2, "1970-01-03", "00", "UNKNOWN"),
        (3, "1970-01-03", "00", "UNKNOWN"), (4, "1970-01-10", "00", "UNKNOWN"),
    ]


def test_ticker_without_event_time_uses_the_fallback_column(spark):
    df = spark.createDataFrame([("A", None, 7_200_000)], "symbol string, event_time long, received long")
    row = contract.ingest_contract(df, "ticker", "received").first()
    assert (row.date, row.hour, row.event_ms) == ("1970-01-01", "02", 7_200_000)


def test_trade_time_taken_from_event_time(spark):
    df = spark.createDataFrame([(5, None), (6, 7)], "event_time long, time long")
    assert values(contract.ingest_contract(df, "trades", F.lit(0)), "time", "event_time") == [(5, None), (7, 6)]
    only = spark.createDataFrame([(5,)], "event_time long")
    assert "event_time" not in contract.ingest_contract(only, "trades", F.lit(0)).columns


def test_pin_text(spark):
    df = spark.createDataFrame([(1.5, 2, 3)], "price double, qty long, trade_id long")
    assert contract.pin_text(df, "trades").dtypes == [("price", "string"), ("qty", "string"), ("trade_id", "bigint")]


def payloads(spark, *objects):
    return spark.createDataFrame([(json.dumps(o),) for o in objects], "payload string")


def test_pushed_kline_keys_that_differ_by_case(spark):
    k = {"t": 60_000, "T": 119_999, "i": "1m", "o": "1", "h": "4", "l": "0.5", "c": "2", "v": "10",
         "q": "20", "V": "3", "Q": "6", "n": 7, "x": True}
    row = contract.parse_pushed_klines(payloads(spark, {"e": "kline", "E": 5, "s": "AUSDT", "k": k})).first()
    assert (row.symbol, row.event_time, row.open_time, row.close_time) == ("AUSDT", 5, 60_000, 119_999)
    assert (row.volume, row.quote_volume, row.taker_buy_base_volume, row.taker_buy_quote_volume) == ("10", "20", "3", "6")
    assert (row.num_trades, row.is_closed, row.interval) == (7, True, "1m")


def test_pushed_kline_defaults(spark):
    row = contract.parse_pushed_klines(payloads(spark, {"s": "A", "E": 1, "k": {"t": 1}})).first()
    assert (row.open, row.num_trades, row.is_closed, row.close_time) == ("0", 0, False, None)


def test_pushed_trade_product(spark):
    row = contract.parse_pushed_trades(
        payloads(spark, {"s": "A", "E": 1, "t": 2, "p": "1.10", "q": "3", "T": 4, "m": False, "M": True})
    ).first()
    assert D(row.quote_qty) == D("3.3") and row.is_buyer_maker is False and row.time == 4


def test_fetched_forms(spark):
    k = [60_000, "1", "2", "0.5", "1.5", "10", 119_999, "15", 4, "5", "7.5", "0"]
    df = spark.createDataFrame([("A", "1m", json.dumps([k, k]))], "symbol string, interval string, payload string")
    rows = contract.parse_fetched_klines(df).collect()
    assert len(rows) == 2 and rows[0].taker_buy_quote_volume == "7.5" and rows[0].is_closed
    t = {"a": 1, "p": "2", "q": "3", "f": 4, "l": 5, "T": 6, "m": True, "M": False}
    df = spark.createDataFrame([("A", json.dumps([t]))], "symbol string, payload string")
    row = contract.parse_fetched_trades(df).first()
    assert (row.trade_id, row.first_trade_id, row.last_trade_id, row.is_buyer_maker, row.is_best_match) == (1, 4, 5, True, False)
    # aggregate trades have no quote quantity: it becomes price x quantity
    facts = contract.trade_facts(contract.parse_fetched_trades(df).withColumn("symbol_id", F.lit(1)))
    assert facts.first().quote_qty == D(6)


def test_stream_messages(spark):
    good = {"symbol_id": 1, "open_time": "2026-04-08T14:13:00", "close_time": "2026-04-08T14:13:59.999",
            "open_price": "71516.48", "high_price": 71565.6, "num_trades": 2135}
    texts = [json.dumps(good), "{broken", "[]", json.dumps({"symbol_id": 2})]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = contract.parse_candles(df).collect()
    assert len(rows) == 1
    assert rows[0].open_price == D("71516.48") and rows[0].high_price == D("71565.6")
    assert rows[0].open_time == T("2026-04-08T14:13:00")


def test_kline_facts_reject_and_keep(spark):
    names = schemas.CSV_KLINES.fieldNames()
    base = {"open_time": 60_000, "close_time": 119_999, "open": "1", "high": "abc", "low": "", "close": "2",
            "volume": "3", "quote_asset_volume": "4", "num_trades": 5, "taker_buy_quote_vol": "6", "symbol": "A"}
    rows = [tuple({**base, **extra}.get(n) for n in names) for extra in ({}, {"open_time": None})]
    df = spark.createDataFrame(rows, schemas.CSV_KLINES).withColumn("symbol_id", F.lit(9).cast("long"))
    facts = contract.kline_facts(df)
    assert facts.schema.simpleString() == schemas.FACT_KLINES.simpleString() and facts.count() == 1
    row = facts.first()
    assert row.high_price is None and row.low_price is None and row.volume_quote == D(4)


def test_ticker_hour_is_that_of_the_window_start(spark):
    names = schemas.CSV_TICKER.fieldNames()
    record = {"symbol": "A", "openTime": 3_600_000 + 59 * 60_000, "closeTime": 90_000_000, "count": 3, "priceChangePercent": "1.23456789"}
    df = spark.createDataFrame([tuple(record.get(n) for n in names)], schemas.CSV_TICKER).withColumn("symbol_id", F.lit(1).cast("long"))
    row = contract.ticker_facts(df).first()
    assert row.snapshot_time == T("1970-01-01T01:00:00") and row.price_change_percent == D("1.23456789")
    assert contract.ticker_facts(df, hour_of="closeTime").first().snapshot_time == T("1970-01-02T01:00:00")


def test_products_stay_exact(spark):
    df = spark.createDataFrame([("0.000000123456", "1000000"), ("70000.12", "1234.5"), ("x", "1")], "p string, q string")
    got = [r[0] for r in df.select(contract.times("p", "q")).collect()]
    assert got == [D("0.123456"), D("86415148.14"), None]


def test_pushed_ticker_null_is_no_default(spark):
    # a missing field has its default, one that is null stays NULL
    rows = contract.parse_pushed_tickers(payloads(
        spark, {"s": "A", "E": 1, "p": "2", "P": None}, {"s": "B", "E": 1, "p": "2"}, {"s": "C", "P": "3.5"})).collect()
    assert [(r.symbol, r.price_change, r.price_change_pct) for r in rows] == [("A", "2", None), ("B", "2", "0"), ("C", "0", "3.5")]
