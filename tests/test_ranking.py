from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import D, T, candle, candles, values
from tidelake import schemas
from tidelake.operators import ranking

COMBINED = (
    "symbol_id long, total_volume_quote decimal(30,12), avg_taker_buy_ratio double, "
    "money_flow_filled double, whale_buy_ratio double, bullish_ratio double, "
    "volume_trend decimal(10,4), whale_ratio_raw double"
)


def days(symbol, *volumes, **how):
    return [candle(symbol, f"2024-01-{i:02d}T00:00:00", vq=v, interval="1d", **how) for i, v in enumerate(volumes, 1)]


def test_halves_of_one_two_and_three_candles(spark):
    df = candles(spark, *days(1, 5), *days(2, 5, 6), *days(3, 5, 6, 7))
    halves = ranking.with_half(ranking.number_candles(df))
    counts = halves.groupBy("symbol_id", "half").count()
    assert values(counts) == [
        (1, "second", 1), (2, "first", 1), (2, "second", 1), (3, "first", 1), (3, "second", 2),
    ]


def test_volume_trend(spark):
    df = candles(spark, *days(1, 5), *days(2, 10, 15), *days(3, 4, 6, 8), *days(4, 0, 9), *days(5, 1, 10**7))
    got = dict(values(ranking.volume_trend(df), "symbol_id", "volume_trend"))
    # one candle, and an empty first half: 1.0; a ratio beyond the type: unknown
    assert got == {1: D("1.0000"), 2: D("1.5000"), 3: D("1.7500"), 4: D("1.0000"), 5: None}


def test_fine_intervals_are_numbered_by_range_with_the_same_result(spark):
    df = candles(spark, *days(1, 5, 6, 7, 8), *days(2, 1, 2))
    assert values(ranking.number_candles(df, "1m")) == values(ranking.number_candles(df, "1d"))


def test_candle_totals(spark):
    df = candles(
        spark,
        candle(1, "2024-01-01T00:00:00", o=1, c=2, vq=100, taker=25, n=3),
        candle(1, "2024-01-02T00:00:00", o=2, c=2, vq=0, taker=9, n=4),
        candle(1, "2024-01-03T00:00:00", o=2, c=1, vq=100, taker=75, n=5),
    )
    row = ranking.candle_totals(df).first()
    assert (row.total_volume_quote, row.total_num_trades, row.candle_count) == (D(200), 12, 3)
    assert row.avg_taker_buy_ratio == D("0.5") and row.bullish_ratio == pytest.approx(1 / 3)


@pytest.mark.parametrize("whale,bullish,expected", [
    (0.60, 0.60, "NEUTRAL"), (0.61, 0.61, "ACCUMULATING"), (0.61, 0.60, "NEUTRAL"),
    (0.40, 0.35, "NEUTRAL"), (0.39, 0.90, "DISTRIBUTING"), (0.50, 0.34, "DISTRIBUTING"),
])
def test_signal_bounds_are_strict(spark, whale, bullish, expected):
    df = spark.createDataFrame([(whale, bullish)], "w double, b double")
    decimal = df.select(F.col("w").cast("decimal(10,6)").alias("w"), "b")
    assert df.select(ranking.signal("w", "b")).first()[0] == expected
    assert decimal.select(ranking.signal("w", "b")).first()[0] == expected


def scored(spark, rows, **how):
    df = spark.createDataFrame(rows, COMBINED)
    return {r.symbol_id: r.long_term_score for r in ranking.score(df, **how).collect()}


def test_score_is_the_weighted_sum_of_ranks(spark):
    rows = [(i, D(i), i / 10, float(i), i / 10, i / 10, D(1), None) for i in range(5)]
    assert scored(spark, rows) == pytest.approx({i: i / 4 for i in range(5)})
    only_volume = dict.fromkeys(ranking.WEIGHTS, 0.0) | {"total_volume_quote": 1.0}
    assert scored(spark, rows, weights=only_volume) == pytest.approx({i: i / 4 for i in range(5)})


def test_adjusted_score_is_clamped(spark):
    # best in everything and rising; worst with a low, measured whale ratio; filled whale
    rows = [
        (1, D(9), 0.9, 9.0, 0.9, 0.9, D("1.3"), 0.9),
        (2, D(1), 0.1, 1.0, 0.1, 0.1, D("1.0"), 0.1),
        (3, D(5), 0.5, 5.0, 0.5, 0.5, D("1.3"), None),
    ]
    assert scored(spark, rows, adjust=True) == pytest.approx({1: 1.0, 2: 0.0, 3: 0.55})
    assert scored(spark, rows) == pytest.approx({1: 1.0, 2: 0.0, 3: 0.5})


def dim(spark, *ids):
    return spark.createDataFrame([(i, f"S{i}") for i in ids], "symbol_id long, symbol_code string")


def metrics(spark, *rows):
    return spark.createDataFrame(list(rows), "symbol_id long, money_flow decimal(30,12), whale_buy_ratio decimal(10,6)")


def test_symbol_without_trades(spark):
    df = candles(spark, *days(1, 5, 6), *days(2, 7, 8))
    mart = ranking.top_coins(df, metrics(spark, (1, D(-3), D("0.7"))), dim(spark, 1, 2))
    assert mart.schema.simpleString() == schemas.MART_TOP_COINS.simpleString()
    row = {r.symbol_id: r for r in mart.collect()}[2]
    # whale ratio is filled for rank and output, money flow for the rank only
    assert row.whale_buy_ratio == D("0.5") and row.money_flow is None


def test_unknown_symbols_and_insane_times_are_left_out(spark):
    df = candles(spark, *days(1, 5), *days(2, 9), candle(3, "1999-01-01T00:00:00", interval="1d"))
    mart = ranking.top_coins(df, metrics(spark), dim(spark, 1, 3))
    assert [r.symbol_id for r in mart.collect()] == [1]


def test_equal_scores_are_ordered_by_id(spark):
    df = candles(spark, *days(2, 5), *days(1, 5), *days(3, 5))
    mart = ranking.top_coins(df, metrics(spark), dim(spark, 1, 2, 3), n=2)
    assert values(mart, "rank", "symbol_id") == [(1, 1), (2, 2)]


def test_latest_snapshot(spark):
    rows = [("1d", 2, T("2024-01-02")), ("1d", 1, T("2024-01-02")), ("1d", 1, T("2024-01-01")), ("4h", 1, T("2024-01-09"))]
    df = spark.createDataFrame(rows, "timeframe string, rank int, computed_at timestamp")
    assert [tuple(r) for r in ranking.latest_snapshot(df).collect()] == [rows[1], rows[0]]


def test_top_symbols(spark):
    df = spark.createDataFrame([("B", 5), ("A", 5), ("C", 9)], "symbol string, quoteVolume int")
    assert [r.symbol for r in ranking.top_symbols(df, 2).collect()] == ["C", "A"]
