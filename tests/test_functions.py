from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import D, T, values
from tidelake.functions import (
    amount, base_asset, bucket_start, from_micros, from_millis, in_universe, quote_asset,
    sane_time, share,
)
from tidelake.functions.symbols import QUOTE_ASSETS


def test_unreadable_numbers_are_null(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("nan",), ("",), (None,), ("1E3",)], "v string")
    assert [r[0] for r in df.select(amount("v")).collect()] == [D("1.5"), None, None, None, None, D(1000)]


def test_share_needs_a_positive_whole(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, -1.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(share("a", "b")).collect()] == [0.5, None, None, None]


def test_epoch_units_agree(spark):
    df = spark.createDataFrame([(1_704_067_200_123, 1_704_067_200_123_000)], "ms long, us long")
    row = df.select(from_millis("ms").alias("a"), from_micros("us").alias("b")).first()
    assert row.a == row.b == T("2024-01-01T00:00:00.123")


def test_milliseconds_read_as_seconds_are_not_sane(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-01' AS t UNION ALL SELECT timestamp'1999-12-31 23:59:59'"
        " UNION ALL SELECT timestamp_seconds(1704067200000) UNION ALL SELECT NULL"
    )
    assert df.filter(sane_time("t")).count() == 1


def test_bucket_start_equals_window(spark):
    df = spark.range(500).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 977)).alias("t")
    )
    for seconds in (300, 900, 1800, 3600, 14400, 86400):
        window = F.window("t", f"{seconds} seconds")["start"]
        assert df.filter(bucket_start("t", seconds) != window).count() == 0


def test_bucket_start_before_the_epoch(spark):
    df = spark.sql("SELECT timestamp'1969-12-31 23:59:59.5' AS t")
    assert df.select(bucket_start("t", 60)).first()[0] == T("1969-12-31T23:59:00")


def test_asset_split(spark):
    codes = ["ABCUSDT", "ABCFDUSD", "ABCBUSD", "ABCXYZ", "USDT", "BTCETH", None]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    got = [tuple(r) for r in df.select(base_asset("code"), quote_asset("code")).collect()]
    assert got == [
        ("ABC", "USDT"), ("ABC", "FDUSD"), ("ABC", "BUSD"), ("ABCXYZ", ""), ("", "USDT"),
        ("BTC", "ETH"), (None, None),
    ]


def test_no_quote_asset_ends_another():
    assert not [(a, b) for a in QUOTE_ASSETS for b in QUOTE_ASSETS if a != b and a.endswith(b)]


def test_universe(spark):
    rows = [("BTCUSDT", 1), ("BTCUPUSDT", 5), ("X3LUSDT", 5), ("ETHBTC", 5), ("ZEROUSDT", 0), ("NUSDT", None)]
    df = spark.createDataFrame(rows, "code string, v int")
    assert values(df.filter(in_universe("code", "v")), "code") == [("BTCUSDT",)]
