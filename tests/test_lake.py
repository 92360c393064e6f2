"""The batch fed from landed files: only new ones are read, in any division of the files."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import D, T, values
from tidelake.operators.contract import pin_text
from tidelake.plans import lake as L
from tidelake.plans.batch import Warehouse
from tidelake.plans.lake import Lake, run_from_lake
from tidelake.sources import manifest
from tidelake.streaming import landing

NOON = 1_704_110_400_000      # 2024-01-01 12:00


def kline(symbol, minute, close, trades, closed=True, **more):
    at = NOON + minute * 60_000
    return dict(symbol=symbol, event_time=at + 60_000, open_time=at, close_time=at + 59_999, interval="1m", open="1", high="9",
                low="1", close=str(close), volume="10", quote_volume="100", num_trades=trades, taker_buy_base_volume="1",
                taker_buy_quote_volume="40", is_closed=closed, **more)


def ticker(symbol, hour, n=3):
    at = NOON + hour * 3_600_000
    return dict(symbol=symbol, event_time=at + 5, last_price="2", high_price="3", num_trades=n, open_time=at - 86_400_000, close_time=at)


def trade(symbol, number, amount, **more):
    return dict(symbol=symbol, event_time=NOON, time=NOON + number, trade_id=number, price=str(amount), qty="1", is_buyer_maker=False, **more)


FIRST = {
    "klines": [kline("BTCUSDT", 0, 5, 7), kline("ETHUSDT", 0, 4, 3, closed=False)],
    "ticker": [ticker("BTCUSDT", 0), ticker("ETHUSDT", 0)],
    "trades": [trade("BTCUSDT", i, 1) for i in range(20)] + [trade("BTCUSDT", 20, 100)],
}
SECOND = {
    # an unfinished candle comes again, a finished one for the first time
    "klines": [kline("BTCUSDT", 0, 8, 2, closed=False), kline("ETHUSDT", 0, 6, 9), kline("ETHUSDT", 1, 7, 1)],
    "ticker": [ticker("ETHUSDT", 1), ticker("SOLUSDT", 0)],
    "trades": [trade("BTCUSDT", 20, 100), trade("BTCUSDT", 21, 90), trade("SOLUSDT", 1, 4)],
}


def land(spark, lake, records):
    for dataset, rows in records.items():
        messages = spark.createDataFrame([(json.dumps(r), None) for r in rows], "value string, timestamp timestamp")
        messages = messages.withColumn("timestamp", F.lit("2024-01-01 12:00:00").cast("timestamp"))
        if lake.layer == "silver":
            out, kind = pin_text(landing.records(messages, dataset), dataset), "parquet"
        else:
            out, kind = landing.originals(messages, dataset), "text"
        out.write.mode("append").partitionBy(*landing.LAYOUT).format(kind).save(lake.folder(dataset))


def state(spark, warehouse):
    facts = warehouse.klines.read(spark).filter("interval_code IN ('1m', '1d')")
    return [
        values(warehouse.dim(spark), "symbol_id", "symbol_code"),
        values(facts, "symbol_id", "interval_code", "open_time", "close_price", "num_trades"),
        values(warehouse.metrics(spark), "symbol_id", "total_trades", "total_buy_volume", "whale_buy_volume"),
        values(warehouse.tickers.read(spark), "symbol_id", "snapshot_time", "trade_count"),
    ]


def now():
    return F.lit("2024-02-01").cast("timestamp")


def run(spark, lake, warehouse):
    return run_from_lake(spark, lake, warehouse, now=now())


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """What one run over all files gives, by layer."""
    out = {}
    for layer in ("silver", "bronze"):
        at = tmp_path_factory.mktemp(layer)
        lake, warehouse = Lake(f"{at}/lake", layer), Warehouse(f"{at}/wh")
        for part in (FIRST, SECOND):
            land(spark, lake, part)
        run(spark, lake, warehouse)
        out[layer] = state(spark, warehouse)
    return out


def test_one_run_over_either_layer(whole):
    assert whole["silver"] == whole["bronze"]
    dim, facts, metrics, tickers = whole["silver"]
    assert [c for _, c in dim] == ["BTCUSDT", "ETHUSDT", "SOLUSDT"]
    minutes = [f for f in facts if f[1] == "1m"]
    assert minutes == [(1, "1m", T("2024-01-01T12:00"), D(5), 7), (2, "1m", T("2024-01-01T12:00"), D(6), 9), (2, "1m", T("2024-01-01T12:01"), D(7), 1)]
    assert metrics == [(1, 22, D(210), D(190)), (3, 1, D(4), D(0))]
    # the snapshot has the hour of its folder
    assert tickers == [(1, T("2024-01-01T12:00"), 3), (2, T("2024-01-01T12:00"), 3), (2, T("2024-01-01T13:00"), 3), (3, T("2024-01-01T12:00"), 3)]


@pytest.mark.parametrize("layer", ["silver", "bronze"])
def test_second_run_opens_no_old_file(spark, tmp_path, whole, layer):
    lake, warehouse = Lake(str(tmp_path / "lake"), layer), Warehouse(str(tmp_path / "wh"))
    land(spark, lake, FIRST)
    run(spark, lake, warehouse)
    old = [p for p in Path(tmp_path / "lake").rglob("part-*")]
    land(spark, lake, SECOND)
    for p in old:
        p.unlink()              # whoever reads them now fails or loses their rows
    assert run(spark, lake, warehouse) is not None
    assert state(spark, warehouse) == whole[layer]
    assert run(spark, lake, warehouse) is None
    assert manifest.read_manifest(spark, warehouse.path(f"_files_{layer}")).count() == len(old) + len(list(Path(tmp_path / "lake").rglob("part-*")))


def test_a_run_that_dies_is_repeated(spark, tmp_path, whole, monkeypatch):
    lake, warehouse = Lake(str(tmp_path / "lake")), Warehouse(str(tmp_path / "wh"))
    land(spark, lake, FIRST)

    def dies(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(L.manifest, "publish", dies)
        with pytest.raises(OSError):
            run(spark, lake, warehouse)
    land(spark, lake, SECOND)
    run(spark, lake, warehouse)
    assert state(spark, warehouse) == whole["silver"]


def test_a_run_without_tickers_keeps_the_dimension(spark, tmp_path):
    lake, warehouse = Lake(str(tmp_path / "lake")), Warehouse(str(tmp_path / "wh"))
    land(spark, lake, {"klines": FIRST["klines"]})
    with pytest.raises(FileNotFoundError):
        run(spark, lake, warehouse)
    land(spark, lake, {"ticker": FIRST["ticker"]})
    run(spark, lake, warehouse)
    land(spark, lake, {"klines": SECOND["klines"]})
    done = run(spark, lake, warehouse)
    assert "fact_ticker_24h_snapshots" not in done.timings and warehouse.klines.read(spark).filter("interval_code = '1m'").count() == 3


def test_a_changed_file_is_read_again(spark, tmp_path):
    folder = tmp_path / "silver"
    spark.range(3).coalesce(1).write.parquet(str(folder))
    found = manifest.listed(spark, str(folder), "x")
    manifest.publish(spark, str(tmp_path / "list"), found)
    assert manifest.unread(manifest.listed(spark, str(folder), "x"), manifest.read_manifest(spark, str(tmp_path / "list"))).isEmpty()
    spark.range(500).coalesce(1).write.mode("overwrite").parquet(str(folder))
    again = manifest.unread(manifest.listed(spark, str(folder), "x"), manifest.read_manifest(spark, str(tmp_path / "list")))
    assert again.count() == 1 and manifest.listed(spark, str(tmp_path / "none"), "x") is None
