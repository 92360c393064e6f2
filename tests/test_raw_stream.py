from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import D, T, candle, candles, values
from tests.test_streams import folder
from tidelake.sinks import tables
from tidelake.sources.topics import read_folder
from tidelake.streaming import candles as SC
from tidelake.streaming import raw

T0 = 1_704_067_200_000      # 2024-01-01


def long_message(symbol, minute, close="10", closed=True, **more):
    at = T0 + minute * 60_000
    return json.dumps({
        "symbol": symbol, "event_time": at + 60_000, "open_time": at, "close_time": at + 59_999, "interval": "1m",
        "open": "10", "high": "12", "low": "9", "close": close, "volume": "1", "quote_volume": "100",
        "num_trades": 3 if closed else 2, "taker_buy_quote_volume": "40", "is_closed": closed, **more})


def short_message(symbol, minute, close="10"):
    at = T0 + minute * 60_000
    k = {"t": at, "T": at + 59_999, "i": "1m", "n": 3, "x": True, "o": "10", "h": "12", "l": "9", "c": close,
         "v": "1", "q": "100", "V": "1", "Q": "40"}
    return json.dumps({"e": "kline", "E": at + 61_000, "s": symbol, "k": k})


def frame(spark, *messages):
    return spark.createDataFrame([(m,) for m in messages], "value string")


def dim(spark, **ids):
    return spark.createDataFrame([(n, code.replace("_", "/")) for code, n in ids.items()], "symbol_id long, symbol_code string")


def minutes(table, spark):
    return values(table.read(spark).filter("interval_code = '1m'"), "symbol_id", "open_time", "close_price")


def test_what_is_a_record(spark):
    rows = raw.records(frame(
        spark, long_message("A", 0), short_message("B", 1), "not json", '"text"', None, "",
        long_message("A", 2, interval="5m"), long_message("A", 3, interval=None), long_message(None, 4), long_message("", 5)))
    assert values(rows, "symbol", "open_time", "is_closed", "close") == [
        ("A", T0, True, "10"), ("A", T0 + 180_000, True, "10"), ("B", T0 + 60_000, True, "10")]


def test_unknown_symbols_wait_until_they_are_known(spark, tmp_path):
    table, kept = tables.fact_klines(str(tmp_path / "fact")), str(tmp_path / "waiting")

    def apply(n, known, *messages):
        raw.apply_raw(raw.records(frame(spark, *messages)), n, known, table, kept, ["1h"])

    def left():
        rows = raw.waiting(spark, kept, raw.records(frame(spark)).schema)
        return values(rows.groupBy("symbol").count())

    apply(0, dim(spark), long_message("A", 0), long_message("B/C d", 1))
    assert minutes(table, spark) == [] and left() == [("A", 1), ("B/C d", 1)]
    apply(0, dim(spark), long_message("A", 0), long_message("B/C d", 1))     # delivered again
    assert left() == [("A", 1), ("B/C d", 1)]
    # a newer version of a waiting minute, and one from before it was closed
    apply(1, dim(spark), short_message("A", 0, close="11"), long_message("A", 0, close="7", closed=False))
    apply(2, dim(spark, A=1), long_message("A", 2))
    assert left() == [("B/C d", 1)]
    assert minutes(table, spark) == [
        (1, T("2024-01-01T00:00:00"), D(11)), (1, T("2024-01-01T00:02:00"), D(10))]
    # a batch without any record still takes what is known by now
    known = spark.createDataFrame([(1, "A"), (2, "B/C d")], "symbol_id long, symbol_code string")
    apply(3, known)
    assert len(minutes(table, spark)) == 3
    hours = table.read(spark).filter("interval_code = '1h'")
    assert values(hours, "symbol_id", "num_trades") == [(1, 6), (2, 3)]


def test_a_run_that_dies_before_the_release_is_repeated(spark, tmp_path, monkeypatch):
    table, kept = tables.fact_klines(str(tmp_path / "fact")), str(tmp_path / "waiting")
    rows = raw.records(frame(spark, long_message("A", 0)))
    raw.apply_raw(rows, 0, dim(spark), table, kept, ["1h"])

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(raw, "_release", dies)
        with pytest.raises(RuntimeError, match="lost"):
            raw.apply_raw(raw.records(frame(spark, long_message("A", 1))), 1, dim(spark, A=1), table, kept, ["1h"])
    raw.apply_raw(raw.records(frame(spark, long_message("A", 1))), 1, dim(spark, A=1), table, kept, ["1h"])
    hours = table.read(spark).filter("interval_code = '1h'")
    assert values(hours, "symbol_id", "num_trades") == [(1, 6)]
    assert raw.waiting(spark, kept, rows.schema).isEmpty()


def test_waiting_folders_do_not_grow_with_symbols(spark, tmp_path):
    table, kept = tables.fact_klines(str(tmp_path / "fact")), tmp_path / "waiting"
    schema = raw.records(frame(spark)).schema

    def apply(n, known, *messages):
        raw.apply_raw(raw.records(frame(spark, *messages)), n, known, table, str(kept), ["1h"])

    apply(0, dim(spark), *[long_message(f"S{i}", 0) for i in range(40)])
    assert len([p for p in kept.rglob("*.parquet")]) <= 4
    apply(1, dim(spark, S0=1), long_message("S1", 1))
    for _ in range(2):      # delivered again after the release: what it was made from is still there
        assert raw.waiting(spark, str(kept), schema).count() == 40
        apply(1, dim(spark, S0=1), long_message("S1", 1))
    apply(2, dim(spark, S0=1, S1=2))
    assert raw.waiting(spark, str(kept), schema).count() == 38
    assert sorted(p.name for p in kept.iterdir() if p.name.startswith("batch")) == ["batch=1", "batch=2"]
    assert [r[:2] for r in minutes(table, spark)] == [
        (1, T("2024-01-01T00:00:00")), (2, T("2024-01-01T00:00:00")), (2, T("2024-01-01T00:01:00"))]


@pytest.mark.parametrize("bad", ["1h", "4h"])
def test_the_query_that_fails_stops_the_other(spark, tmp_path, bad):
    df = candles(spark, candle(1, "2024-01-01T00:00:00"), candle(1, "2024-01-01T03:00:00"))
    source = read_folder(spark, folder(spark, tmp_path, df), df.schema)
    table = tables.fact_klines(str(tmp_path / "fact"))
    write = SC.upsert_batches(table)

    def fail(batch, n):
        raise RuntimeError("sink is down")

    # the other one would run for ever
    queries = [
        SC.start_windows(source, code, fail if code == bad else write, str(tmp_path / "cp"), "1 second")
        for code in ("1h", "4h")]
    with pytest.raises(StreamingQueryException, match="sink is down"):
        SC.await_all(queries)
    assert not any(q.isActive for q in queries)
    SC.await_all([SC.start_windows(source, code, write, str(tmp_path / "cp"), None) for code in ("1h", "4h")])
    found = table.read(spark).groupBy("interval_code").agg(F.count(F.lit(1)), F.sum("num_trades"))
    assert values(found) == [("1h", 2, 2), ("4h", 1, 2)]
