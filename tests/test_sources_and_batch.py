from __future__ import annotations

import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import D, T, values
from tidelake import schemas, session
from tidelake.operators import candles
from tidelake.plans import io_queries
from tidelake.plans.batch import Inputs, Warehouse, csv_inputs, run_batch
from tidelake.sinks import jdbc as jdbc_sink
from tidelake.sources import files, jdbc, topics
from tidelake.streaming import recompute

KLINES = """open_time,open,high,low,close,volume,close_time,quote_asset_volume,num_trades,taker_buy_base_vol,taker_buy_quote_vol,ignore,symbol,open_time_dt
1704067200000,1,3,1,2,10,1704067259999,100,5,4,40,0,BTCUSDT,x
1704067260000,2,4,2,3,10,1704067319999,200,5,4,100,0,BTCUSDT,x
1704067200000,9,9,9,abc,1,1704067259999,50,1,1,20,0,ETHUSDT,x
,9,9,9,9,1,1704067259999,50,1,1,20,0,ETHUSDT,x
1704067200000,9,9,9,9,1,1704067259999,50,1,1,20,0,NOPEUSDT,x
"""
KLINES_2 = """open_time,open,high,low,close,volume,close_time,quote_asset_volume,num_trades,taker_buy_base_vol,taker_buy_quote_vol,ignore,symbol,open_time_dt
1704067200000,1,5,1,2,10,1704067259999,120,7,4,40,0,BTCUSDT,x
1704153600000,2,2,1,1,10,1704153659999,300,5,4,40,0,BTCUSDT,x
"""
TICKER = "symbol,priceChange,priceChangePercent,weightedAvgPrice,prevClosePrice,lastPrice,lastQty,bidPrice,bidQty,askPrice,askQty,openPrice,highPrice,lowPrice,volume,quoteVolume,openTime,closeTime,firstId,lastId,count\n" + "".join(
    f"{s},1,1.5,,,2,,,,,,,3,1,10,100,1704067200000,1704153600000,1,2,3\n" for s in ("BTCUSDT", "ETHUSDT")
)


def trade_file(symbol, *rows):
    head = "trade_id,price,qty,quote_qty,time,is_buyer_maker,is_best_match\n"
    return head + "".join(f"{i},1,1,{q},1704067200000000,{m},True\n" for i, (q, m) in enumerate(rows))


@pytest.fixture
def drop(tmp_path):
    (tmp_path / "klines_1m_a.csv").write_text(KLINES)
    (tmp_path / "klines_1m_b.csv").write_text(KLINES_2)
    (tmp_path / "ticker_24h_a.csv").write_text(TICKER)
    (tmp_path / "trades_BTCUSDT_7d.csv").write_text(trade_file("BTCUSDT", *[(1, "false")] * 20, (100, "false"), (90, "true")))
    (tmp_path / "trades_1INCHUSDT_7d.csv").write_text(trade_file("1INCHUSDT", (5, "true")))
    return tmp_path


def inputs(spark, drop):
    return csv_inputs(spark, f"{drop}/klines_1m_*.csv", f"{drop}/ticker_24h_*.csv", f"{drop}/trades_*USDT_*d.csv")


def test_csv_scan(spark, drop):
    df = files.load_csv(spark, f"{drop}/klines_1m_*.csv", schemas.CSV_KLINES)
    assert df.count() == 7 and df.schema.simpleString() == schemas.CSV_KLINES.simpleString()
    assert files.load_csv(spark, f"{drop}/nothing_*.csv", schemas.CSV_KLINES) is None


def test_symbol_from_file_name(spark, drop):
    df = files.load_trades_csv(spark, f"{drop}/trades_*USDT_*d.csv", schemas.CSV_TRADES)
    assert values(df.groupBy("symbol").count()) == [("1INCHUSDT", 1), ("BTCUSDT", 22)]
    assert values(df.filter("symbol = 'BTCUSDT' AND is_buyer_maker"), "quote_qty") == [("90",)]


def test_bad_csv_fields_become_null(spark, tmp_path):
    (tmp_path / "trades_AUSDT_1d.csv").write_text(
        "trade_id,price,qty,quote_qty,time,is_buyer_maker,is_best_match\nx,1,1,5,y,maybe,True\n2,1,1\n"
    )
    rows = files.load_csv(spark, str(tmp_path), schemas.CSV_TRADES).collect()
    assert [(r.trade_id, r.quote_qty, r.time, r.is_buyer_maker) for r in rows] == [(None, "5", None, None), (2, None, None, None)]


def test_audit(spark, drop):
    found = files.audit_inputs(spark, {"klines": f"{drop}/klines_1m_*.csv", "gone": f"{drop}/gone_*.csv"})
    assert values(found, "dataset", "files") == [("gone", 0), ("klines", 2)]
    with pytest.raises(FileNotFoundError):
        files.audit_inputs(spark, {"a": f"{drop}/gone_*.csv", "b": f"{drop}/lost_*.csv"})


def test_bronze_keeps_partition_columns(spark, tmp_path):
    for symbol, hour in (("A1", "03"), ("B", "14")):
        folder = tmp_path / "date=2024-01-05" / f"symbol={symbol}" / f"hour={hour}"
        folder.mkdir(parents=True)
        lines = [json.dumps({"price": "1.5", "trade_id": 7}), "{cut off"]
        (folder / "part-1.json").write_text("\n".join(lines))
    schema = files.with_layout(schemas._struct("price:string trade_id:long", schemas._T))
    df = files.load_json(spark, f"{tmp_path}/date=*/symbol=*", schema, str(tmp_path))
    good = df.filter("trade_id IS NOT NULL").select("*", files.layout_time().alias("at"))
    assert values(good, "symbol", "hour", "at") == [("A1", "03", T("2024-01-05T03:00:00")), ("B", "14", T("2024-01-05T14:00:00"))]
    assert df.count() == 4
    assert values(files.discover_symbols(spark, str(tmp_path))) == [("A1",), ("B",)]
    pruned = df.filter("symbol = 'B'")
    assert "PartitionFilters: []" not in pruned._jdf.queryExecution().executedPlan().toString()


def test_silver_accepts_both_names(spark, tmp_path):
    path = str(tmp_path / "silver")
    old = spark.createDataFrame([("A", "5")], "symbol string, quote_volume string")
    new = spark.createDataFrame([("B", "6")], "symbol string, quote_qty string")
    old.write.parquet(path)
    new.write.mode("append").parquet(path)
    assert values(files.load_silver(spark, path, "trades"), "symbol", "quote_qty") == [("A", "5"), ("B", "6")]
    both = schemas._struct("symbol:string quote_qty:string quote_volume:string", schemas._T)
    assert values(files.load_silver(spark, path, "trades", both)) == [("A", "5"), ("B", "6")]
    assert files.load_silver(spark, str(tmp_path / "gone"), "trades", both) is None


def now():
    return F.lit("2024-03-01").cast("timestamp")


def test_batch_stages(spark, drop, tmp_path):
    warehouse = Warehouse(str(tmp_path / "wh"))
    run = run_batch(spark, inputs(spark, drop), warehouse, now=now())
    assert list(run.timings) == [
        "dim_symbols", "fact_klines", "resample", "mart_trade_metrics", "fact_ticker_24h_snapshots", "mart_top_coins",
    ]
    assert values(warehouse.dim(spark), "symbol_id", "symbol_code") == [(1, "BTCUSDT"), (2, "ETHUSDT")]
    facts = warehouse.klines.read(spark)
    # of two versions of a candle the one with more trades stays; NOPEUSDT is unknown
    minutes = values(facts.filter("interval_code = '1m'"), "symbol_id", "open_time", "high_price", "close_price")
    assert minutes == [
        (1, T("2024-01-01"), D(5), D(2)), (1, T("2024-01-01T00:01:00"), D(4), D(3)),
        (1, T("2024-01-02"), D(2), D(1)), (2, T("2024-01-01"), D(9), None),
    ]
    daily = values(facts.filter("interval_code = '1d' AND symbol_id = 1"), "open_time", "open_price", "close_price", "volume_quote")
    assert daily == [(T("2024-01-01"), D(1), D(3), D(320)), (T("2024-01-02"), D(2), D(1), D(300))]
    assert facts.groupBy("interval_code").count().count() == 7
    metric = values(warehouse.metrics(spark), "symbol_id", "total_trades", "whale_buy_volume", "whale_sell_volume")
    assert metric == [(1, 22, D(100), D(90))]
    assert warehouse.tickers.read(spark).count() == 2
    assert [r.symbol_code for r in warehouse.top(spark).orderBy("rank").collect()] == ["BTCUSDT", "ETHUSDT"]


def test_second_batch_run_only_adds_a_ranking(spark, drop, tmp_path):
    warehouse = Warehouse(str(tmp_path / "wh"))

    def state():
        return [values(t) for t in (
            warehouse.dim(spark), warehouse.klines.read(spark), warehouse.metrics(spark), warehouse.tickers.read(spark),
        )]

    run_batch(spark, inputs(spark, drop), warehouse, now=now())
    before = state()
    run_batch(spark, inputs(spark, drop), warehouse, now=now())
    assert state() == before and warehouse.top(spark).count() == 4


def test_batch_without_trades_or_klines(spark, drop, tmp_path):
    given = inputs(spark, drop)
    run = run_batch(spark, Inputs(klines=given.klines, tickers=given.tickers), Warehouse(str(tmp_path / "a")), now=now())
    assert "mart_trade_metrics" not in run.timings
    warehouse = Warehouse(str(tmp_path / "b"))
    run_batch(spark, Inputs(tickers=given.tickers), warehouse, now=now())
    assert warehouse.top(spark).isEmpty() and warehouse.dim(spark).count() == 2
    with pytest.raises(FileNotFoundError):
        run_batch(spark, Inputs(klines=given.klines), warehouse, now=now())


def test_connector_options():
    assert jdbc.scan_options() == {"fetchsize": "10000"}
    options = jdbc.scan_options({"user": "u"}, "open_time", ("2024-01-01", "2024-02-01"), 8)
    assert options["numPartitions"] == "8" and options["user"] == "u" and options["lowerBound"] == "2024-01-01"
    with pytest.raises(ValueError):
        jdbc.scan_options(column="id")
    assert jdbc_sink.write_options(truncate=True)["truncate"] == "true"
    assert "truncate" not in jdbc_sink.write_options({"batchsize": "7"})
    assert "maxOffsetsPerTrigger" not in topics.topic_options("b:9092", "t")
    assert topics.topic_options("b:9092", "t")["startingOffsets"] == "earliest"
    candles = topics.candle_options("b:9092", "t")
    assert (candles["maxOffsetsPerTrigger"], candles["startingOffsets"]) == ("10000", "latest")


def session_like(named, current, master):
    conf = SimpleNamespace(get=lambda key, default: named)
    context = SimpleNamespace(getCheckpointDir=lambda: current, master=master)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(session_like("hdfs://n/named/", "hdfs://n/current", "yarn")) == "hdfs://n/named"
    assert session.shared_dir(session_like(None, "hdfs://n/current", "yarn")) == "hdfs://n/current"
    with pytest.raises(RuntimeError):
        session.shared_dir(session_like(None, None, "yarn"))
    assert session.shared_dir(spark) == session.shared_dir(spark)


def test_stored_copy_lasts_for_the_block(spark):
    with session.stored(spark.range(3), "block") as df:
        assert df.count() == 3 and "block-" in df.inputFiles()[0]
        folder = Path(df.inputFiles()[0].removeprefix("file://")).parent
        assert folder.exists()
    assert not folder.exists()


def test_longer_candles_of_a_batch_come_from_as_many_tasks_as_minutes_ask_for(spark, drop, tmp_path, monkeypatch):
    asked, whole = [], candles.resample_all
    monkeypatch.setattr(recompute, "resample_all", lambda df, targets, rows: asked.append(rows) or whole(df, targets, rows))
    warehouse = Warehouse(str(tmp_path / "warehouse"))
    run_batch(spark, inputs(spark, drop), warehouse)
    minutes = warehouse.klines.read(spark).filter("interval_code = '1m'").count()
    assert asked == [minutes] and minutes > 0


def test_files_of_several_values_are_written_without_a_sort(spark, tmp_path):
    spark.sql(f"CREATE TABLE by_flag (n long, flag string) USING parquet PARTITIONED BY (flag) LOCATION '{tmp_path}/f'")
    rows = "EXPLAIN INSERT INTO by_flag SELECT id, cast(id % 3 AS string) FROM range(90)"
    try:
        with io_queries._open_files(spark):
            assert "Sort" not in spark.sql(rows).first()[0]
            spark.sql(rows.removeprefix("EXPLAIN "))
        assert "Sort" in spark.sql(rows).first()[0]
        assert values(spark.table("by_flag").groupBy("flag").count()) == [("0", 30), ("1", 30), ("2", 30)]
    finally:
        spark.sql("DROP TABLE by_flag")
