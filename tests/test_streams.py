from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import D, T, candle, candles, values
from tests.test_candles import random_minutes
from tidelake import schemas
from tidelake.operators import candles as C
from tidelake.plans.stream_queries import stream_session
from tidelake.sinks import tables
from tidelake.sources.topics import read_folder
from tidelake.streaming import candles as SC
from tidelake.streaming import compaction, landing, late, recompute, ring

MESSAGE = "value string, timestamp timestamp"


def folder(spark, tmp_path, *batches):
    """One file per batch, dated so that a file source reads them in order."""
    import os
    import shutil

    path = tmp_path / "source"
    path.mkdir(exist_ok=True)
    for n, df in enumerate(batches):
        part = tmp_path / f"part-{n}"
        df.coalesce(1).write.parquet(str(part))
        file = next(p for p in part.iterdir() if p.suffix == ".parquet")
        target = path / f"{n}.parquet"
        shutil.copy(file, target)
        os.utime(target, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(path)


def run_resample(spark, tmp_path, code, *batches, **how):
    path = folder(spark, tmp_path, *batches)
    table = tables.fact_klines(str(tmp_path / "fact"))
    source = read_folder(spark, path, batches[0].schema, files_per_trigger=1)
    (query,) = SC.start_resample(source, table, str(tmp_path / "cp"), [code], trigger=None, **how)
    SC.await_all([query])
    return table, query


def test_one_batch_equals_batch_resample(spark, tmp_path):
    df = candles(spark, *random_minutes(7, 200))
    table, query = run_resample(spark, tmp_path, "1h", df)
    assert values(table.read(spark)) == values(C.resample(df, "1h"))
    assert SC.dropped_late_rows(query) == 0


def test_updates_of_an_open_window_arrive(spark, tmp_path):
    first = candles(spark, candle(1, "2024-01-01T00:00:00", o=5, c=6, vq=10))
    second = candles(spark, candle(1, "2024-01-01T00:01:00", o=6, c=9, vq=20))
    table, _ = run_resample(spark, tmp_path, "5m", first, second)
    row = table.read(spark).first()
    assert (row.open_price, row.close_price, row.volume_quote) == (D(5), D(9), D(30))


def test_late_row_is_dropped_and_counted(spark, tmp_path):
    early = candles(spark, candle(1, "2024-01-01T00:00:00", vq=10))
    later = [candles(spark, candle(1, f"2024-01-01T0{h}:00:00", vq=10)) for h in (2, 3)]
    late = candles(spark, candle(1, "2024-01-01T00:02:00", vq=99))
    # a trigger filters by the watermark its predecessor started with
    table, query = run_resample(spark, tmp_path, "5m", early, *later, late)
    assert SC.dropped_late_rows(query) == 1
    assert values(table.read(spark), "volume_quote") == [(D(10),)] * 3


def test_recompute_includes_the_late_row(spark, tmp_path):
    parts = [
        candles(spark, candle(1, "2024-01-01T00:01:00", o=5, vq=10)),
        candles(spark, candle(1, "2024-01-01T02:00:00", vq=10)),
        candles(spark, candle(1, "2024-01-01T00:00:00", o=4, vq=99), candle(1, "2024-01-01T00:01:00", o=6, vq=11)),
    ]
    table = tables.fact_klines(str(tmp_path / "fact"))
    source = read_folder(spark, folder(spark, tmp_path, *parts), parts[0].schema, files_per_trigger=1)
    recompute.start_recompute(source, table, str(tmp_path / "cp"), ["5m", "1d"], trigger=None).awaitTermination()
    got = values(table.read(spark), "interval_code", "open_time", "open_price", "volume_quote")
    assert got == [
        ("1d", T("2024-01-01"), D(4), D(120)),
        ("1m", T("2024-01-01T00:00:00"), D(4), D(99)), ("1m", T("2024-01-01T00:01:00"), D(6), D(11)),
        ("1m", T("2024-01-01T02:00:00"), D(10), D(10)),
        ("5m", T("2024-01-01T00:00:00"), D(4), D(110)), ("5m", T("2024-01-01T02:00:00"), D(10), D(10)),
    ]
    # the same batch again, as after a failed commit
    before = values(table.read(spark))
    recompute.apply_batch(parts[2], table, ["5m", "1d"])
    assert values(table.read(spark)) == before


def test_recompute_merges_one_interval_at_a_time(spark, tmp_path, monkeypatch):
    # what a merge shuffles, old rows and new ones, does not grow with the number of intervals
    merged, upsert = [], tables.KeyedTable.upsert

    def watched(self, source, *args, touched=None, **options):
        merged.append({t[0] for t in touched or []})
        upsert(self, source, *args, touched=touched, **options)

    monkeypatch.setattr(tables.KeyedTable, "upsert", watched)
    table = tables.fact_klines(str(tmp_path / "t"))
    recompute.apply_batch(candles(spark, candle(1, "2024-01-01T10:01:00")), table, ["5m", "1h", "1d"])
    assert merged == [set(), {"5m"}, {"1h"}, {"1d"}]
    assert values(table.read(spark), "interval_code") == [("1d",), ("1h",), ("1m",), ("5m",)]


def test_state_lies_on_disk(spark, tmp_path):
    _, query = run_resample(stream_session(spark), tmp_path, "1h", candles(spark, candle(1, "2024-01-01T10:00:00")))
    operators = query.recentProgress[0]["stateOperators"]
    assert len(operators) == 2 and all("rocksdbCommitFlushLatency" in o["customMetrics"] for o in operators)


def test_stream_sessions_keep_no_shuffle_files(spark, tmp_path):
    def shuffles():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = shuffles()
    stream_session(spark).range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(str(tmp_path / "o"))
    for _ in range(50):     # they are removed in the background
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before


def test_recompute_takes_the_closed_candle(spark, tmp_path):
    table = tables.fact_klines(str(tmp_path / "fact"))
    rows = candles(spark, *[candle(1, "2024-01-01T00:00:00", c=c) for c in (1, 2, 3)])
    closed = rows.withColumn("is_closed", F.col("close_price") == 2)
    recompute.apply_batch(closed, table, ["5m"])
    assert values(table.read(spark), "interval_code", "close_price") == [("1m", D(2)), ("5m", D(2))]


def test_recompute_leaves_other_buckets_alone(spark, tmp_path):
    plain, table = tables.fact_klines(str(tmp_path / "plain")), tables.fact_klines(str(tmp_path / "fact"), buckets=8)
    symbols, days = range(1, 30), ("2024-01-01", "2024-01-02")
    first = candles(spark, *[candle(s, f"{d}T00:0{m}:00", vq=s) for s in symbols for d in days for m in (0, 3)])
    late = candles(spark, candle(7, "2024-01-01T00:01:00", c=99, vq=5))
    place = tables.kline_places(table, late)
    assert [p[0] for p in place] == [dt.date(2024, 1, 1)] and place[0][1] in {str(b) for b in range(8)}

    def stored_files():
        return {p for p in (tmp_path / "fact").rglob("*.parquet")}

    for t in (plain, table):
        recompute.apply_batch(first, t, ["5m", "1d"])
    before = stored_files()
    for t in (plain, table):
        recompute.apply_batch(late, t, ["5m", "1d"])
    assert values(table.read(spark)) == values(plain.read(spark))
    touched = {f"interval_code={c}/open_date=2024-01-01/bucket={place[0][1]}" for c in ("1m", "5m", "1d")}
    changed = {str(p.parent.relative_to(tmp_path / "fact")) for p in before ^ stored_files()}
    assert changed == touched
    # the scan of a trigger lets no row through but those of one folder of the 16 of its interval
    scan = table.partitions_of(spark, tables.kline_partitions(["1m"], place))
    bucket = [r for r in table.read(spark, keep_partitions=True).collect()
              if (r.interval_code, r.open_date, r.bucket) == ("1m", *place[0])]
    assert 0 < len(bucket) < 20 and scanned(scan) == len(bucket)


def messages(spark, *values_):
    return spark.createDataFrame([(v, T("2024-01-05T07:00:00")) for v in values_], MESSAGE)


def land(spark, tmp_path, mode, *texts, **how):
    source = read_folder(spark, folder(spark, tmp_path, messages(spark, *texts)), MESSAGE)
    started = landing.start_landing(
        {"ticker": source}, str(tmp_path / "lake"), str(tmp_path / "cp"), mode, trigger=None, **how
    )
    SC.await_all(started)
    return tmp_path / "lake"


def test_landing_layout_names_and_types(spark, tmp_path):
    lake = land(
        spark, tmp_path, "DUAL",
        '{"symbol": "A", "event_time": 1704067200000, "last_price": 1.5, "num_trades": 3}',
        '{"event_time": null, "last_price": "2"}', "not json",
    )
    silver = spark.read.parquet(str(lake / "silver" / "ticker"))
    types = dict(silver.dtypes)
    assert types["lastPrice"] == "string" and types["count"] == "bigint" and "last_price" not in types
    got = values(silver.select("symbol", F.col("date").cast("string"), F.col("hour").cast("int"), "lastPrice"))
    assert got == [("A", "2024-01-01", 0, "1.5"), ("UNKNOWN", "2024-01-05", 7, "2")]
    bronze = sorted(p.relative_to(lake / "bronze").parts[1:-1] for p in (lake / "bronze").rglob("*.txt") if "_spark" not in str(p))
    assert bronze == [("date=2024-01-01", "symbol=A", "hour=00"), ("date=2024-01-05", "symbol=UNKNOWN", "hour=07")]


@pytest.mark.parametrize("mode,layers", [("BRONZE_ONLY", {"bronze"}), ("SILVER_ONLY", {"silver"})])
def test_landing_modes(spark, tmp_path, mode, layers):
    lake = land(spark, tmp_path, mode, '{"symbol": "A"}')
    assert {p.name for p in lake.iterdir()} == layers | {"reject"}


def test_bronze_keeps_messages_and_rejects_the_rest(spark, tmp_path):
    sent = ['{"s": "A", "E": 1704067200000, "c": "1.50", "extra": [1, {"k": null}]}', '{"symbol": "A", "count": "x"}']
    lake = land(spark, tmp_path, "DUAL", *sent, "[1, 2]", '"text"', '{"cut', None)
    lines = sorted(r.value for r in spark.read.text(str(lake / "bronze" / "ticker")).select("value").collect())
    assert lines == sorted(sent)
    silver = values(spark.read.parquet(str(lake / "silver" / "ticker")), "symbol", F.col("date").cast("string"), "lastPrice")
    assert silver == [("A", "2024-01-01", "1.50"), ("A", "2024-01-05", None)]
    rejects = values(spark.read.text(str(lake / "reject" / "ticker")), F.col("date").cast("string"), "value")
    assert rejects == [("2024-01-05", v) for v in sorted(["", "[1, 2]", '"text"', '{"cut'], key=repr)]


def test_files_roll_by_record_count(spark, tmp_path):
    texts = [f'{{"symbol": "A", "event_time": 1704067200000, "num_trades": {i}}}' for i in range(25)]
    lake = land(spark, tmp_path, "SILVER_ONLY", *texts, records_per_file=10)
    files = [p for p in (lake / "silver").rglob("*.parquet") if "_spark" not in str(p)]
    assert len(files) == 3 and all(".snappy." in p.name for p in files)


def test_gathered_files_are_as_few_as_their_limit_allows(spark, tmp_path):
    # the records of both keys come from several tasks
    texts = [f'{{"symbol": "{"AB"[i % 2]}", "event_time": 1704067200000, "num_trades": {i}}}' for i in range(50)]
    path = folder(spark, tmp_path, *[messages(spark, *texts[n::5]) for n in range(5)])
    SC.await_all(landing.start_landing(
        {"ticker": read_folder(spark, path, MESSAGE)}, str(tmp_path / "lake"), str(tmp_path / "cp"), "SILVER_ONLY",
        trigger=None, records_per_file=10, gather=True))
    silver = spark.read.parquet(str(tmp_path / "lake" / "silver" / "ticker"))
    assert len(silver.inputFiles()) == 6 and silver.count() == 50


def test_restarted_landing_adds_nothing(spark, tmp_path):
    lake = land(spark, tmp_path, "SILVER_ONLY", '{"symbol": "A"}')
    source = read_folder(spark, str(tmp_path / "source"), MESSAGE)
    SC.await_all(landing.start_landing({"ticker": source}, str(lake), str(tmp_path / "cp"), "SILVER_ONLY", trigger=None))
    assert spark.read.parquet(str(lake / "silver" / "ticker")).count() == 1


def trade(i, at, price=1, stamp="2024-02-01"):
    return (1, i, T(at), D(price), D(1), D(price), False, True, T(stamp))


def test_ring_keeps_the_first_version_and_the_period(spark, tmp_path):
    schema = schemas.FACT_RECENT_TRADES
    parts = [
        spark.createDataFrame([trade(1, "2024-01-09T10:00:00", 5), trade(2, "2024-01-01T10:00:00")], schema),
        spark.createDataFrame([trade(1, "2024-01-09T10:00:00", 7, "2024-02-02"), trade(3, "2024-01-02T23:00:00")], schema),
    ]
    table = tables.recent_trades(str(tmp_path / "ring"))
    source = read_folder(spark, folder(spark, tmp_path, *parts), schema, files_per_trigger=1)
    ring.start_ring(source, table, str(tmp_path / "cp"), trigger=None).awaitTermination()
    assert values(table.read(spark), "trade_id", "price") == [(1, D(5)), (2, D(1)), (3, D(1))]
    kept = ring.within_retention(table.read(spark, keep_partitions=True), dt.datetime(2024, 1, 9, 22), 7)
    assert values(kept, "trade_id") == [(1,), (3,)]
    old = ring.expired_partitions(table, spark, dt.date(2024, 1, 9), 7)
    assert values(old) == [(dt.date(2024, 1, 1),)]


def test_a_failing_query_ends_the_wait(spark, tmp_path):
    df = candles(spark, candle(1, "2024-01-01T00:00:00"))
    source = read_folder(spark, folder(spark, tmp_path, df), df.schema)

    def fail(batch, n):
        raise RuntimeError("sink is down")

    spark.streams.resetTerminated()
    query = source.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        with pytest.raises(Exception, match="sink is down"):
            SC.await_any(spark, timeout=60)
    finally:
        query.stop()
        spark.streams.resetTerminated()


# ----------------------------------------------------------------- key check of the ring

def scanned(df):
    """Rows that the file scan of ``df`` has let through."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0).metrics().get("numOutputRows").get().value()


def test_key_check_skips_row_groups(spark, tmp_path):
    """Of three files of a day only those whose statistics and Bloom filters admit a key are read."""
    table = tables.recent_trades(str(tmp_path / "ring"))
    schema = schemas.FACT_RECENT_TRADES
    for first in (0, 10_000, 20_000):       # even numbers, in three ranges
        rows = spark.range(first, first + 5_000, 2, 1).select(
            F.lit(1).cast("long").alias("symbol_id"), F.col("id").alias("trade_id"), F.lit("2024-01-09 10:00:00").cast("timestamp").alias("trade_time"),
            *[F.lit(1).cast(schema[c].dataType).alias(c) for c in ("price", "qty_base", "quote_qty")],
            F.lit(True).alias("is_buyer_maker"), F.lit(True).alias("is_best_match"), F.lit("2024-02-01").cast("timestamp").alias("ingested_at"))
        table.insert_new(rows)
    assert table.read(spark).count() == 7_500
    known = table.partitions_of(spark, [(dt.date(2024, 1, 9),)])

    def batch(*ids):
        return spark.createDataFrame([trade(i, "2024-01-09T10:00:00") for i in ids], schema)

    def let_through(*ids):
        with tables._wide_in_lists(spark):
            return scanned(table.possible(batch(*ids), known).select("trade_id"))

    assert scanned(known.select("trade_id")) == 7_500
    assert let_through(10_004, 10_010) == 2_500             # by the statistics: one file
    assert let_through(*range(2_001, 2_100, 2)) == 0        # by the Bloom filter: numbers between those stored
    # and the answer is right
    table.insert_new(batch(2_002, 2_003, 30_001))
    assert table.read(spark).count() == 7_502


def test_days_beyond_retention_are_removed(spark, tmp_path):
    table = tables.recent_trades(str(tmp_path / "ring"))
    assert ring.expire(table, spark, dt.date(2024, 1, 9)) == []
    rows = [trade(i, f"2024-01-0{i}T10:00:00") for i in range(1, 10)]
    table.insert_new(spark.createDataFrame(rows, schemas.FACT_RECENT_TRADES))
    assert ring.expire(table, spark, dt.date(2024, 1, 9), 3) == [f"2024-01-0{i}" for i in range(1, 6)]
    assert sorted(p.name for p in (tmp_path / "ring").glob("trade_date=*")) == [f"trade_date=2024-01-0{i}" for i in range(6, 10)]
    assert values(table.read(spark), "trade_id") == [(6,), (7,), (8,), (9,)]


# ------------------------------------------------------------------ all layers at once

def message_rows(spark, *bodies):
    return spark.createDataFrame([(b, T("2024-01-01T10:00:00")) for b in bodies], "value string, timestamp timestamp")


GOOD = '{"symbol":"BTCUSDT","event_time":1704103200000,"trade_id":%d,"price":"1","qty":"2"}'


def layers(spark, root):
    found = {name: landing.landed(spark, root, name, "trades") for name in ("bronze", "silver", "reject")}
    return {name: 0 if df is None else df.count() for name, df in found.items()}


def test_a_landed_folder_has_one_file_however_many_tasks_read(spark, tmp_path):
    batch = message_rows(spark, *[GOOD % n for n in range(40)], "no json").repartition(8)
    landing.land_batch(batch, 0, "trades", str(tmp_path), records_per_file=100)
    assert layers(spark, str(tmp_path)) == {"bronze": 40, "silver": 40, "reject": 1}
    for layer in ("bronze", "silver"):
        assert len(list(tmp_path.glob(f"{layer}/trades/batch=0/**/part-*"))) == 1


@pytest.mark.parametrize("dies_in", ["silver", "reject", "mark"])
def test_no_half_batch_is_seen(spark, tmp_path, monkeypatch, dies_in):
    root = str(tmp_path / "lake")
    assert layers(spark, root) == {"bronze": 0, "silver": 0, "reject": 0}
    landing.land_batch(message_rows(spark, GOOD % 1, "no json"), 0, "trades", root)
    second = message_rows(spark, GOOD % 2, GOOD % 3, "{", "[]")

    def dies(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        if dies_in == "mark":
            m.setattr(landing, "_set_mark", dies)
        else:
            real = landing._landed_folder
            m.setattr(landing, "_landed_folder", lambda r, layer, d, n: dies() if layer == dies_in else real(r, layer, d, n))
        with pytest.raises(OSError):
            landing.land_batch(second, 1, "trades", root)
    assert layers(spark, root) == {"bronze": 1, "silver": 1, "reject": 1}
    assert landing.land_batch(second, 1, "trades", root)
    assert layers(spark, root) == {"bronze": 3, "silver": 3, "reject": 3}
    assert not landing.land_batch(second, 1, "trades", root)
    assert layers(spark, root) == {"bronze": 3, "silver": 3, "reject": 3}
    assert values(landing.landed(spark, root, "silver", "trades"), "trade_id", "batch", "date", "hour") == [
        (1, 0, "2024-01-01", "10"), (2, 1, "2024-01-01", "10"), (3, 1, "2024-01-01", "10")]


def test_the_topic_is_read_once(spark, tmp_path):
    path = folder(spark, tmp_path, message_rows(spark, GOOD % 1, "no json"), message_rows(spark, GOOD % 2))
    source = read_folder(spark, path, "value string, timestamp timestamp", files_per_trigger=1)
    for _ in range(2):      # a restart adds nothing
        queries = landing.start_landing_once({"trades": source}, str(tmp_path / "lake"), str(tmp_path / "cp"), trigger=None)
        for q in queries:
            q.awaitTermination()
        assert len(queries) == 1
        assert layers(spark, str(tmp_path / "lake")) == {"bronze": 2, "silver": 2, "reject": 1}
    read = [p["sources"][0]["numInputRows"] for p in queries[0].recentProgress]
    assert sum(read) == 0


# ------------------------------------------------------------------------------ late rows

def test_late_rows_and_windows_make_the_batch_answer(spark, tmp_path):
    root, schema = str(tmp_path / "split"), schemas.FACT_KLINES
    batches = [
        candles(spark, candle(1, "2024-01-01T10:00:00", 1), candle(1, "2024-01-01T10:30:00", 2)),
        # two minutes before the newest time is late, one minute is not; a copy of a late row
        candles(spark, candle(1, "2024-01-01T10:28:00", 7), candle(1, "2024-01-01T10:29:00", 3), candle(1, "2024-01-01T10:28:00", 7)),
        candles(spark, candle(2, "2024-01-02T09:00:00", 5)),
        candles(spark, candle(1, "2024-01-01T10:45:00", 9), candle(2, "2024-01-02T09:10:00", 6)),
    ]
    for n, batch in enumerate(batches):
        late.split_batch(batch, n, root)
        late.split_batch(batch, n, root)        # delivered again
    lost = [(T("2024-01-01T10:28"), D(7)), (T("2024-01-01T10:28"), D(7)), (T("2024-01-01T10:45"), D(9))]
    assert values(late.side(spark, root, "late", schema), "open_time", "open_price") == lost
    assert late.side(spark, root, "on_time", schema).count() == 5
    table = tables.fact_klines(str(tmp_path / "windows"))
    queries = SC.start_resample(late.on_time_stream(spark, root, schema), table, str(tmp_path / "cp"), ["1h"], trigger=None)
    SC.await_all(queries)
    assert SC.dropped_late_rows(queries[0]) == 0
    for _ in range(2):
        assert late.apply_late(spark, root, table, schema, ["1h"]) == 3
        got = values(table.read(spark), "symbol_id", "open_time", "close_price", "num_trades")
        assert got == [(1, T("2024-01-01T10:00"), D(9), 5), (2, T("2024-01-02T09:00"), D(6), 2)]


def test_a_split_that_dies_is_repeated_alike(spark, tmp_path, monkeypatch):
    root, schema = str(tmp_path / "split"), schemas.FACT_KLINES
    late.split_batch(candles(spark, candle(1, "2024-01-01T10:00:00")), 0, root)
    second = candles(spark, candle(1, "2024-01-01T09:00:00"), candle(1, "2024-01-01T11:00:00"))

    def dies():
        yield "late"
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(late, "SIDES", dies())      # after one side, before the other and the mark
        with pytest.raises(OSError):
            late.split_batch(second, 1, root)
    assert late.side(spark, root, "late", schema).count() == 0 and late.side(spark, root, "on_time", schema).count() == 1
    late.split_batch(second, 1, root)
    assert values(late.side(spark, root, "late", schema), "open_time") == [(T("2024-01-01T09:00"),)]
    assert late.side(spark, root, "on_time", schema).count() == 2
    assert late.apply_late(spark, str(tmp_path / "none"), tables.fact_klines(str(tmp_path / "t")), schema) == 0


# ----------------------------------------------------------------------------- compaction

AT = '{"symbol":"%s","event_time":%d,"trade_id":%d,"price":"1","qty":"2"}'


def hourly(spark, n, *hours):
    start = int(T("2024-01-01").timestamp() * 1000)
    return message_rows(spark, *[AT % (s, start + h * 3_600_000, n * 100 + h) for h in hours for s in ("A", "B")], "no json")


def data_files(path):
    return [p for p in path.rglob("part-*") if not p.name.startswith(".")]


def test_packing_keeps_rows_and_leaves_few_files(spark, tmp_path, monkeypatch):
    root, now = str(tmp_path / "lake"), dt.datetime(2024, 1, 2, 3, 30)
    assert compaction.read(spark, root, "silver", "trades") is None
    assert compaction.pack(spark, root, "silver", "trades", now) == 0
    for n, hours in enumerate([(0, 1), (1, 2, 25), (2, 27), (26,)]):       # the third has an hour that is not over
        landing.land_batch(hourly(spark, n, *hours), n, "trades", root)
    want = {layer: values(landing.landed(spark, root, layer, "trades")) for layer in ("bronze", "silver", "reject")}
    assert len(want["silver"]) == 16 and len(want["reject"]) == 4

    def found(layer):
        df = compaction.read(spark, root, layer, "trades")
        return values(df.select(landing.landed(spark, root, layer, "trades").columns))

    with monkeypatch.context() as m:        # dies before it is published
        m.setattr("tidelake.sinks.versions.replace_snapshot", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            compaction.pack(spark, root, "silver", "trades", now)
    assert found("silver") == want["silver"]
    assert compaction.pack(spark, root, "silver", "trades", now) == 3
    assert compaction.pack(spark, root, "bronze", "trades", now) == 3
    # rejects are kept by the day on which they came: all on the first, which is over
    assert compaction.pack(spark, root, "reject", "trades", now) == 4
    assert {layer: found(layer) for layer in want} == want
    live = [p for p, _, s in compaction.packed_table(spark, root, "silver", "trades").listed(spark) if s == "live"]
    assert sorted(live) == ["date=2024-01-01", "date=2024-01-02"]
    packed = spark.read.parquet(*[str(tmp_path / "lake" / "silver_packed" / "trades" / f"version={v}" / p) for p, v, s in
                                  compaction.packed_table(spark, root, "silver", "trades").listed(spark) if s == "live"])
    assert len(packed.inputFiles()) == 2        # of 12: one a day
    # a late row for a packed day; the next run also removes the files that the first one left
    landing.land_batch(hourly(spark, 4, 1), 4, "trades", root)
    assert compaction.pack(spark, root, "silver", "trades", now) == 1
    assert not (tmp_path / "lake" / "silver" / "trades" / "batch=0").exists()
    assert len(data_files(tmp_path / "lake" / "silver" / "trades" / "batch=2")) == 4
    ids = sorted(v[0] for v in values(compaction.read(spark, root, "silver", "trades"), "trade_id"))
    assert ids == sorted(i for n, hours in enumerate([(0, 1), (1, 2, 25), (2, 27), (26,), (1,)]) for h in hours for i in 2 * [n * 100 + h])
    # once its hours are over, the third batch follows, and nothing is left to do
    assert compaction.pack(spark, root, "silver", "trades", dt.datetime(2024, 1, 2, 5)) == 1
    assert compaction.pack(spark, root, "silver", "trades", dt.datetime(2024, 1, 2, 5)) == 0
    assert sorted(v[0] for v in values(compaction.read(spark, root, "silver", "trades"), "trade_id")) == ids
    notes = [(p, s) for p, _, s in compaction.packed_table(spark, root, "silver", "trades").listed(spark) if s in ("packed", "leaving")]
    assert notes == [("0-4", "packed"), ("2-2", "leaving")]
    assert not landing.land_batch(hourly(spark, 0, 0), 0, "trades", root)      # delivered again


def test_message_files_grow_in_number_not_in_size(spark, monkeypatch):
    from tidelake.plans import inputs

    monkeypatch.setattr(inputs, "ROWS_PER_FILE", 300)
    path, each = inputs.versioned_messages(spark, "/root/testdata/sf0.001")
    assert each > 1 and len(spark.read.parquet(path).inputFiles()) == 3 * each
