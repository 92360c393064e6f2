from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import D, T, candle, candles, plan_of, values
from tidelake.operators import candles as C
from tidelake.operators.filters import of_interval
from tidelake.sinks import tables

TICK = "symbol_id long, ts timestamp, price decimal(18,2), qty decimal(18,2), is_taker_buy boolean, id long"


def random_minutes(seed=1, n=400):
    rng = random.Random(seed)
    at = T("2024-01-01T00:00:00")
    seen = set()
    while len(seen) < n:
        seen.add((rng.randrange(3), rng.randrange(3 * 1440)))
    return [
        candle(s, at + dt.timedelta(minutes=m), o=rng.randrange(1, 99), c=rng.randrange(1, 99),
               vq=rng.randrange(1, 500), n=rng.randrange(9))
        for s, m in sorted(seen)
    ]


def test_midnight_splits_days(spark):
    df = candles(spark, candle(1, "2024-01-01T23:59:00", o=1), candle(1, "2024-01-02T00:00:00", o=2))
    days = C.resample(df, "1d")
    assert values(days, "open_time", "open_price") == [(T("2024-01-01"), D(1)), (T("2024-01-02"), D(2))]


def test_gaps_are_not_filled_and_first_and_last_count(spark):
    df = candles(
        spark,
        candle(1, "2024-01-01T00:04:00", o=5, c=6, vq=10),
        candle(1, "2024-01-01T00:01:00", o=3, h=30, c=4, vq=20),
        candle(1, "2024-01-01T00:17:00", o=7, low=1, c=8, vq=40),
    )
    rows = C.resample(df, "15m").orderBy("open_time").collect()
    assert len(rows) == 2
    first = rows[0]
    assert (first.open_price, first.close_price, first.high_price, first.volume_quote) == (D(3), D(6), D(30), D(30))
    assert first.close_time == T("2024-01-01T00:04:59.999") and first.num_trades == 2


@pytest.mark.parametrize("code", C.TARGETS)
def test_one_pass_equals_direct_and_chained(spark, code):
    df = candles(spark, *random_minutes()).cache()
    direct = values(C.resample(df, code))
    assert values(C.resample_all(df).filter(F.col("interval_code") == code)) == direct
    assert values(C.resample(C.resample(df, "5m"), code)) == direct


def test_resample_is_idempotent_and_keeps_totals(spark):
    df = candles(spark, *random_minutes(2)).cache()
    hours = C.resample(df, "1h")
    assert values(C.resample(hours, "1h")) == values(hours)
    total = df.agg(F.sum("volume_quote"), F.sum("num_trades")).first()
    for code in C.TARGETS:
        part = C.resample(df, code).agg(F.sum("volume_quote"), F.sum("num_trades")).first()
        assert tuple(part) == tuple(total)
    wrong = "low_price > least(open_price, close_price) OR high_price < greatest(open_price, close_price)"
    assert C.resample_all(df).filter(wrong).isEmpty()


def test_ticks_with_tie_break(spark):
    at = T("2024-01-01T00:00:01")
    big = 2**62
    rows = [(1, at, D(5), D(1), True, big + 2), (1, at, D(4), D(1), False, big + 1), (1, at, D(6), D(2), True, big + 3)]
    df = spark.createDataFrame(rows, TICK)
    row = C.from_ticks(df, tie_break="id").first()
    assert (row.open_price, row.close_price, row.low_price) == (D(4), D(6), D(4))
    assert (row.volume_base, row.volume_quote, row.taker_buy_quote_volume) == (D(4), D(21), D(17))
    assert row.open_time == T("2024-01-01") and row.close_time == T("2024-01-01T00:00:59.999")


def test_plans_keep_hash_aggregates_and_two_exchanges(spark, tmp_path):
    candles(spark, *random_minutes()).write.parquet(str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    plan = plan_of(C.resample_all(df))
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 2
    ticks = spark.createDataFrame([], TICK)
    assert "SortAggregate" not in plan_of(C.from_ticks(ticks, tie_break="id"))


def test_candles_of_a_task_do_not_grow_with_their_number(spark, monkeypatch):
    monkeypatch.setattr(C, "ROWS_PER_TASK", 50)
    df = candles(spark, *random_minutes()).cache()
    sized = C.resample_all(df, rows=df.count())
    plan = plan_of(sized)
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert sized.rdd.getNumPartitions() == 8
    assert values(sized) == values(C.resample_all(df))


def test_one_interval_of_a_stored_table_reads_its_folders_only(spark, tmp_path):
    table = tables.fact_klines(str(tmp_path / "fact"))
    minute = candles(spark, *[candle(s, f"2024-01-{day:02d}T00:00:00") for s in (1, 2) for day in (1, 2, 3)])
    table.upsert(minute.unionByName(C.resample_all(minute, ["1h", "1d"])))
    daily = of_interval(table.read(spark), "1d")
    assert len(daily.collect()) == 6
    scan = daily._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    folders = spark.read.parquet(table.path).select("interval_code", "open_date").distinct()
    assert folders.count() > 1
    assert scan.metrics().get("numPartitions").get().value() == folders.filter("interval_code = '1d'").count()
