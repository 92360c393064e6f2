from __future__ import annotations

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import D, T, candle, candles, plan_of, values
from tidelake import schemas
from tidelake.operators import merge
from tidelake.sinks import tables
from tidelake.streaming.candles import upsert_batches

ROW = "k int, open_price int, high_price int, low_price int, close_price int"


def test_rules(spark):
    old = spark.createDataFrame([(1, 10, 20, 5, 11), (2, 1, None, None, 1), (3, 7, 7, 7, 7)], ROW)
    new = spark.createDataFrame([(1, 99, 15, 8, 12), (2, 2, 3, 4, None), (4, 8, 8, 8, 8)], ROW)
    got = merge.merge_frames(old, new, ["k"], merge.STREAM_RULES)
    assert values(got) == [(1, 10, 20, 5, 12), (2, 1, 3, 4, None), (3, 7, 7, 7, 7), (4, 8, 8, 8, 8)]
    assert values(merge.merge_frames(old, new, ["k"]))[0] == (1, 99, 15, 8, 12)
    with pytest.raises(ValueError):
        merge.merge_frames(old, new, ["k"], {"open_price": "first"})


@pytest.mark.parametrize("rules", [{}, merge.STREAM_RULES])
def test_merging_twice_changes_nothing(spark, rules):
    rng = random.Random(4)

    def frame():
        return spark.createDataFrame(
            [(k, *[rng.randrange(50) for _ in range(4)]) for k in rng.sample(range(40), 25)], ROW
        )

    old, new = frame(), frame()
    once = merge.merge_frames(old, new, ["k"], rules)
    assert values(merge.merge_frames(once, new, ["k"], rules)) == values(once)


def test_closed_candle_wins(spark):
    rows = [(1, "a", False, 10), (1, "b", False, 30), (1, "c", True, 20), (2, "d", None, None)]
    df = spark.createDataFrame(rows, "k int, v string, is_closed boolean, event_time long")
    assert values(merge.latest_wins(df, ["k"]), "k", "v") == [(1, "c"), (2, "d")]


def test_dedup_prunes_copies_before_the_shuffle(spark, tmp_path):
    spark.range(1000).select(F.lit(1).alias("k"), "id").write.parquet(str(tmp_path / "t"))
    df = merge.latest_wins(spark.read.parquet(str(tmp_path / "t")), ["k"], [F.col("id").desc()])
    assert values(df) == [(1, 999)]
    assert "WindowGroupLimit" in plan_of(df).split("Exchange")[-1]


def stored(spark, table):
    return values(table.read(spark), "symbol_id", "open_time", "open_price", "high_price", "close_price")


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    table = tables.fact_klines(str(tmp_path / "fact"))
    table.upsert(candles(spark, candle(1, "2024-01-01T00:00:00", o=1), candle(1, "2024-01-02T00:00:00", o=2)))
    untouched = tmp_path / "fact" / "interval_code=1m" / "open_date=2024-01-01"
    before = sorted(os.listdir(untouched))
    batch = candles(spark, candle(1, "2024-01-02T00:00:00", o=5), candle(2, "2024-01-03T00:00:00", o=3))
    table.upsert(batch)
    expected = stored(spark, table)
    assert [r[2] for r in expected] == [D(1), D(5), D(3)]
    assert sorted(os.listdir(untouched)) == before
    table.upsert(batch)
    assert stored(spark, table) == expected
    assert table.read(spark).schema.simpleString() == schemas.FACT_KLINES.simpleString()


def test_long_intervals_share_a_folder_per_month(spark, tmp_path):
    table = tables.fact_klines(str(tmp_path / "fact"))
    days = ("2024-01-05", "2024-01-31", "2024-02-01")
    table.upsert(candles(spark, *[candle(1, f"{d}T00:00:00", interval="1d") for d in days]))
    assert sorted(p.name for p in (tmp_path / "fact" / "interval_code=1d").iterdir()) == [
        "open_date=2024-01-01", "open_date=2024-02-01",
    ]
    table.upsert(candles(spark, candle(1, "2024-01-31T00:00:00", o=7, interval="1d")))
    assert {r[1].day: r[2] for r in stored(spark, table)} == {5: D(10), 31: D(7), 1: D(10)}
    wanted = tables.kline_partitions(["1m", "1d"], [T("2024-01-05").date(), T("2024-01-06").date()])
    assert [(c, str(d)) for c, d in wanted] == [("1d", "2024-01-01"), ("1m", "2024-01-05"), ("1m", "2024-01-06")]


def test_insert_new_appends_only_unknown_keys(spark, tmp_path):
    table = tables.fact_klines(str(tmp_path / "fact"))
    table.insert_new(candles(spark, candle(1, "2024-01-01T00:00:00", o=1)))
    batch = candles(spark, candle(1, "2024-01-01T00:00:00", o=9), candle(1, "2024-01-01T00:01:00", o=2))
    for _ in range(2):
        table.insert_new(batch)
    assert [r[2] for r in stored(spark, table)] == [D(1), D(2)]


def test_upsert_survives_a_static_overwrite_default(spark, tmp_path):
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "static")
    try:
        table = tables.fact_klines(str(tmp_path / "fact"))
        table.upsert(candles(spark, candle(1, "2024-01-01T00:00:00")))
        table.upsert(candles(spark, candle(1, "2024-01-02T00:00:00")))
        assert table.read(spark).count() == 2
    finally:
        spark.conf.set(key, "dynamic")


def test_stream_rules_on_a_table(spark, tmp_path):
    table = tables.fact_klines(str(tmp_path / "fact"))
    write = upsert_batches(table)
    write(candles(spark, candle(1, "2024-01-01T00:00:00", o=10, h=20, low=5, c=11)), 0)
    for batch in (1, 1):
        write(candles(spark, candle(1, "2024-01-01T00:00:00", o=99, h=15, low=8, c=12)), batch)
    assert stored(spark, table) == [(1, T("2024-01-01"), D(10), D(20), D(12))]
    write(candles(spark), 2)
    assert table.read(spark).count() == 1


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    table = tables.fact_klines(str(tmp_path / "fact"))
    table.upsert(candles(spark, *[candle(1, f"2024-01-{d:02d}T00:00:00") for d in range(1, 6)]))
    plan = plan_of(table.partitions_of(spark, [("1m", "2024-01-02")]))
    assert "PartitionFilters: []" not in plan
    plan = plan_of(table.read(spark).filter("interval_code = '1d' AND close_price > 1").select("symbol_id"))
    assert "PushedFilters: [IsNotNull(close_price), GreaterThan(close_price" in plan
    assert "ReadSchema: struct<symbol_id:bigint,close_price:decimal(30,12)>" in plan


def test_snapshot_and_history(spark, tmp_path):
    path = str(tmp_path / "snap")
    tables.replace_snapshot(spark.range(5), path)
    tables.replace_snapshot(spark.range(2), path)
    assert values(tables.read_snapshot(spark, path, spark.range(1).schema)) == [(0,), (1,)]
    tables.replace_snapshot(spark.range(3), path)
    assert len([p for p in Path(path).iterdir() if p.name.startswith("version-")]) == 2


def test_a_write_that_dies_before_the_switch_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    tables.replace_snapshot(spark.range(2), path)

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_switch", die)
        with pytest.raises(RuntimeError):
            tables.replace_snapshot(spark.range(9), path)
    assert values(tables.read_snapshot(spark, path, spark.range(1).schema)) == [(0,), (1,)]
    tables.replace_snapshot(spark.range(3), path)
    assert tables.read_snapshot(spark, path, spark.range(1).schema).count() == 3
    history = str(tmp_path / "hist")
    assert tables.append_history(spark.range(2), history) and tables.append_history(spark.range(3), history)
    assert not tables.append_history(spark.range(0), history)
    assert spark.read.parquet(history).count() == 5


def test_snapshot_may_be_built_from_itself(spark, tmp_path):
    path = str(tmp_path / "snap")
    tables.replace_snapshot(spark.range(5), path)
    old = tables.read_snapshot(spark, path, spark.range(1).schema)
    tables.replace_snapshot(old.select((F.col("id") + 10).alias("id")), path)
    assert values(tables.read_snapshot(spark, path, old.schema))[0] == (10,)


def test_universe_is_reused(spark, tmp_path):
    path = str(tmp_path / "universe")
    codes = spark.createDataFrame([("A",), ("B",)], "symbol string")
    assert tables.load_universe(spark, path) is None
    assert values(tables.active_universe(spark, path, lambda: codes), "symbol") == [("A",), ("B",)]
    assert tables.active_universe(spark, path, lambda: codes.limit(0)).count() == 2
    with pytest.raises(RuntimeError):
        tables.active_universe(spark, str(tmp_path / "none"), lambda: codes.limit(0))
