from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import CANDLE, D, T, candle, candles, values
from tidelake.operators.merge import STREAM_RULES
from tidelake.sinks import upserts, versions
from tidelake.sinks.upserts import kline_log, log_batches
from tidelake.sinks.versions import VersionedTable, missing, repeated_keys

DAY1, DAY2 = "2024-01-01T10:00:00", "2024-01-02T10:00:00"


def size(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))


def versioned(spark, *rows):
    """Candle rows with their marks: (candle, is_closed, event_time)."""
    return spark.createDataFrame([(*c, closed, at) for c, closed, at in rows], f"{CANDLE}, is_closed boolean, event_time long")


# ------------------------------------------------------------------------ versioned table

@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v long, day string").schema
    return VersionedTable(str(tmp_path / "t"), schema, {"day": F.col("day")})


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v long, day string")


def test_partitions_are_replaced_together(spark, table):
    assert table.read(spark).collect() == []
    table.write(frame(spark, (1, 1, "a"), (2, 2, "b"), (3, 3, "c")))
    old = table.read(spark)
    table.write(frame(spark, (1, 10, "a"), (4, 4, "d")), drop=["day=c"])
    assert values(table.read(spark), "k", "v", "day") == [(1, 10, "a"), (2, 2, "b"), (4, 4, "d")]
    assert values(table.read(spark, ["day=b", "day=none"]), "k") == [(2,)]
    # who began before sees what was there
    assert values(old, "k", "v") == [(1, 1), (2, 2), (3, 3)]
    table.write(frame(spark, (5, 5, "e")))
    folders = {p.parent.name for p in Path(table.path).rglob("day=*/*.parquet")}
    assert folders == {"day=a", "day=b", "day=d", "day=e"}     # what the second write replaced is gone
    assert len(list(Path(table.path).rglob("day=a/*.parquet"))) == 1


def test_a_write_that_dies_changes_nothing(spark, table, monkeypatch):
    table.write(frame(spark, (1, 1, "a"), (2, 2, "b")))

    def dies(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(versions, "replace_snapshot", dies)
        with pytest.raises(OSError):
            table.write(frame(spark, (1, 9, "a"), (2, 9, "b")))
    assert values(table.read(spark), "k", "v") == [(1, 1), (2, 2)]
    table.write(frame(spark, (1, 9, "a")))
    assert values(table.read(spark), "k", "v") == [(1, 9), (2, 2)]


def test_violations_keep_the_old_rows(spark, table):
    gate = {"checks": {"no value": missing("v"), "negative": F.count_if(F.col("v") < 0)}, "audits": {"repeated": repeated_keys("k", "day")}}
    assert table.write(frame(spark, (1, 1, "a")), **gate).published
    report = table.write(frame(spark, (1, None, "a"), (2, -1, "a"), (2, -2, "a")), **gate)
    assert report.found == {"no value": 1, "negative": 2, "repeated": 1} and not report.published
    assert values(table.read(spark), "k", "v") == [(1, 1)]
    assert len(list(Path(table.path).glob("version=*"))) == 1
    assert table.write(frame(spark, (2, 5, "a")), **gate).published
    assert values(table.read(spark), "k", "v") == [(2, 5)]


# ---------------------------------------------------------------------------- upsert log

def test_an_older_version_never_wins(spark, tmp_path):
    log = kline_log(str(tmp_path / "log"))
    best = candle(1, DAY1, 10, n=5)
    log.append(versioned(spark, (best, True, 100), (candle(1, DAY2, 7), False, 5)), "q", 0)
    log.append(versioned(spark, (candle(1, DAY1, 99, n=9), False, 200), (candle(1, DAY2, 8), False, 6), (candle(1, DAY2, 6), False, 4)), "q", 1)
    want = [(T(DAY1), D(10)), (T(DAY2), D(8))]
    assert values(log.read(spark), "open_time", "open_price") == want
    assert log.compact(spark) == 2
    assert values(log.read(spark), "open_time", "open_price") == want
    # after compaction too
    log.append(versioned(spark, (candle(1, DAY1, 50, n=4), True, 90), (candle(1, DAY2, 5), False, 5)), "q", 2)
    assert values(log.read(spark), "open_time", "open_price") == want
    log.append(versioned(spark, (candle(1, DAY1, 11, n=5), True, 101)), "q", 3)
    assert values(log.read(spark), "open_time", "open_price") == [(T(DAY1), D(11)), (T(DAY2), D(8))]


def test_a_trigger_writes_its_own_rows_and_a_replay_nothing(spark, tmp_path):
    log = kline_log(str(tmp_path / "log"))
    many = candles(spark, *[candle(s, DAY1, s) for s in range(2000)])
    log.append(many, "q", 0)
    log.compact(spark)
    large = size(tmp_path / "log")
    one = candles(spark, candle(7, DAY1, 1000, n=2))
    assert log.append(one, "q", 1)
    assert 0 < size(tmp_path / "log") - large < large / 10
    before = size(tmp_path / "log")
    assert not log.append(one, "q", 1) and not log.append(many, "q", 0)
    assert size(tmp_path / "log") == before
    assert values(log.read(spark).filter("symbol_id = 7"), "open_price") == [(D(1000),)] and log.read(spark).count() == 2000


def test_compaction_touches_what_batches_touch_and_hides_nothing(spark, tmp_path):
    log = kline_log(str(tmp_path / "log"))
    write = log_batches(log, "q", compact_every=2)
    rows = [[candle(1, DAY1, 1)], [candle(1, DAY2, 2)], [candle(2, DAY2, 3)], [candle(1, DAY2, 4, n=2)], [candle(3, DAY1, 5)]]
    for n, batch in enumerate(rows):
        write(candles(spark, *batch), n)
        assert log.read(spark).count() == len({(c[0], c[2]) for b in rows[:n + 1] for c in b})
    assert values(log.read(spark), "symbol_id", "open_price") == [(1, D(1)), (1, D(4)), (2, D(3)), (3, D(5))]
    live = {r[0]: r[1] for r in log.base.listed(spark) if r[2] == "live"}
    assert len(live) == 2 and len(set(live.values())) == 2          # the second compaction left the first day alone
    assert {p.name for p in (tmp_path / "log/deltas/query=q").glob("batch=*")} == {"batch=2", "batch=3", "batch=4"}


def test_a_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    log = kline_log(str(tmp_path / "log"))
    for n in range(3):
        log.append(candles(spark, candle(n, DAY1, n + 1)), "q", n)

    def dies(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(versions, "replace_snapshot", dies)
        with pytest.raises(OSError):
            log.compact(spark)
    assert log.read(spark).count() == 3
    # a draft that was left behind is no batch
    (tmp_path / "log/_drafts/q-3").mkdir(parents=True)
    log.append(candles(spark, candle(9, DAY1, 9)), "q", 3)
    log.compact(spark)
    assert values(log.read(spark), "symbol_id") == [(0,), (1,), (2,), (9,)]


def test_stream_rules_and_queries_numbered_apart(spark, tmp_path):
    log = kline_log(str(tmp_path / "log"), STREAM_RULES)
    states = [candle(1, DAY1, 10, h=12, low=9, c=11, n=1), candle(1, DAY1, 99, h=11, low=9, c=10, n=2), candle(1, DAY1, 98, h=15, low=10, c=13, n=3)]
    for n, state in enumerate(states):
        log.append(candles(spark, state), "a", n)
        log.append(candles(spark, candle(2, DAY1, n + 1, n=n + 1, interval="1h")), "b", n)
        if n == 1:
            log.compact(spark)
    got = values(log.read(spark), "symbol_id", "open_price", "high_price", "low_price", "close_price", "num_trades")
    assert got == [(1, D(10), D(15), D(9), D(13), 3), (2, D(1), D(3), D(1), D(3), 3)]


def test_log_equals_a_dictionary(spark, tmp_path):
    rng = random.Random(4)
    log, best = kline_log(str(tmp_path / "log")), {}
    for n in range(4):
        rows = []
        for _ in range(30):
            key, version = rng.randrange(12), (rng.random() < 0.5, rng.randrange(50), rng.randrange(1, 4))
            rows.append((candle(key, DAY1, rng.randrange(1, 500), n=version[2]), version[0], version[1]))
            best[key] = max(best.get(key, ()), (*version, n))
        log.append(versioned(spark, *rows), "q", n)
        if n == 2:
            log.compact(spark)
    assert {r.symbol_id: r.num_trades for r in log.read(spark).collect()} == {k: v[2] for k, v in best.items()}


def test_version_is_one_number(spark):
    df = versioned(spark, (candle(1, DAY1), True, 5), (candle(2, DAY1), False, 10**14), (candle(3, DAY1), None, None))
    got = [r[0] for r in df.orderBy("symbol_id").select(upserts.candle_version(df, 7)).collect()]
    assert got[2] < got[0] and got[1] < got[0] and str(got[0])[-10:] == "0000000007"
