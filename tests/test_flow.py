from __future__ import annotations

import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import D, plan_of
from tidelake import schemas
from tidelake.operators import flow, skew
from tidelake.session import materialize

TRADE = "symbol_id long, quote_qty decimal(30,12), is_buyer_maker boolean"


def trades(spark, *rows):
    return spark.createDataFrame([(s, D(q), m) for s, q, m in rows], TRADE)


def one(spark, *rows):
    return flow.trade_metrics(trades(spark, *rows)).first()


def test_single_trade_has_no_whale(spark):
    row = one(spark, (1, 100, False))
    assert row.whale_threshold == D(300) and row.whale_buy_ratio is None
    assert row.whale_buy_volume == 0 and row.total_trades == 1


def test_trade_at_the_threshold_is_no_whale(spark):
    totals = spark.createDataFrame([(1, 100.0, 2)], "symbol_id long, whale_threshold double, total_trades long")
    rows = trades(spark, (1, 100, False), (1, "100.000000000001", True))
    row = flow.whale_volumes(rows, totals).first()
    assert row.whale_buy_volume == 0 and row.whale_sell_volume > 100


def test_unknown_maker_flag_counts_on_neither_side(spark):
    row = one(spark, (1, 10, None), (1, 20, False), (1, 30, True))
    assert (row.total_trades, row.total_buy_volume, row.total_sell_volume, row.money_flow) == (3, D(20), D(30), D(-10))


def test_mart_types(spark):
    assert flow.trade_metrics(trades(spark, (1, 1, True))).schema.simpleString() == schemas.MART_TRADE_METRICS.simpleString()


def test_whale_ratio_is_rounded_once(spark):
    # 56992076.86 / 99658363.95 = 0.57187449..., which two roundings would make ...875
    base = [(1, 1, False)] * 900
    row = one(spark, *base, (1, "56992076.86", False), (1, "42666287.09", True))
    assert row.whale_buy_ratio == D("0.571874")


def brute_force(rows):
    groups = defaultdict(list)
    for symbol, quantity, maker in rows:
        groups[symbol].append((float(quantity), maker))
    out = {}
    for symbol, items in groups.items():
        sizes = [q for q, _ in items]
        mean = statistics.fmean(sizes)
        limit = max(mean + 2 * (statistics.stdev(sizes) if len(sizes) > 1 else 0), 3 * mean)
        buy = sum(q for q, m in items if q > limit and not m)
        sell = sum(q for q, m in items if q > limit and m)
        out[symbol] = (len(items), round(buy, 6), round(sell, 6))
    return out


@pytest.mark.parametrize("how", [{}, {"broadcast_rows": 0, "hot_rows": 50}, {"broadcast_rows": 0, "hot_rows": 10**9}])
def test_every_join_strategy_matches_brute_force(spark, how):
    rng = random.Random(3)
    # symbol 0 owns a third of all trades
    rows = [(0 if i % 3 == 0 else rng.randrange(1, 25), rng.choice([1, 2, 3, 4, 90]), rng.random() < 0.5) for i in range(900)]
    got = {
        r.symbol_id: (r.total_trades, float(r.whale_buy_volume), float(r.whale_sell_volume))
        for r in flow.trade_metrics(trades(spark, *rows), **how).collect()
    }
    assert got == brute_force(rows)
    assert any(buy + sell for _, buy, sell in got.values())


def test_small_lookup_never_shuffles_the_detail(spark):
    rows = trades(spark, (1, 1, True), (2, 2, False))
    totals = materialize(flow.trade_totals(rows))
    joined = skew.lookup_join(rows, totals.select("symbol_id", "whale_threshold", "total_trades"), ["symbol_id"], "total_trades")
    assert "BroadcastHashJoin" in plan_of(joined) and "Exchange hashpartitioning" not in plan_of(joined)


def test_hot_keys_stay_out_of_the_shuffle(spark):
    rows = trades(spark, *[(1, 1, True)] * 50, (2, 2, False), (3, 2, False)).select("symbol_id", "quote_qty")
    lookup = materialize(rows.groupBy("symbol_id").agg(F.count(F.lit(1)).alias("n"), F.max("quote_qty").alias("top")))
    joined = skew.lookup_join(rows, lookup, ["symbol_id"], "n", max_rows=0, hot_rows=10)
    assert joined.count() == 52 and joined.columns == ["symbol_id", "quote_qty", "top"]
    assert "LeftAnti" in plan_of(joined)


def test_broadcast_is_checked(spark):
    big = materialize(spark.range(100).withColumnRenamed("id", "k"))
    left = spark.range(10).withColumnRenamed("id", "k")
    assert "ResolvedHint" in left.join(skew.broadcast_checked(big, 100), "k")._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in left.join(skew.broadcast_checked(big, 99), "k")._jdf.queryExecution().analyzed().toString()
