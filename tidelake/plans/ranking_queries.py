"""Candle statistics, windows, scoring and the top-N mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators import candles as C
from tidelake.operators import filters, flow, ranking, ranks
from tidelake.plans import inputs as I
from tidelake.plans.batch_queries import (
    STAMP, WHALE_SQL, _FLOW, _TICKER_SQL, _stamp, _tickers,
)
from tidelake.plans.catalog import CODES, TICKS, candles_sql, half_up, query
from tidelake.session import materialize

_DAILY = f"{TICKS}, {candles_sql('1d', 'daily')}"

# Decimal division and mean round half up at fixed places: 8 and 12 for the taker ratio,
# 6 (then 4) for the volume trend. The same is done here in integers, volumes as cents.
_TAKER = half_up("taker_buy_quote_volume * 100", "CAST(volume_quote * 100 AS HUGEINT)", 8)
_MEAN = half_up("sum(taker8) * 10000", "count(taker8)", 0)

_TOTALS = f"""shares AS (
  SELECT *, CASE WHEN volume_quote > 0 THEN {_TAKER} END AS taker8 FROM daily),
totals AS (
  SELECT symbol_id, sum(volume_quote) AS total_volume_quote, sum(num_trades) AS total_num_trades,
    CASE WHEN count(taker8) > 0 THEN CAST({_MEAN} AS DOUBLE) / 1e12 END AS avg_taker_buy_ratio,
    count(*) AS candle_count,
    sum(CASE WHEN close_price > open_price THEN 1 ELSE 0 END) AS bullish_candles,
    CAST(sum(CASE WHEN close_price > open_price THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS bullish_ratio
  FROM shares GROUP BY 1)"""

_NUMBERED = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol_id ORDER BY open_time) AS row_num,
    count(*) OVER (PARTITION BY symbol_id) AS total_rows FROM daily),
halved AS (SELECT *, CASE WHEN row_num * 2 <= total_rows THEN 'first' ELSE 'second' END AS half FROM numbered)"""

_RATIO6 = half_up("sv * fn", "CAST(fv * sn AS HUGEINT)", 6)

_TREND = f"""{_NUMBERED}, cents AS (
  SELECT symbol_id, count(*) FILTER (half = 'first') AS fn, count(*) FILTER (half = 'second') AS sn,
    CAST(sum(CASE WHEN half = 'first' THEN volume_quote * 100 END) AS HUGEINT) AS fv,
    CAST(sum(CASE WHEN half = 'second' THEN volume_quote * 100 END) AS HUGEINT) AS sv
  FROM halved GROUP BY 1),
halves AS (SELECT symbol_id, CAST(fv AS DOUBLE) / 100 / nullif(fn, 0) AS f, CAST(sv AS DOUBLE) / 100 / nullif(sn, 0) AS s FROM cents),
trend AS (SELECT symbol_id, CASE WHEN fv > 0 THEN CAST(({_RATIO6} + 50) // 100 AS DOUBLE) / 1e4 ELSE 1.0 END AS volume_trend FROM cents)"""

_COMBINED = f"""{_DAILY}, {_TOTALS}, {_TREND}, {_FLOW}, {CODES},
metrics AS (SELECT symbol_id, bought - sold AS money_flow,
  {WHALE_SQL} AS whale FROM flows),
combined AS (
  SELECT t.symbol_id, c.symbol_code, total_volume_quote, total_num_trades, volume_trend, money_flow,
    whale AS whale_ratio_raw, coalesce(whale, 0.5) AS whale_buy_ratio,
    coalesce(avg_taker_buy_ratio, 0.5) AS avg_taker_buy_ratio,
    coalesce(bullish_ratio, 0.5) AS bullish_ratio,
    CAST(coalesce(money_flow, 0) AS DECIMAL(38,2)) AS money_flow_filled
  FROM totals t LEFT JOIN trend USING (symbol_id) LEFT JOIN metrics USING (symbol_id)
  JOIN codes c ON c.symbol_id = t.symbol_id)"""

_RANKED = f"""{_COMBINED}, ranked AS (
  SELECT *, percent_rank() OVER (ORDER BY total_volume_quote) AS pr_volume,
    percent_rank() OVER (ORDER BY avg_taker_buy_ratio) AS pr_taker,
    percent_rank() OVER (ORDER BY money_flow_filled) AS pr_flow,
    percent_rank() OVER (ORDER BY whale_buy_ratio) AS pr_whale,
    percent_rank() OVER (ORDER BY bullish_ratio) AS pr_bullish FROM combined)"""

_BASE = ("CAST(0.2 AS DOUBLE) * pr_volume + CAST(0.2 AS DOUBLE) * pr_taker + CAST(0.2 AS DOUBLE) * pr_flow"
         " + CAST(0.2 AS DOUBLE) * pr_whale + CAST(0.2 AS DOUBLE) * pr_bullish")
_SCORED = f"{_RANKED}, scored AS (SELECT *, {_BASE} AS long_term_score FROM ranked)"
_ADJUSTED = f"""{_RANKED}, scored AS (SELECT * EXCLUDE (raw), greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), raw
  + CASE WHEN volume_trend > 1.2 THEN CAST(0.05 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
  - CASE WHEN whale_ratio_raw < 0.4 THEN CAST(0.1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)) AS long_term_score
  FROM (SELECT *, {_BASE} AS raw FROM ranked))"""

_SIGNAL = """CASE WHEN whale_buy_ratio > 0.6 AND bullish_ratio > 0.6 THEN 'ACCUMULATING'
  WHEN whale_buy_ratio < 0.4 OR bullish_ratio < 0.35 THEN 'DISTRIBUTING' ELSE 'NEUTRAL' END"""


def mart_sql(scored: str, n: int = 10, stamp: str = STAMP) -> str:
    return f"""WITH {scored}, best AS (
  SELECT *, row_number() OVER (ORDER BY long_term_score DESC, symbol_id) AS rank FROM scored)
SELECT '1d' AS timeframe, CAST(rank AS INTEGER) AS rank, symbol_id, symbol_code,
  CAST(total_volume_quote AS DOUBLE) AS total_volume_quote, CAST(total_num_trades AS BIGINT) AS total_num_trades,
  round(avg_taker_buy_ratio, 6) AS avg_taker_buy_ratio, round(bullish_ratio, 6) AS bullish_ratio,
  CAST(volume_trend AS DOUBLE) AS volume_trend, CAST(money_flow AS DOUBLE) AS money_flow,
  CAST(whale_buy_ratio AS DOUBLE) AS whale_buy_ratio, round(long_term_score, 4) AS long_term_score,
  {_SIGNAL} AS signal, TIMESTAMP '{stamp}' AS computed_at
FROM best WHERE rank <= {n}"""


MART_DIGITS = {
    "avg_taker_buy_ratio": 6, "bullish_ratio": 6, "volume_trend": 4,
    "whale_buy_ratio": 6, "long_term_score": 4,
}


def daily(spark: SparkSession, d: str) -> DataFrame:
    return C.resample(I.candles_1m(spark, d), "1d")


def combined(spark: SparkSession, d: str) -> DataFrame:
    metrics = flow.trade_metrics(I.trades(spark, d), _stamp())
    return ranking.combine(daily(spark, d), metrics, I.dim(spark, d))


def mart(spark: SparkSession, d: str, stamp: str = STAMP, **how) -> DataFrame:
    metrics = flow.trade_metrics(I.trades(spark, d), _stamp())
    at = F.lit(stamp).cast("timestamp")
    return ranking.top_coins(daily(spark, d), metrics, I.dim(spark, d), computed_at=at, **how)


# ------------------------------------------------------------------------- A6 - A10

@query(
    "a6_candle_totals",
    f"""WITH {_DAILY}, {_TOTALS} SELECT symbol_id, CAST(total_volume_quote AS DOUBLE) AS total_volume_quote,
CAST(total_num_trades AS BIGINT) AS total_num_trades, candle_count FROM totals""",
)
def a6(spark, d):
    return ranking.candle_totals(daily(spark, d)).select(
        "symbol_id", "total_volume_quote", "total_num_trades", "candle_count"
    )


@query(
    "a7_taker_ratio",
    f"WITH {_DAILY}, {_TOTALS} SELECT symbol_id, avg_taker_buy_ratio FROM totals",
    avg_taker_buy_ratio=12,
)
def a7(spark, d):
    return ranking.candle_totals(daily(spark, d)).select("symbol_id", "avg_taker_buy_ratio")


@query(
    "a8_bullish_ratio",
    f"WITH {_DAILY}, {_TOTALS} SELECT symbol_id, CAST(bullish_candles AS BIGINT) AS bullish_candles, bullish_ratio FROM totals",
)
def a8(spark, d):
    return ranking.candle_totals(daily(spark, d)).select("symbol_id", "bullish_candles", "bullish_ratio")


@query(
    "a9_half_volumes",
    f'WITH {_DAILY}, {_TREND} SELECT symbol_id, round(f, 8) AS "first", round(s, 8) AS "second" FROM halves',
    first=8, second=8,
)
def a9(spark, d):
    halves = ranking.with_half(ranking.number_candles(daily(spark, d)))
    return halves.groupBy("symbol_id").pivot("half", ["first", "second"]).agg(F.avg("volume_quote"))


@query(
    "a10_volume_trend",
    f"WITH {_DAILY}, {_TREND} SELECT symbol_id, CAST(volume_trend AS DOUBLE) AS volume_trend FROM trend",
    volume_trend=4,
)
def a10(spark, d):
    return ranking.volume_trend(daily(spark, d))


# -------------------------------------------------------------------------- W2 - W6

@query(
    "w2_row_number",
    f"WITH {_DAILY}, {_NUMBERED} SELECT symbol_id, open_time, row_num FROM numbered",
)
def w2(spark, d):
    return ranking.number_candles(daily(spark, d)).select("symbol_id", "open_time", "row_num")


@query(
    "w2_row_number_ranged",
    """SELECT user_id AS symbol_id, ts AS open_time, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS row_num,
count(*) OVER (PARTITION BY user_id) AS total_rows FROM events""",
)
def w2_ranged(spark, d):
    # raw ticks: a symbol may own most of them, so they are numbered by range
    rows = I.ticks(spark, d).select("symbol_id", F.col("ts").alias("open_time"))
    return ranks.row_numbers(rows, [F.col("open_time")], ["symbol_id"], group_total="total_rows")


@query(
    "w3_partition_count",
    f"WITH {_DAILY}, {_NUMBERED} SELECT symbol_id, open_time, total_rows FROM numbered",
)
def w3(spark, d):
    return ranking.number_candles(daily(spark, d)).select("symbol_id", "open_time", "total_rows")


@query(
    "w4_half_split",
    f"WITH {_DAILY}, {_NUMBERED} SELECT symbol_id, open_time, half FROM halved",
)
def w4(spark, d):
    halves = ranking.with_half(ranking.number_candles(daily(spark, d)))
    return halves.select("symbol_id", "open_time", "half")


_W5 = f"""WITH {TICKS} SELECT symbol_id, percent_rank() OVER (ORDER BY n) AS pr_count,
  percent_rank() OVER (ORDER BY top NULLS FIRST) AS pr_top
FROM (SELECT symbol_id, count(*) AS n, max(CASE WHEN taker THEN price END) AS top FROM ticks GROUP BY 1)"""


def _rank_input(spark, d):
    return I.ticks(spark, d).groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("is_taker_buy"), F.col("price"))).alias("top")
    )


@query("w5_percent_rank", _W5)
def w5(spark, d):
    ranked = ranks.percent_ranks(_rank_input(spark, d), "symbol_id", {"n": "pr_count", "top": "pr_top"})
    return ranked.select("symbol_id", "pr_count", "pr_top")


@query("w5_percent_rank_two_phase", _W5)
def w5_ranged(spark, d):
    ranked = ranks.percent_ranks(
        _rank_input(spark, d), "symbol_id", {"n": "pr_count", "top": "pr_top"}, single_task_rows=0
    )
    return ranked.select("symbol_id", "pr_count", "pr_top")


@query(
    "w5_percent_rank_many_ties",
    """SELECT o_orderkey, percent_rank() OVER (ORDER BY band) AS pr_band, percent_rank() OVER (ORDER BY cents) AS pr_price
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 5 ELSE o_custkey END AS band,
  CAST(o_totalprice AS DECIMAL(18,2)) AS cents FROM orders)""",
)
def w5_ties(spark, d):
    # a large part of all orders shares one value; neither it nor anything else gathers in a task
    rows = I.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", 5).otherwise(F.col("o_custkey")).alias("band"),
        F.col("o_totalprice").cast(I.MONEY).alias("cents"),
    )
    ranked = ranks.percent_ranks(
        rows, "o_orderkey", {"band": "pr_band", "cents": "pr_price"},
        single_task_rows=0, broadcast_rows=0, hot_rows=1_000,
    )
    return ranked.select("o_orderkey", "pr_band", "pr_price")


@query(
    "w6_global_rank",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders",
)
def w6(spark, d):
    rows = I.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return ranks.row_numbers(rows, order, name="rank").select("o_orderkey", "rank")


# --------------------------------------------------------------------- joins J3, J4

_COMBINED_COLUMNS = """symbol_id, symbol_code, CAST(total_volume_quote AS DOUBLE) AS total_volume_quote,
  CAST(total_num_trades AS BIGINT) AS total_num_trades, CAST(volume_trend AS DOUBLE) AS volume_trend,
  CAST(money_flow AS DOUBLE) AS money_flow, whale_ratio_raw"""


@query(
    "j3_left_joins",
    f"WITH {_COMBINED} SELECT {_COMBINED_COLUMNS} FROM combined",
    volume_trend=4, whale_ratio_raw=6,
)
def j3(spark, d):
    return combined(spark, d).select(
        "symbol_id", "symbol_code", "total_volume_quote", "total_num_trades", "volume_trend",
        "money_flow", "whale_ratio_raw",
    )


@query(
    "j4_join_code",
    f"""WITH {_DAILY}, {CODES} SELECT c.symbol_code, count(*) AS candles FROM daily JOIN codes c
ON c.symbol_id = daily.symbol_id WHERE c.symbol_code NOT LIKE '%XYZ' GROUP BY 1""",
)
def j4(spark, d):
    known = I.dim(spark, d).filter("symbol_code NOT LIKE '%XYZ'")
    counts = daily(spark, d).groupBy("symbol_id").agg(F.count(F.lit(1)).alias("candles"))
    return counts.join(known, "symbol_id").select("symbol_code", "candles")


# --------------------------------------------------------------------------- R1 - R10

@query(
    "r1_top_by_volume",
    f"""WITH {_TICKER_SQL} SELECT symbol, CAST(qv AS DOUBLE) AS "quoteVolume" FROM tick24
WHERE symbol LIKE '%USDT' ORDER BY qv DESC, symbol LIMIT 10""",
)
def r1(spark, d):
    return ranking.top_symbols(filters.universe(_tickers(spark, d)), 10)


@query(
    "r2_top_n_rank",
    """SELECT o_orderkey, CAST(rank AS INTEGER) AS rank FROM (SELECT o_orderkey,
  row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 25""",
)
def r2(spark, d):
    rows = I.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    best = ranks.top_n(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 25)
    return best.select("o_orderkey", "rank")


@query(
    "r3_emptiness",
    """SELECT 'future' AS probe, (SELECT count(*) FROM events WHERE ts > TIMESTAMP '2100-01-01') = 0 AS empty, 1 AS n
UNION ALL SELECT 'all', (SELECT count(*) FROM events) = 0, 1""",
)
def r3(spark, d):
    events = I.table(spark, d, "events")
    probes = {"future": events.filter("ts > timestamp_ntz'2100-01-01'"), "all": events}
    # as frames: a probe reads no further than its first row
    found = [df.limit(1).agg((F.count(F.lit(1)) == 0).alias("empty")).select(F.lit(name).alias("probe"), "empty")
             for name, df in probes.items()]
    return found[0].unionByName(found[1]).withColumn("n", F.lit(1))


@query(
    "r5_neutral_fill",
    f"""WITH {_COMBINED} SELECT symbol_id, whale_buy_ratio, avg_taker_buy_ratio AS avg_taker_buy_ratio,
bullish_ratio, CAST(money_flow_filled AS DOUBLE) AS money_flow_filled FROM combined""",
    whale_buy_ratio=6, avg_taker_buy_ratio=12,
)
def r5(spark, d):
    return combined(spark, d).select(
        "symbol_id", "whale_buy_ratio", "avg_taker_buy_ratio", "bullish_ratio", "money_flow_filled"
    )


_SCORE_COLUMNS = """SELECT symbol_id, pr_volume, pr_taker, pr_flow, pr_whale, pr_bullish,
round(long_term_score, 12) AS long_term_score FROM scored"""
_SCORE_NAMES = ["symbol_id", *ranking.RANK_NAMES.values(), "long_term_score"]


@query("r6_composite_score", f"WITH {_SCORED} {_SCORE_COLUMNS}", long_term_score=12)
def r6(spark, d):
    return ranking.score(combined(spark, d)).select(*_SCORE_NAMES)


@query("r6_composite_score_two_phase", f"WITH {_SCORED} {_SCORE_COLUMNS}", long_term_score=12)
def r6_ranged(spark, d):
    return ranking.score(combined(spark, d), single_task_rows=0).select(*_SCORE_NAMES)


@query("r7_signal", f"WITH {_COMBINED} SELECT symbol_id, {_SIGNAL} AS signal FROM combined")
def r7(spark, d):
    return combined(spark, d).select("symbol_id", ranking.signal().alias("signal"))


@query("r8_top_coins", mart_sql(_SCORED), **MART_DIGITS)
def r8(spark, d):
    return mart(spark, d)


@query("r9_adjusted_score", mart_sql(_ADJUSTED, 25), **MART_DIGITS)
def r9(spark, d):
    return mart(spark, d, adjust=True, n=25)


@query("r10_latest_snapshot", mart_sql(_SCORED, 5, "2024-02-03 00:00:00"), **MART_DIGITS)
def r10(spark, d):
    stamps = ("2024-02-01 00:00:00", "2024-02-03 00:00:00", "2024-02-02 00:00:00")
    run = materialize(mart(spark, d, n=5), "run")
    parts = [run.withColumn("computed_at", F.lit(s).cast("timestamp")) for s in stamps]
    history = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return ranking.latest_snapshot(history)
