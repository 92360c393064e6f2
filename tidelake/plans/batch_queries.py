"""Candles, money flow, dimension, joins, filters, scalar functions and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.functions import (
    bucket_start, from_micros, from_millis, utc_date, utc_hour,
)
from tidelake.operators import candles as C
from tidelake.operators import contract, dims, filters, flow, merge, quality
from tidelake.plans import inputs as I
from tidelake.plans.catalog import (
    CODES, TICKS, TRADES, all_candles_sql, candle_columns, candles_sql, half_up, query,
)
from tidelake.session import materialize, new_path, partitions_for
from tidelake.sinks import tables

STAMP = "2024-02-01 00:00:00"


def _stamp():
    return F.lit(STAMP).cast("timestamp")


# ---------------------------------------------------------------------- A1, W1, U2

@query("a1_ohlcv_from_ticks", f"WITH {TICKS}, {candles_sql('1m')} {candle_columns('1m')}")
def a1(spark, d):
    return I.candles_1m(spark, d)


def _register_resample(code: str) -> None:
    @query(f"w1_resample_{code}", f"WITH {TICKS}, {candles_sql(code)} {candle_columns(code)}")
    def resample(spark, d):
        return C.resample(I.candles_1m(spark, d), code)


for _code in C.TARGETS:
    _register_resample(_code)


@query("u2_all_intervals", all_candles_sql(C.TARGETS))
def u2(spark, d):
    with partitions_for(spark, I.table(spark, d, "events").count()):
        minutes = materialize(I.candles_1m(spark, d), "minutes")
    return C.resample_all(minutes, rows=minutes.count())


@query(
    "w1_window_counts",
    f"""WITH {TICKS}
SELECT symbol_id, time_bucket(INTERVAL '4 hours', ts) AS window_start, count(*) AS n
FROM ticks GROUP BY 1, 2""",
)
def w1(spark, d):
    rows = I.ticks(spark, d)
    return rows.groupBy("symbol_id", bucket_start("ts", 14_400).alias("window_start")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --------------------------------------------------------------------------- A2 - A5

_STATS = f"""{TRADES}, stats AS (
  SELECT symbol_id, greatest(
    CAST(avg(q) AS DOUBLE) + 2.0 * coalesce(stddev_samp(CAST(q AS DOUBLE)), 0.0),
    3.0 * CAST(avg(q) AS DOUBLE)) AS thr
  FROM trades GROUP BY 1)"""

_FLOW = f"""{_STATS}, flows AS (
  SELECT t.symbol_id, any_value(thr) AS thr, count(*) AS total_trades,
    CAST(sum(CASE WHEN NOT maker THEN q ELSE 0 END) AS DECIMAL(38,2)) AS bought,
    CAST(sum(CASE WHEN maker THEN q ELSE 0 END) AS DECIMAL(38,2)) AS sold,
    CAST(sum(CASE WHEN CAST(q AS DOUBLE) > thr AND NOT maker THEN q ELSE 0 END) AS DECIMAL(38,2)) AS wb,
    CAST(sum(CASE WHEN CAST(q AS DOUBLE) > thr AND maker THEN q ELSE 0 END) AS DECIMAL(38,2)) AS ws
  FROM trades t JOIN stats s ON t.symbol_id = s.symbol_id GROUP BY 1)"""

WHALE_SQL = f"CASE WHEN wb + ws > 0 THEN CAST({half_up('wb * 100', '(CAST((wb + ws) * 100 AS HUGEINT))', 6)} AS DOUBLE) / 1e6 END"

_METRICS_COLUMNS = f"""symbol_id, CAST(bought AS DOUBLE) AS total_buy_volume,
  CAST(sold AS DOUBLE) AS total_sell_volume, CAST(bought - sold AS DOUBLE) AS money_flow,
  total_trades, round(thr, 2) AS whale_threshold, CAST(wb AS DOUBLE) AS whale_buy_volume,
  CAST(ws AS DOUBLE) AS whale_sell_volume,
  {WHALE_SQL} AS whale_buy_ratio"""


@query(
    "a2_whale_threshold",
    f"WITH {_STATS} SELECT symbol_id, round(thr, 2) AS whale_threshold FROM stats",
    whale_threshold=2,
)
def a2(spark, d):
    return flow.trade_totals(I.trades(spark, d)).select("symbol_id", "whale_threshold")


@query(
    "a3_money_flow",
    f"""WITH {_FLOW} SELECT symbol_id, CAST(bought AS DOUBLE) AS total_buy_volume,
CAST(sold AS DOUBLE) AS total_sell_volume, CAST(bought - sold AS DOUBLE) AS money_flow,
total_trades FROM flows""",
)
def a3(spark, d):
    totals = flow.trade_totals(I.trades(spark, d))
    bought, sold = F.col("total_buy_volume"), F.col("total_sell_volume")
    return totals.select(
        "symbol_id", bought, sold, (bought - sold).alias("money_flow"), "total_trades"
    )


@query(
    "a4_whale_volumes",
    f"""WITH {_FLOW} SELECT symbol_id, CAST(wb AS DOUBLE) AS whale_buy_volume,
CAST(ws AS DOUBLE) AS whale_sell_volume FROM flows WHERE wb + ws > 0""",
)
def a4(spark, d):
    rows = I.trades(spark, d)
    return flow.whale_volumes(rows, materialize(flow.trade_totals(rows), "totals"))


@query(
    "a4_whale_volumes_split_keys",
    f"""WITH {_FLOW} SELECT symbol_id, CAST(wb AS DOUBLE) AS whale_buy_volume,
CAST(ws AS DOUBLE) AS whale_sell_volume FROM flows WHERE wb + ws > 0""",
)
def a4_split(spark, d):
    # The way taken when the lookup is too large to broadcast: hot keys apart.
    rows = I.trades(spark, d)
    totals = materialize(flow.trade_totals(rows), "totals")
    return flow.whale_volumes(rows, totals, broadcast_rows=0, hot_rows=600)


@query(
    "a5_whale_ratio",
    f"WITH {_FLOW} SELECT {_METRICS_COLUMNS} FROM flows",
    whale_buy_ratio=6,
)
def a5(spark, d):
    return flow.trade_metrics(I.trades(spark, d), _stamp()).drop("computed_at")


# ---------------------------------------------------------------------- A11, R4, S11

@query("a11_distinct_symbols", f"WITH {CODES} SELECT symbol_code FROM codes")
def a11(spark, d):
    return dims.distinct_codes(I.ticker_records(spark, d))


@query("r4_sorted_codes", f"WITH {CODES} SELECT symbol_code FROM codes ORDER BY symbol_code")
def r4(spark, d):
    return dims.distinct_codes(I.ticker_records(spark, d)).orderBy("symbol_code")


# ------------------------------------------------------------------------------- A12

@query(
    "a12_latest_wins",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
  CAST(l_extendedprice AS DOUBLE) AS l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
)
def a12(spark, d):
    rows = I.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    return merge.latest_wins(rows, ["l_orderkey", "l_linenumber"], order)


# ---------------------------------------------------------------------- A13, D4 - D6

@query(
    "a13_reconcile",
    """WITH e AS (
  SELECT 'lineitem' AS table_name, 4 * (SELECT count(*) FROM orders) AS expected, (SELECT count(*) FROM lineitem) AS actual
  UNION ALL SELECT 'orders', 10 * (SELECT count(*) FROM customer) + 2, (SELECT count(*) FROM orders)
  UNION ALL SELECT 'customer', 0, (SELECT count(*) FROM customer)
  UNION ALL SELECT 'absent', (SELECT count(*) FROM supplier), 0)
SELECT table_name, expected, actual,
  CASE WHEN expected <> 0 THEN abs(actual - expected) / CAST(expected AS DOUBLE) END AS drift,
  CASE WHEN expected = 0 THEN actual = 0 ELSE abs(actual - expected) / CAST(expected AS DOUBLE) <= 0.0001 END AS ok
FROM e""",
)
def a13(spark, d):
    def counted(name, column):
        return I.table(spark, d, name).agg(column.alias("expected"))

    n = F.count(F.lit(1))
    baseline = reduce(DataFrame.unionByName, [
        counted("orders", n * 4).withColumn("table_name", F.lit("lineitem")),
        counted("customer", n * 10 + 2).withColumn("table_name", F.lit("orders")),
        counted("supplier", n * 0).withColumn("table_name", F.lit("customer")),
        counted("supplier", n).withColumn("table_name", F.lit("absent")),
    ])
    names = ("lineitem", "orders", "customer")
    actual = quality.row_counts({name: I.table(spark, d, name) for name in names})
    return quality.reconcile(actual, baseline)


@query(
    "d4_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def d4(spark, d):
    return quality.duplicate_keys(I.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "d5_orphans",
    """SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)""",
)
def d5(spark, d):
    known = I.table(spark, d, "customer").filter("c_acctbal > 0")
    facts = I.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return quality.orphans(facts, known, "o_custkey", "c_custkey")


@query(
    "d6_null_counts",
    """WITH m AS (SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE ts END AS open_time,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS open_price, user_id AS symbol_id FROM events)
SELECT 'symbol_id' AS column_name, count(*) FILTER (symbol_id IS NULL) AS nulls FROM m
UNION ALL SELECT 'open_time', count(*) FILTER (open_time IS NULL) FROM m
UNION ALL SELECT 'open_price', count(*) FILTER (open_price IS NULL) FROM m""",
)
def d6(spark, d):
    rows = I.table(spark, d, "events").select(
        F.col("user_id").alias("symbol_id"),
        F.when(F.col("event_type") != "signup", F.col("ts")).alias("open_time"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("open_price"),
    )
    return quality.null_counts(rows, ["symbol_id", "open_time", "open_price"])


# --------------------------------------------------------------------------- K4, K5

_MERGE_SIDES = """old AS (SELECT o_orderkey AS k, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
    o_orderdate AS at FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
  new AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'N' END AS status,
    CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) + 1
         ELSE CAST(o_totalprice AS DECIMAL(18,2)) - 1 END AS price,
    o_orderdate AS at FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""


def _merge_sides(spark, d):
    orders = I.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast(I.MONEY).alias("price"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderpriority").alias("priority"),
    )
    price, status = F.col("price"), F.col("status")
    changed = F.when(status == "O", price + 1).when(status != "F", price - 1)
    new = orders.filter("at >= timestamp_ntz'1998-01-01'").select(
        "k",
        F.when(F.col("priority") != "1-URGENT", F.lit("N")).alias("status"),
        changed.cast(I.MONEY).alias("price"),
        "at",
    )
    return orders.filter("at < timestamp_ntz'1999-01-01'").drop("priority"), new


@query(
    "k4_merge_replace",
    f"""WITH {_MERGE_SIDES}
SELECT coalesce(new.k, old.k) AS k, CASE WHEN new.k IS NULL THEN old.status ELSE new.status END AS status,
  CAST(CASE WHEN new.k IS NULL THEN old.price ELSE new.price END AS DOUBLE) AS price,
  CASE WHEN new.k IS NULL THEN old.at ELSE new.at END AS at
FROM old FULL JOIN new ON old.k = new.k""",
)
def k4(spark, d):
    old, new = _merge_sides(spark, d)
    return merge.merge_frames(old, new, ["k"])


@query(
    "k5_merge_rules",
    f"""WITH {_MERGE_SIDES}, o AS (SELECT k, price AS open_price, price AS high_price, price AS low_price, price AS close_price FROM old),
n AS (SELECT k, price AS open_price, price AS high_price, price AS low_price, price AS close_price FROM new)
SELECT coalesce(n.k, o.k) AS k,
  CAST(CASE WHEN o.k IS NULL THEN n.open_price ELSE o.open_price END AS DOUBLE) AS open_price,
  CAST(greatest(o.high_price, n.high_price) AS DOUBLE) AS high_price,
  CAST(least(o.low_price, n.low_price) AS DOUBLE) AS low_price,
  CAST(CASE WHEN n.k IS NULL THEN o.close_price ELSE n.close_price END AS DOUBLE) AS close_price
FROM o FULL JOIN n ON o.k = n.k""",
)
def k5(spark, d):
    names = ("open_price", "high_price", "low_price", "close_price")
    old, new = (s.select("k", *[F.col("price").alias(n) for n in names]) for s in _merge_sides(spark, d))
    return merge.merge_frames(old, new, ["k"], merge.STREAM_RULES)


# ------------------------------------------------------------------- projections (P)

_RECORD_SQL = f"WITH {TICKS}, {candles_sql('1m')} {candle_columns('1m')}"


@query("p1_kline_projection", _RECORD_SQL)
def p1(spark, d):
    raw = I.kline_records(spark, d)
    dim = materialize(I.dim(spark, d), "dim")
    return contract.kline_facts(dims.with_symbol_id(raw, dim))


TICKER_FACTS_SQL = f"""WITH {TICKS}, {I.TICKER_HOURS}
SELECT symbol_id, hour AS snapshot_time, CAST(last - first AS DOUBLE) AS price_change,
  CAST(percent AS DOUBLE) AS price_change_percent, CAST(last AS DOUBLE) AS last_price, CAST(high AS DOUBLE) AS high_price,
  CAST(low AS DOUBLE) AS low_price, CAST(n AS DOUBLE) AS volume_base_24h, CAST(total AS DOUBLE) AS volume_quote_24h,
  n AS trade_count, TIMESTAMP '{STAMP}' AS ingested_at
FROM tickers"""


@query(
    "p2_ticker_projection",
    TICKER_FACTS_SQL, price_change_percent=3,
)
def p2(spark, d):
    dim = materialize(I.dim(spark, d), "dim")
    return contract.ticker_facts(dims.with_symbol_id(I.ticker_records(spark, d), dim), _stamp())


@query(
    "p3_trade_projection",
    f"""WITH {CODES}, {TRADES}
SELECT c.symbol_id, count(*) AS n, CAST(sum(q) AS DOUBLE) AS quote_qty, count(*) FILTER (maker) AS makers
FROM trades t JOIN codes c ON t.symbol_id = c.symbol_id GROUP BY 1""",
)
def p3(spark, d):
    # maker buys lack their quote quantity, which is then price x quantity
    raw = I.trade_records(spark, d).withColumn(
        "quote_qty", F.when(~F.col("is_buyer_maker"), F.col("quote_qty"))
    )
    dim = materialize(I.dim(spark, d), "dim")
    facts = contract.trade_facts(dims.with_symbol_id(raw, dim))
    return facts.groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("quote_qty").alias("quote_qty"),
        F.count_if("is_buyer_maker").alias("makers"),
    )


@query(
    "p4_alias_resolution",
    """SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE o_totalprice + 1 END AS "quoteVolume",
  o_orderstatus AS "lastPrice" FROM orders""",
)
def p4(spark, d):
    both = F.col("o_orderstatus") == "O"
    rows = I.table(spark, d, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") + 1).alias("quote_volume"),
        F.when(both, F.col("o_totalprice")).alias("quoteVolume"),
        F.col("o_orderstatus").alias("last_price"),
    )
    return contract.normalise(rows, "ticker")


@query(
    "p5_ingest_contract",
    """SELECT event_id AS trade_id, CASE WHEN event_type = 'signup' THEN 'UNKNOWN' ELSE event_type END AS symbol,
  CASE WHEN event_type = 'error' THEN 1706745600000 ELSE epoch_us(ts) // 1000 END AS event_ms,
  CAST(CAST(CASE WHEN event_type = 'error' THEN TIMESTAMP '2024-02-01' ELSE ts END AS DATE) AS VARCHAR) AS date,
  strftime(CASE WHEN event_type = 'error' THEN TIMESTAMP '2024-02-01' ELSE ts END, '%H') AS hour
FROM events""",
)
def p5(spark, d):
    # socket records have an event time, fetched ones (view) only a trade time, errors none
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    kind = F.col("event_type")
    rows = I.table(spark, d, "events").select(
        F.col("event_id").alias("trade_id"),
        F.when(kind != "signup", kind).alias("symbol"),
        F.when(kind == "error", F.lit(0)).when(kind != "view", ms).alias("event_time"),
        F.when(kind != "error", ms).alias("time"),
    )
    fallback = F.lit(1_706_745_600_000).cast("long")
    return contract.ingest_contract(rows, "trades", fallback).select(
        "trade_id", "symbol", "event_ms", "date", "hour"
    )


@query(
    "p6_partition_keys",
    """SELECT coalesce(CASE WHEN event_type <> 'error' THEN event_type END, 'UNKNOWN') AS symbol,
  strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, count(*) AS n
FROM events GROUP BY 1, 2, 3""",
)
def p6(spark, d):
    rows = I.table(spark, d, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("symbol"),
    )
    keyed = contract.partition_keys(rows, F.col("ts"))
    return keyed.groupBy("symbol", "date", "hour").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p7_pin_text",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS price, CAST(o_orderkey AS VARCHAR) AS qty,
  o_orderstatus AS source FROM orders""",
)
def p7(spark, d):
    rows = I.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("price"), F.col("o_orderkey").alias("qty"),
        F.col("o_orderstatus").alias("source"),
    )
    return contract.pin_text(rows, "trades")


@query(
    "p8_json_values",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type <> 'error'",
)
def p8(spark, d):
    # values of errors are cut off, so they do not parse and are filtered
    props = F.when(F.col("event_type") != "error", F.col("props")).otherwise(F.lit('{"k": '))
    body = F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(', "p": '), props, F.lit("}"))
    rows = I.table(spark, d, "events").select(body.alias("value"))
    parsed = contract.parse_json(rows, "event_id bigint, p struct<k:bigint>")
    return parsed.filter("p.k IS NOT NULL").select("event_id", "p.k")


@query(
    "p9_asset_split",
    f"""WITH {CODES} SELECT symbol_code,
  CASE WHEN symbol_id % 6 = 5 THEN symbol_code ELSE 'U' || symbol_id END AS base_asset,
  CASE symbol_id % 6 WHEN 0 THEN 'USDT' WHEN 1 THEN 'BUSD' WHEN 2 THEN 'FDUSD'
                     WHEN 3 THEN 'BTC' WHEN 4 THEN 'ETH' ELSE '' END AS quote_asset FROM codes""",
)
def p9(spark, d):
    return dims.split_codes(I.dim(spark, d).select("symbol_code"))


# --------------------------------------------------------------------- filters (F)

@query(
    "f1_required_fields",
    """SELECT event_id, round(value, 2) AS quote_qty FROM events
WHERE event_type <> 'error' AND event_type <> 'signup'""",
)
def f1(spark, d):
    text = (
        F.when(F.col("event_type") == "error", F.lit("nan"))
        .when(F.col("event_type") == "signup", F.lit("abc"))
        .otherwise(F.col("value").cast("string"))
    )
    rows = I.table(spark, d, "events").select("event_id", text.try_cast(schemas.AMOUNT).alias("quote_qty"))
    return filters.require(rows, "event_id", "quote_qty")


@query(
    "f2_sane_years",
    "SELECT o_orderkey, o_orderdate AS open_time FROM orders WHERE year(o_orderdate) BETWEEN 2000 AND 2100",
)
def f2(spark, d):
    rows = I.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("open_time"))
    return filters.sane(rows)


@query(
    "f3_entity_list",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def f3(spark, d):
    listed = I.table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    facts = I.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return filters.members(facts, listed.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


@query("f4_interval_filter", f"WITH {TICKS}, {candles_sql('1d')} {candle_columns('1d')}")
def f4(spark, d):
    # of a stored table, so the folders of the other intervals are not opened
    table = tables.fact_klines(new_path(spark, "fact"))
    hours = C.resample(I.candles_1m(spark, d), "1h")
    rows = I.table(spark, d, "events").count()
    longer = C.resample_all(hours, [i for i in C.TARGETS if C.INTERVALS[i] > 3_600], rows)
    with partitions_for(spark, rows):
        table.upsert(longer)
    return filters.of_interval(table.read(spark), "1d")


_TICKER_SQL = f"""{TICKS}, {CODES}, tick24 AS (
  SELECT symbol_code AS symbol, sum(price) AS qv FROM ticks JOIN codes USING (symbol_id) GROUP BY 1)"""


def _tickers(spark, d):
    totals = I.ticks(spark, d).groupBy("symbol_id").agg(F.sum("price").alias("quoteVolume"))
    return totals.select(I.code_of(F.col("symbol_id")).alias("symbol"), "quoteVolume")


@query(
    "f5_universe",
    f"""WITH {_TICKER_SQL}, marked AS (
  SELECT CASE WHEN qv > 3500 THEN replace(symbol, 'USDT', 'UPUSDT') ELSE symbol END AS symbol, qv FROM tick24)
SELECT symbol, CAST(qv AS DOUBLE) AS "quoteVolume" FROM marked
WHERE symbol LIKE '%USDT' AND symbol NOT LIKE '%UPUSDT' AND qv > 0""",
)
def f5(spark, d):
    # the busiest symbols are renamed to leveraged tokens
    leveraged = F.when(F.col("quoteVolume") > 3500, F.regexp_replace("symbol", "USDT", "UPUSDT"))
    marked = _tickers(spark, d).withColumn("symbol", F.coalesce(leveraged, "symbol"))
    return filters.universe(marked)


# ------------------------------------------------------------------------ joins (J)

def _listed(spark, d):
    """Symbols with a known quote asset; the others are unknown to the dimension."""
    return I.dim(spark, d).filter("symbol_code NOT LIKE '%XYZ'")


@query(
    "j1_fact_with_dim",
    f"""WITH {TICKS}, {CODES}
SELECT c.symbol_id, count(*) AS n, CAST(sum(price) AS DOUBLE) AS total
FROM ticks t JOIN codes c ON t.symbol_id = c.symbol_id WHERE c.symbol_code NOT LIKE '%XYZ' GROUP BY 1""",
)
def j1(spark, d):
    rows = I.ticks(spark, d).select(I.code_of(F.col("symbol_id")).alias("symbol"), "price")
    dim = materialize(_listed(spark, d), "dim")
    return dims.with_symbol_id(rows, dim).groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("total")
    )


@query(
    "j2_detail_with_stats",
    f"""WITH {_STATS} SELECT t.symbol_id, count(*) FILTER (CAST(q AS DOUBLE) > thr) AS above, count(*) AS n
FROM trades t JOIN stats s ON t.symbol_id = s.symbol_id GROUP BY 1""",
)
def j2(spark, d):
    rows = I.trades(spark, d)
    totals = materialize(flow.trade_totals(rows), "totals")
    stats = totals.select("symbol_id", "whale_threshold", "total_trades")
    joined = flow.lookup_join(rows, stats, ["symbol_id"], "total_trades")
    above = F.col("quote_qty").cast("double") > F.col("whale_threshold")
    return joined.groupBy("symbol_id").agg(
        F.count_if(above).alias("above"), F.count(F.lit(1)).alias("n")
    )


@query(
    "j5_semi_membership",
    f"""WITH {TICKS}, {CODES}
SELECT symbol_code AS symbol, count(*) AS n FROM ticks JOIN codes USING (symbol_id)
WHERE symbol_code LIKE '%USDT' GROUP BY 1""",
)
def j5(spark, d):
    rows = I.ticks(spark, d).select(I.code_of(F.col("symbol_id")).alias("symbol"))
    active = I.dim(spark, d).filter(F.col("symbol_code").endswith("USDT"))
    kept = filters.members(rows, active.select(F.col("symbol_code").alias("symbol")), "symbol")
    return kept.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j6_unknown_symbols",
    f"""WITH {TICKS}, {CODES}
SELECT event_type, symbol_code AS symbol, count(*) AS n FROM ticks JOIN codes USING (symbol_id)
WHERE symbol_code LIKE '%XYZ' GROUP BY 1, 2""",
)
def j6(spark, d):
    rows = I.table(spark, d, "events").select(I.code_of(F.col("user_id")).alias("symbol"), "event_type")
    dim = materialize(_listed(spark, d), "dim")
    rejected = dims.unknown_symbols(rows, dim)
    return rejected.groupBy("event_type", "symbol").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------- dimension (D)

# Known before: users of the first half day. Found this time: users of the last days.
_OLD_DIM = """early AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-01 12:00:00'),
found AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-29'),
old AS (SELECT row_number() OVER (ORDER BY symbol_code) AS symbol_id, symbol_code
  FROM codes WHERE symbol_id IN (SELECT user_id FROM early))"""
_IDS_OF = """{codes}, {old}, ids AS (
  SELECT symbol_id, symbol_code, false AS fresh FROM old
  UNION ALL
  SELECT (SELECT max(symbol_id) FROM old) + row_number() OVER (ORDER BY symbol_code), symbol_code, true
  FROM codes WHERE symbol_id NOT IN (SELECT user_id FROM early){extra})"""


_IDS = _IDS_OF.format(codes=CODES, old=_OLD_DIM, extra="")
_FOUND_IDS = _IDS_OF.format(
    codes=CODES, old=_OLD_DIM, extra=" AND symbol_id IN (SELECT user_id FROM found)"
)


def _users(spark, d, condition):
    seen = I.table(spark, d, "events").filter(condition).select("user_id").distinct()
    return seen.select(I.code_of(F.col("user_id")).alias("symbol_code"))


def _old_dim(spark, d):
    half = _users(spark, d, "ts < timestamp_ntz'2024-01-01 12:00:00'")
    empty = spark.createDataFrame([], schemas.DIM_SYMBOLS)
    return dims.build_dim(empty, half, F.lit("2024-01-01").cast("timestamp"))


@query("d3_surrogate_keys", f"WITH {_IDS} SELECT symbol_id, symbol_code FROM ids")
def d3(spark, d):
    return dims.assign_ids(_old_dim(spark, d), I.dim(spark, d))


@query("d3_surrogate_keys_ranged", f"WITH {_IDS} SELECT symbol_id, symbol_code FROM ids")
def d3_ranged(spark, d):
    # numbering as done for very many new codes: by range, not in one task
    return dims.assign_ids(_old_dim(spark, d), I.dim(spark, d), single_task_rows=0)


@query(
    "d1_symbol_dimension",
    f"""WITH {_FOUND_IDS} SELECT ids.symbol_id, ids.symbol_code,
  CASE WHEN codes.symbol_id % 6 = 5 THEN ids.symbol_code ELSE 'U' || codes.symbol_id END AS base_asset,
  CASE codes.symbol_id % 6 WHEN 0 THEN 'USDT' WHEN 1 THEN 'BUSD' WHEN 2 THEN 'FDUSD'
                     WHEN 3 THEN 'BTC' WHEN 4 THEN 'ETH' ELSE '' END AS quote_asset,
  CASE WHEN fresh THEN TIMESTAMP '{STAMP}' ELSE TIMESTAMP '2024-01-01' END AS created_at,
  CASE WHEN codes.symbol_id IN (SELECT user_id FROM found) THEN TIMESTAMP '{STAMP}'
       ELSE TIMESTAMP '2024-01-01' END AS updated_at
FROM ids JOIN codes USING (symbol_code)""",
)
def d1(spark, d):
    found = _users(spark, d, "ts >= timestamp_ntz'2024-01-29'")
    return dims.build_dim(_old_dim(spark, d), found, _stamp())


@query(
    "d2_code_lookup",
    f"""WITH {CODES} SELECT symbol_id, count(*) AS n, sum(event_id) AS ids
FROM events JOIN codes ON user_id = symbol_id WHERE symbol_code NOT LIKE '%XYZ' GROUP BY 1""",
)
def d2(spark, d):
    # events carry the code; symbols without a known quote asset are not in the dimension
    dim = materialize(I.dim(spark, d).filter("symbol_code NOT LIKE '%XYZ'"), "dim")
    events = I.table(spark, d, "events").select(I.code_of(F.col("user_id")).alias("symbol"), "event_id")
    return dims.with_symbol_id(events, dim).groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


# ------------------------------------------------------------------------------- U1

@query(
    "u1_union_sources",
    """SELECT key, source, count(*) AS n FROM (
  SELECT o_custkey AS key, 'orders' AS source FROM orders
  UNION ALL SELECT user_id, 'events' FROM events) GROUP BY 1, 2""",
)
def u1(spark, d):
    orders = I.table(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.lit("orders").alias("source"))
    events = I.table(spark, d, "events").select(F.lit("events").alias("source"), F.col("user_id").alias("key"))
    return orders.unionByName(events).groupBy("key", "source").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- scalar functions (X)

@query(
    "x1_strings",
    """SELECT c_custkey, c_name LIKE '%7' AS ends, substring(c_name, 1, 8) AS head,
  regexp_extract(c_name, '#0*([0-9]+)', 1) AS number, lower(c_mktsegment) AS segment FROM customer""",
)
def x1(spark, d):
    return I.table(spark, d, "customer").select(
        "c_custkey",
        F.col("c_name").endswith("7").alias("ends"),
        F.substring("c_name", 1, 8).alias("head"),
        F.regexp_extract("c_name", "#0*([0-9]+)", 1).alias("number"),
        F.lower("c_mktsegment").alias("segment"),
    )


@query(
    "x2_times",
    """SELECT event_id, date_trunc('milliseconds', ts) AS from_ms, ts AS from_us, date_trunc('hour', ts) AS hour_start,
  CAST(year(ts) AS INTEGER) AS year, CAST(ts AS DATE) AS day, strftime(ts, '%H') AS hour FROM events""",
)
def x2(spark, d):
    ts = F.col("ts").cast("timestamp")
    return I.table(spark, d, "events").select(
        "event_id",
        from_millis(F.unix_millis(ts)).alias("from_ms"),
        from_micros(F.unix_micros(ts)).alias("from_us"),
        F.date_trunc("hour", ts).alias("hour_start"),
        F.year(ts).alias("year"),
        utc_date(ts).alias("day"),
        utc_hour(ts).alias("hour"),
    )


@query(
    "x3_arithmetic",
    """SELECT l_orderkey, l_linenumber, l_shipdate, greatest(l_discount, l_tax) AS hi, least(l_discount, l_tax) AS lo,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(10,0)) AS DOUBLE) AS product,
  CASE WHEN l_tax <> 0 THEN l_discount / l_tax END AS ratio,
  greatest(0.0, least(1.0, l_discount * 20 - 0.5)) AS clamped FROM lineitem""",
)
def x3(spark, d):
    a, b = F.col("l_discount"), F.col("l_tax")
    return I.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        F.greatest(a, b).alias("hi"),
        F.least(a, b).alias("lo"),
        contract.times("l_extendedprice", "l_quantity").alias("product"),
        F.try_divide(a, b).alias("ratio"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), a * 20 - 0.5)).alias("clamped"),
    )


@query(
    "x4_conditions",
    """SELECT event_id, CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'mid' ELSE 'low' END AS band,
  coalesce(CASE WHEN event_type = 'view' THEN value END, 0.5) AS filled,
  (CASE WHEN event_type = 'view' THEN value END) IS NOT NULL AS known,
  value BETWEEN 10 AND 20 AS within FROM events""",
)
def x4(spark, d):
    value = F.col("value")
    viewed = F.when(F.col("event_type") == "view", value)
    return I.table(spark, d, "events").select(
        "event_id",
        F.when(value > 50, "high").when(value > 10, "mid").otherwise("low").alias("band"),
        F.coalesce(viewed, F.lit(0.5)).alias("filled"),
        viewed.isNotNull().alias("known"),
        value.between(10, 20).alias("within"),
    )


@query(
    "x5_json",
    """SELECT event_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS line,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def x5(spark, d):
    return I.table(spark, d, "events").select(
        "event_id",
        F.to_json(F.struct("user_id", "event_type")).alias("line"),
        F.from_json("props", "k bigint")["k"].alias("k"),
    )


@query(
    "x6_casts",
    """SELECT o_orderkey, round(o_totalprice, 2) AS as_decimal, o_custkey AS as_long,
  o_orderstatus = 'O' AS as_flag, CAST(o_custkey AS VARCHAR) AS as_text,
  CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS maybe FROM orders""",
)
def x6(spark, d):
    is_open = F.col("o_orderstatus") == "O"
    maybe = F.when(is_open, F.col("o_custkey").cast("string")).otherwise(F.lit("n/a"))
    return I.table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").try_cast(schemas.AMOUNT).alias("as_decimal"),
        F.col("o_custkey").cast("string").try_cast("long").alias("as_long"),
        F.when(is_open, "true").otherwise("false").try_cast("boolean").alias("as_flag"),
        F.col("o_custkey").cast("string").alias("as_text"),
        maybe.try_cast("long").alias("maybe"),
    )
