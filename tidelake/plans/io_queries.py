"""Sources and sinks: data derived from the test tables goes out and comes back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.functions import bucket_start
from tidelake.operators import candles as C
from tidelake.operators import contract, quality, ranking
from tidelake.plans import inputs as I
from tidelake.plans.batch import Inputs, Warehouse, run_batch
from tidelake.plans.batch_queries import _TICKER_SQL, TICKER_FACTS_SQL, _stamp, _tickers
from tidelake.plans.catalog import (
    CODES, TICKS, TRADES, all_candles_sql, candle_columns, candles_sql, query,
)
from tidelake.plans.ranking_queries import MART_DIGITS, _SCORED, mart_sql
from tidelake.session import materialize, new_path, partitions_for
from tidelake.sinks import tables, versions
from tidelake.sources import files

# The landing layout has a folder per date, symbol and hour. Here the event type stands
# for the symbol and hours are halved days, which keeps the number of folders small.
_HALF_DAY = 43_200
LANDED_SQL = """SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS symbol,
  CASE WHEN hour(ts) < 12 THEN '00' ELSE '12' END AS hour,"""


def trade_rows(spark: SparkSession, d: str) -> DataFrame:
    """events as raw trade records at half-day times, with text numerics."""
    rows = I.table(spark, d, "events").withColumn(
        "at", bucket_start(F.col("ts").cast("timestamp"), _HALF_DAY)
    )
    values = {
        "symbol": F.col("event_type"), "event_time": F.unix_millis("at"),
        "trade_id": F.col("event_id"), "price": F.col("value").cast("string"), "qty": F.lit("1"),
        "time": F.unix_millis("at"), "is_buyer_maker": F.col("event_type") == "view",
        "source": F.lit("websocket"), "timestamp": F.col("at").cast("string"),
    }
    return rows.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.RAW_TRADE]
    )


def _landed(spark, d, fmt: str) -> str:
    path = new_path(spark, f"landed-{fmt}")
    rows = contract.ingest_contract(trade_rows(spark, d), "trades", F.lit(0))
    (
        contract.pin_text(rows.drop("event_ms"), "trades")
        .hint("rebalance", *files.LAYOUT)
        .write.partitionBy(*files.LAYOUT).format(fmt).save(path)
    )
    return path


_LANDED_TOTALS = f"""{LANDED_SQL} count(*) AS n, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 2) AS total
FROM events GROUP BY 1, 2, 3"""


def landed_totals(df: DataFrame) -> DataFrame:
    return df.groupBy(*files.LAYOUT).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("price").try_cast(schemas.AMOUNT)).alias("total")
    )


# ------------------------------------------------------------------------ S1 - S4

def _csv(df: DataFrame, label: str) -> str:
    path = new_path(df.sparkSession, label)
    df.write.option("header", "true").csv(path)
    return path


@query("s1_csv_scan_klines", f"WITH {TICKS}, {CODES}, {candles_sql('1m')} {candle_columns('1m')}")
def s1(spark, d):
    rows = I.kline_records(spark, d).select(*_kline_csv_columns())
    raw = files.load_csv(spark, _csv(rows, "klines-csv"), schemas.CSV_KLINES)
    number = F.regexp_extract("symbol", "^U([0-9]+)[A-Z]", 1).cast("long")
    return contract.kline_facts(raw.withColumn("symbol_id", number))


def _kline_csv_columns():
    return schemas.CSV_KLINES.fieldNames()


def _trade_files(spark, d) -> str:
    """A CSV file of trades per symbol, named after it, which is the only place of the symbol; the
    folder that holds nothing else. A glob would make every file a root path, listed by itself."""
    rows = I.trade_records(spark, d)
    by_symbol, path = new_path(spark, "trades-by-symbol"), new_path(spark, "trades-csv")
    columns = ["symbol", *schemas.CSV_TRADES.fieldNames()]
    rows.select(*columns).repartition("symbol").write.option("header", "true").partitionBy("symbol").csv(by_symbol)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    disk = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    disk.mkdirs(Path(path))

    def name(folder: str) -> None:
        symbol = folder.rpartition("=")[2]
        for i, status in enumerate(disk.globStatus(Path(f"{folder}/part-*"))):
            if i:
                raise ValueError(f"more than one file of {symbol}")
            if not disk.rename(status.getPath(), Path(f"{path}/trades_{symbol}_30d.csv")):
                raise OSError(f"could not name the file of {symbol}")

    # each waits for the store, so many go side by side
    folders = [s.getPath().toString() for s in disk.listStatus(Path(by_symbol)) if s.isDirectory()]
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(name, folders))
    return path


@query(
    "s3_csv_scan_trades",
    """SELECT l_suppkey AS symbol_id, l_orderkey AS trade_id, CAST(l_shipdate AS TIMESTAMP) AS trade_time,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price, CAST(CAST(l_quantity AS DECIMAL(10,0)) AS DOUBLE) AS qty_base,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(10,0)) AS DOUBLE) AS quote_qty,
  l_returnflag = 'R' AS is_buyer_maker, true AS is_best_match
FROM lineitem""",
)
def s3(spark, d):
    raw = files.load_trades_csv(spark, _trade_files(spark, d), schemas.CSV_TRADES)
    number = F.regexp_extract("symbol", "^U([0-9]+)[A-Z]", 1).cast("long")
    rows = contract.recent_trades(raw.withColumn("symbol_id", number), _stamp())
    return rows.drop("ingested_at")


@query("s4_csv_scan_ticker", TICKER_FACTS_SQL, price_change_percent=3)
def s4(spark, d):
    rows = I.ticker_records(spark, d).select(*schemas.CSV_TICKER.fieldNames())
    raw = files.load_csv(spark, _csv(rows, "ticker-csv"), schemas.CSV_TICKER)
    number = F.regexp_extract("symbol", "^U([0-9]+)[A-Z]", 1).cast("long")
    return contract.ticker_facts(raw.withColumn("symbol_id", number), _stamp())


# ------------------------------------------------------------------- S5, S6, S10 - S13

@query("s5_silver_scan", _LANDED_TOTALS)
def s5(spark, d):
    schema = files.with_layout(schemas.RAW_TRADE)
    return landed_totals(files.load_silver(spark, _landed(spark, d, "parquet"), "trades", schema))


@query("s5_silver_scan_merged_schema", _LANDED_TOTALS)
def s5_merged(spark, d):
    rows = files.load_silver(spark, _landed(spark, d, "parquet"), "trades")
    return landed_totals(
        rows.withColumns({"date": F.col("date").cast("string"), "hour": F.lpad(F.col("hour").cast("string"), 2, "0")})
    )


@query("s6_bronze_scan", _LANDED_TOTALS)
def s6(spark, d):
    path = _landed(spark, d, "json")
    schema = files.with_layout(schemas.RAW_TRADE)
    return landed_totals(files.load_json(spark, f"{path}/date=*/symbol=*", schema, path))


@query(
    "s10_column_from_file_name",
    """SELECT 'events' AS entity, count(*) AS n FROM events
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'customer', count(*) FROM customer""",
)
def s10(spark, d):
    entity = files.from_file_name(r"([a-z]+)\.parquet").alias("entity")
    parts = [I.table(spark, d, n).select(entity) for n in ("events", "orders", "customer")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))


@query("s11_discover_symbols", "SELECT DISTINCT event_type AS symbol FROM events")
def s11(spark, d):
    return files.discover_symbols(spark, _landed(spark, d, "parquet"))


@query(
    "s12_layout_time",
    f"""SELECT symbol, CAST(date || ' ' || hour || ':00:00' AS TIMESTAMP) AS snapshot_time, count(*) AS n
FROM ({LANDED_SQL} 1 AS one FROM events) GROUP BY 1, 2""",
)
def s12(spark, d):
    schema = files.with_layout(schemas.RAW_TRADE)
    rows = files.load_silver(spark, _landed(spark, d, "parquet"), "trades", schema)
    return rows.groupBy("symbol", files.layout_time().alias("snapshot_time")).agg(
        F.count(F.lit(1)).alias("n")
    )


# A task that writes one file per value keeps so many of them open and sorts only rows of others.
_OPEN_FILES = 32
_SMALL_GROUPS = {"parquet.block.size": 16 << 20}


@contextmanager
def _open_files(spark: SparkSession):
    """Let tasks append to the files of several values at once, instead of sorting all rows first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, _OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@query(
    "s13_input_audit",
    """SELECT 'klines' AS dataset, count(DISTINCT CAST(ts AS DATE)) AS files FROM events
UNION ALL SELECT 'ticker', 0 UNION ALL SELECT 'trades', count(DISTINCT l_returnflag) FROM lineitem""",
)
def s13(spark, d):
    # a file per day of events, none of tickers, and one per return flag of line items
    path = new_path(spark, "inputs")
    days = I.table(spark, d, "events").withColumn("day", F.to_date("ts"))
    flags = I.table(spark, d, "lineitem").select("l_orderkey", "l_returnflag")
    with _open_files(spark):
        days.repartition("day").write.partitionBy("day").options(**_SMALL_GROUPS).parquet(f"{path}/klines")
        flags.repartition("l_returnflag").write.partitionBy("l_returnflag").options(**_SMALL_GROUPS).parquet(f"{path}/trades")
    return files.audit_inputs(spark, {
        "klines": f"{path}/klines/day=*/*.parquet",
        "ticker": f"{path}/ticker_24h_*.csv",
        "trades": f"{path}/trades/*/*.parquet",
    })


# ------------------------------------------------------------------------- K2 - K5

@query("k2_replace_snapshot", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O'")
def k2(spark, d):
    path = new_path(spark, "snapshot")
    orders = I.table(spark, d, "orders")
    rows = orders.select("o_orderkey", "o_custkey")
    tables.replace_snapshot(rows, path)
    tables.replace_snapshot(orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey"), path)
    return tables.read_snapshot(spark, path, rows.schema)


@query(
    "k3_append_history",
    "SELECT o_orderpriority, run, count(*) AS n FROM orders, (SELECT 1 AS run UNION ALL SELECT 2) GROUP BY 1, 2",
)
def k3(spark, d):
    path = new_path(spark, "history")
    rows = I.table(spark, d, "orders").select("o_orderpriority")
    for run in (1, 2):
        tables.append_history(rows.withColumn("run", F.lit(run)), path)
    tables.append_history(rows.limit(0).withColumn("run", F.lit(3)), path)
    return spark.read.schema("o_orderpriority string, run int").parquet(path).groupBy(
        "o_orderpriority", "run"
    ).agg(F.count(F.lit(1)).alias("n"))


_HALVES = f"""WITH {TICKS}, {candles_sql('1h')}, final AS (
  SELECT symbol_id, open_time, close_time, open_price,
    CASE WHEN day(open_time) >= 10 AND day(open_time) < 20 THEN {{high}} ELSE high_price END AS high_price,
    low_price, close_price, volume_base,
    CASE WHEN day(open_time) >= 10 THEN volume_quote + 1 ELSE volume_quote END AS volume_quote,
    num_trades, taker_buy_quote_volume FROM candles)
{candle_columns('1h', 'final')}"""


def _upsert_halves(spark, d, rules):
    table = tables.fact_klines(new_path(spark, "fact"), rules)
    hours = materialize(C.resample(I.candles_1m(spark, d), "1h"), "hours")
    day = F.dayofmonth("open_time")
    newer = hours.filter(day >= 10).withColumns({
        "volume_quote": (F.col("volume_quote") + 1).cast(schemas.AMOUNT),
        "high_price": F.when(day < 20, F.col("high_price") - 1).otherwise(F.col("high_price")).cast(schemas.AMOUNT),
    })
    table.upsert(hours.filter(day < 20))
    table.upsert(newer)
    table.upsert(newer)   # a repeated batch changes nothing
    return table.read(spark)


@query("k4_table_upsert", _HALVES.format(high="high_price - 1"))
def k4_table(spark, d):
    return _upsert_halves(spark, d, {})


@query("k5_table_upsert_rules", _HALVES.format(high="high_price"))
def k5_table(spark, d):
    return _upsert_halves(spark, d, {"open_price": "keep", "high_price": "greatest", "low_price": "least"})


# -------------------------------------------------------------------------- P10

_WIRE_SQL = f"WITH {TICKS}, {candles_sql('1m')} {candle_columns('1m')}"


def _array(one: Column) -> Column:
    """JSON texts of a group as one JSON array."""
    return F.concat(F.lit("["), F.concat_ws(",", F.collect_list(one)), F.lit("]"))


def _wire_facts(parsed: DataFrame) -> DataFrame:
    named = contract.normalise(parsed, "klines")
    return contract.kline_facts(named.withColumn("symbol_id", F.col("symbol").cast("long")))


@query("p10_pushed_klines", _WIRE_SQL)
def p10_pushed(spark, d):
    c = I.candles_1m(spark, d)
    text = {
        "o": "open_price", "h": "high_price", "l": "low_price", "c": "close_price",
        "v": "volume_base", "q": "volume_quote", "V": "volume_base", "Q": "taker_buy_quote_volume",
    }
    k = F.to_json(F.struct(
        F.unix_millis("open_time").alias("t"), F.unix_millis("close_time").alias("T"),
        F.col("interval_code").alias("i"), F.col("num_trades").alias("n"), F.lit(True).alias("x"),
        *[F.col(name).cast("string").alias(key) for key, name in text.items()],
    ))
    payload = F.concat(
        F.lit('{"e":"kline","E":'), F.unix_millis("close_time"),
        F.lit(',"s":"'), F.col("symbol_id"), F.lit('","k":'), k, F.lit("}"),
    )
    return _wire_facts(contract.parse_pushed_klines(c.select(payload.alias("payload"))))


@query("p10_fetched_klines", _WIRE_SQL)
def p10_fetched(spark, d):
    # a response holds the candles of one symbol and day
    c = I.candles_1m(spark, d)
    order = (
        F.unix_millis("open_time"), *[F.col(f"{n}_price") for n in ("open", "high", "low", "close")],
        F.col("volume_base"), F.unix_millis("close_time"), F.col("volume_quote"),
        F.col("num_trades"), F.col("volume_base"), F.col("taker_buy_quote_volume"), F.lit("0"),
    )
    one = F.concat(F.lit('["'), F.concat_ws('","', *[v.cast("string") for v in order]), F.lit('"]'))
    rows = c.groupBy("symbol_id", "interval_code", F.to_date("open_time").alias("day")).agg(_array(one).alias("payload"))
    return _wire_facts(contract.parse_fetched_klines(rows.select(
        F.col("symbol_id").cast("string").alias("symbol"), F.col("interval_code").alias("interval"), "payload")))


@query(
    "p10_pushed_trades",
    """SELECT event_id AS trade_id, event_type AS symbol, epoch_us(ts) // 1000 AS time, value AS price, round(3.0 * value, 2) AS quote_qty,
  event_type = 'view' AS is_buyer_maker FROM events""",
    quote_qty=2,
)
def p10_trades(spark, d):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    payload = F.to_json(F.struct(
        ms.alias("E"), F.col("event_type").alias("s"), F.col("event_id").alias("t"),
        F.col("value").cast("string").alias("p"), F.lit("3").alias("q"), ms.alias("T"),
        (F.col("event_type") == "view").alias("m"), F.lit(True).alias("M"),
    ))
    rows = contract.parse_pushed_trades(I.table(spark, d, "events").select(payload.alias("payload")))
    return rows.select(
        "trade_id", "symbol", "time", F.col("price").cast("double").alias("price"),
        F.col("quote_qty").cast("double").alias("quote_qty"), "is_buyer_maker",
    )


@query(
    "p10_fetched_trades",
    """SELECT event_id AS trade_id, event_type AS symbol, epoch_us(ts) // 1000 AS time, value AS price, '3' AS qty,
  event_id + 1 AS first_trade_id, event_id + 2 AS last_trade_id, event_type = 'view' AS is_buyer_maker,
  event_id % 2 = 0 AS is_best_match, 'rest_agg_trade' AS source FROM events""",
)
def p10_fetched_trades(spark, d):
    # responses are pages of a symbol's trades, of at most 1 000 numbers each
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    one = F.to_json(F.struct(
        F.col("event_id").alias("a"), F.col("value").cast("string").alias("p"), F.lit("3").alias("q"),
        (F.col("event_id") + 1).alias("f"), (F.col("event_id") + 2).alias("l"), ms.alias("T"),
        (F.col("event_type") == "view").alias("m"), (F.col("event_id") % 2 == 0).alias("M"),
    ))
    rows = I.table(spark, d, "events").groupBy(
        F.col("event_type").alias("symbol"), F.floor(F.col("event_id") / 1_000).alias("page")
    ).agg(_array(one).alias("payload"))
    return contract.parse_fetched_trades(rows).withColumn("price", F.col("price").cast("double"))


_TICKER_WIRE = f"""WITH {TICKS}, {CODES}, {I.TICKER_HOURS}
SELECT symbol_code AS symbol, {{event_time}} AS event_time, CAST(last - first AS DOUBLE) AS price_change,
  CAST(percent AS DOUBLE) AS price_change_pct, CAST(mean AS DOUBLE) AS weighted_avg_price,
  CAST(first AS DOUBLE) AS prev_close_price, CAST(last AS DOUBLE) AS last_price, 1.0::DOUBLE AS last_qty,
  CAST(low AS DOUBLE) AS bid_price, CAST(high AS DOUBLE) AS ask_price, CAST(first AS DOUBLE) AS open_price,
  CAST(high AS DOUBLE) AS high_price, CAST(low AS DOUBLE) AS low_price, CAST(n AS DOUBLE) AS volume,
  CAST(total AS DOUBLE) AS quote_volume, epoch_ms(hour) + 1234 AS open_time, epoch_ms(hour) + 86400000 AS close_time,
  n AS num_trades, '{{source}}' AS source
FROM tickers JOIN codes USING (symbol_id)"""
_TICKER_NUMBERS = [f for f in contract.TEXT_FIELDS["ticker"] if f in schemas.RAW_TICKER.fieldNames()]


def _ticker_columns(df: DataFrame) -> DataFrame:
    wide = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.RAW_TICKER if f.name != "timestamp"]
    return df.select(*wide).withColumns({n: F.col(n).try_cast(schemas.AMOUNT) for n in _TICKER_NUMBERS})


@query(
    "p10_fetched_tickers", _TICKER_WIRE.format(event_time="CAST(NULL AS BIGINT)", source="rest_snapshot"), price_change_pct=3,
)
def p10_fetched_tickers(spark, d):
    # a response holds the tickers of all symbols at one time
    t = I.ticker_records(spark, d)
    rows = t.groupBy("openTime").agg(_array(F.to_json(F.struct(*t.columns))).alias("payload"))
    return _ticker_columns(contract.parse_fetched_tickers(rows))


@query(
    "p10_pushed_tickers", _TICKER_WIRE.format(event_time="epoch_ms(hour) + 86400000", source="websocket"), price_change_pct=3)
def p10_pushed_tickers(spark, d):
    t = I.ticker_records(spark, d)
    short = {
        "s": "symbol", "E": "closeTime", "p": "priceChange", "P": "priceChangePercent", "w": "weightedAvgPrice",
        "x": "prevClosePrice", "c": "lastPrice", "Q": "lastQty", "b": "bidPrice", "B": "bidQty", "a": "askPrice",
        "A": "askQty", "o": "openPrice", "h": "highPrice", "l": "lowPrice", "v": "volume", "q": "quoteVolume",
        "O": "openTime", "C": "closeTime", "F": "firstId", "L": "lastId", "n": "count",
    }
    # a percentage of a first price of 0 is sent as null
    payload = F.to_json(F.struct(*[F.col(name).alias(key) for key, name in short.items()]), {"ignoreNullFields": "false"})
    return _ticker_columns(contract.parse_pushed_tickers(t.select(payload.alias("payload"))))


# ------------------------------------------------------------------- A14, D7, D8, D9

_DRIFTED = {"error": "double", "view": "float"}


def _drifted(spark, d, broken: bool = False, path: str | None = None) -> str:
    """Silver trades of many days and hours in which two symbols have numeric prices, one file
    a folder. With ``broken`` the times of a third symbol are text that is no number."""
    path = path or new_path(spark, "drifted")
    rows = contract.ingest_contract(trade_rows(spark, d), "trades", F.lit(0)).drop("event_ms")
    symbol = F.col("symbol")
    parts = [rows.filter(symbol == s).withColumn("price", F.col("price").cast(k)) for s, k in _DRIFTED.items()]
    rest = rows.filter(~symbol.isin(list(_DRIFTED)))
    if broken:
        parts.append(rest.filter(symbol == "click").withColumn("time", F.concat(F.lit("at "), F.col("time"))))
        rest = rest.filter(symbol != "click")
    for part in [rest, *parts]:
        part.repartition(*files.LAYOUT).write.mode("append").partitionBy(*files.LAYOUT).parquet(path)
    return path


_SILVER_TRADE = files.with_layout(schemas.RAW_TRADE)
_SLOTS = """slots AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day, hour(ts) < 12 AS am FROM events)"""


@query(
    "d7_schema_drift",
    """SELECT event_type AS symbol, CASE WHEN event_type IN ('error', 'view') THEN 'DRIFT' ELSE 'OK' END AS status,
  CASE WHEN event_type IN ('error', 'view') THEN 'price' END AS field,
  CASE event_type WHEN 'error' THEN 'double' WHEN 'view' THEN 'float' END AS stored,
  count(*) AS num_rows, count(DISTINCT (CAST(ts AS DATE), hour(ts) < 12)) AS files FROM events GROUP BY 1""",
)
def d7(spark, d):
    scan = quality.scan_drift(spark, _drifted(spark, d), _SILVER_TRADE)
    found = scan.select("*", F.explode_outer("mismatches").alias("m"))
    return found.groupBy("symbol", "status", F.col("m.field").alias("field"), F.col("m.stored").alias("stored")).agg(
        F.sum("num_rows").alias("num_rows"), F.countDistinct("path").alias("files")
    )


@query(
    "a14_drift_counts",
    f"""WITH {_SLOTS} SELECT 'trades' AS dataset,
  CASE WHEN event_type IN ('error', 'view') THEN 'DRIFT' ELSE 'OK' END AS status, count(*) AS files
FROM slots GROUP BY 1, 2""",
)
def a14(spark, d):
    scan = quality.scan_drift(spark, _drifted(spark, d), _SILVER_TRADE)
    return quality.drift_summaries({"trades": scan})


@query(
    "d8_drift_repair",
    """SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n,
  round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 1) AS total
FROM events WHERE event_type IN ('error', 'view') GROUP BY 1, 2""",
    total=1,
)
def d8(spark, d):
    path, target = _drifted(spark, d), new_path(spark, "repaired")
    scan = materialize(quality.scan_drift(spark, path, _SILVER_TRADE), "scan")
    for _ in range(2):      # a second run leaves the same rows
        quality.repair_drift(spark, scan, target, _SILVER_TRADE)
    rows = spark.read.schema(_SILVER_TRADE).parquet(target)
    return rows.groupBy("symbol", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("price").cast("decimal(18,2)")).alias("total")
    )


@query("d8_published_repair", _LANDED_TOTALS.replace("AS DOUBLE), 2)", "AS DOUBLE), 1)"), total=1)
def d8_published(spark, d):
    # the table is read by its list before and after; drifted partitions are replaced at once
    path, target = _drifted(spark, d), new_path(spark, "repaired")
    table = versions.VersionedTable(path, _SILVER_TRADE, {n: F.col(n) for n in files.LAYOUT})
    table.adopt(spark)
    scan = materialize(quality.rescan_drift(spark, path, _SILVER_TRADE), "scan")
    done = materialize(quality.repair_drift(spark, scan, target, _SILVER_TRADE), "done")
    quality.publish_repaired(spark, table, scan, done, target)
    return landed_totals(table.read(spark))


@query(
    "d7_second_scan",
    """SELECT event_type AS symbol, CASE WHEN event_type IN ('error', 'view') THEN 'DRIFT' ELSE 'OK' END AS status,
  2 * count(DISTINCT (CAST(ts AS DATE), hour(ts) < 12)) AS files, 2 * count(*) AS num_rows FROM events GROUP BY 1""",
)
def d7_second(spark, d):
    # the dataset doubles between two scans; the second one keeps what the first has found
    path = _drifted(spark, d)
    first = materialize(quality.rescan_drift(spark, path, _SILVER_TRADE), "scan")
    _drifted(spark, d, path=path)
    second = quality.rescan_drift(spark, path, _SILVER_TRADE, first)
    return second.groupBy("symbol", "status").agg(F.count(F.lit(1)).alias("files"), F.sum("num_rows").alias("num_rows"))


@query(
    "d8_repair_status",
    f"""WITH {_SLOTS}, n AS (SELECT event_type, count(*) AS num_rows FROM events GROUP BY 1)
SELECT event_type AS symbol, CASE event_type WHEN 'click' THEN 'FAILED' ELSE 'REPAIRED' END AS status,
  count(*) AS files, any_value(num_rows) AS num_rows,
  CASE event_type WHEN 'click' THEN 0 ELSE any_value(num_rows) END AS readable
FROM slots JOIN n USING (event_type) WHERE event_type IN ('click', 'error', 'view') GROUP BY 1""",
)
def d8_status(spark, d):
    # files that cannot be cast are reported; the others are repaired and put into the lake
    path, target = _drifted(spark, d, broken=True), new_path(spark, "repaired")
    scan = materialize(quality.scan_drift(spark, path, _SILVER_TRADE), "scan")
    done = materialize(quality.repair_drift(spark, scan, target, _SILVER_TRADE), "done")
    quality.swap_repaired(spark, done, target, path)
    after = quality.scan_drift(spark, path, _SILVER_TRADE).filter("NOT path LIKE '%/\\_replaced%'")
    readable = after.filter("status = 'OK'").groupBy("symbol").agg(F.sum("num_rows").alias("_ok"))
    by_symbol = done.withColumn("symbol", F.regexp_extract("path", "/symbol=([^/]+)", 1))
    return by_symbol.groupBy("symbol", "status").agg(
        F.count(F.lit(1)).alias("files"), F.sum("num_rows").alias("num_rows")
    ).join(readable, "symbol", "left").select(
        "symbol", "status", "files", "num_rows", F.coalesce("_ok", F.lit(0)).alias("readable"))


@query(
    "d9_symbol_universe",
    f"""WITH {_TICKER_SQL} SELECT symbol FROM tick24
WHERE symbol LIKE '%USDT' ORDER BY qv DESC, symbol LIMIT 20""",
)
def d9(spark, d):
    path = new_path(spark, "universe")
    tickers = _tickers(spark, d).filter(F.col("symbol").endswith("USDT"))
    tables.active_universe(spark, path, lambda: ranking.top_symbols(tickers, 20))
    # the stored list wins, whatever a second discovery would find
    return tables.active_universe(spark, path, lambda: tickers.limit(1)).select("symbol")


# -------------------------------------------------------------------------- D10

def _run(spark, d) -> Warehouse:
    warehouse = Warehouse(new_path(spark, "warehouse"))
    inputs = Inputs(
        klines=I.kline_records(spark, d), tickers=I.ticker_records(spark, d), trades=I.trade_records(spark, d)
    )
    with partitions_for(spark, max(I.table(spark, d, n).count() for n in ("events", "lineitem"))):
        run_batch(spark, inputs, warehouse, now=_stamp())
    return warehouse


# The dimension numbers the codes itself, so ids are compared through the code.
@query("d10_batch_stages", mart_sql(_SCORED).replace("symbol_id, symbol_code,", "symbol_code,", 1), **MART_DIGITS)
def d10(spark, d):
    return _run(spark, d).top(spark).drop("symbol_id")


@query(
    "d10_batch_klines",
    f"""WITH {CODES}, all_candles AS ({all_candles_sql(C.INTERVALS)})
SELECT interval_code, count(*) AS n, count(DISTINCT symbol_id) AS symbols, round(sum(volume_quote), 2) AS volume,
  sum(num_trades) AS num_trades FROM all_candles GROUP BY 1""",
    volume=2,
)
def d10_klines(spark, d):
    facts = _run(spark, d).klines.read(spark)
    return facts.groupBy("interval_code").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("symbol_id").alias("symbols"),
        F.sum("volume_quote").alias("volume"), F.sum("num_trades").alias("num_trades"),
    )


@query(
    "f2_bad_epochs_in_batch",
    f"""WITH {TICKS}, {candles_sql('1m')}
SELECT count(*) AS n, count(DISTINCT symbol_id) AS symbols, sum(num_trades) AS num_trades, 4 * count(*) AS rejected
FROM candles""",
)
def f2_bad_epochs(spark, d):
    # every record again with its time in microseconds, before year 1, overflowing, missing
    rows = I.kline_records(spark, d)
    times = [F.col("open_time") * 1000, F.lit(-62_135_596_800_001), F.lit(2**63 - 1), F.lit(None).cast("long")]
    bad = [rows.withColumn("open_time", t) for t in times]
    klines = reduce(DataFrame.unionByName, [rows, *bad])
    warehouse = Warehouse(new_path(spark, "warehouse"))
    with partitions_for(spark, (1 + len(bad)) * I.table(spark, d, "events").count()):
        run = run_batch(spark, Inputs(klines=klines, tickers=I.ticker_records(spark, d)), warehouse, now=_stamp())
    minutes = warehouse.klines.read(spark).filter("interval_code = '1m'")
    return minutes.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("symbol_id").alias("symbols"),
        F.sum("num_trades").alias("num_trades"), F.lit(run.rejects["klines"]).cast("long").alias("rejected"),
    )
