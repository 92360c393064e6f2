"""Domain inputs derived from the shared test tables."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.candles import from_ticks
from tidelake.schemas import AMOUNT
from tidelake.session import new_path, shuffles_dropped, stored

MONEY = "decimal(18,2)"
# Quote suffix of a test symbol, by user id modulo 6; XYZ is on no list.
SUFFIXES = ("USDT", "BUSD", "FDUSD", "BTC", "ETH", "XYZ")
# A file of messages is one task's work to write and, as one row group, to read.
ROWS_PER_FILE = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_of(user: Column) -> Column:
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in SUFFIXES]), (F.pmod(user, F.lit(6)) + 1).cast("int")
    )
    return F.concat(F.lit("U"), user.cast("string"), suffix)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as trades of one unit at the event's value."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("symbol_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").cast(MONEY).alias("price"),
        F.lit(1).cast("decimal(1,0)").alias("qty"),
        F.col("event_type").isin("click", "purchase").alias("is_taker_buy"),
        "event_id",
    )


def candles_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_ticks(ticks(spark, sf_dir), tie_break="event_id")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as trades: supplier is the symbol, returned lines are maker buys."""
    value = F.col("l_extendedprice").cast(MONEY) * F.col("l_quantity").cast("decimal(10,0)")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("symbol_id"),
        value.cast(AMOUNT).alias("quote_qty"),
        (F.col("l_returnflag") == "R").alias("is_buyer_maker"),
    )


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as symbols, keeping the user id as symbol id."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(F.col("user_id").alias("symbol_id"), code_of(F.col("user_id")).alias("symbol_code"))


def _half_up(number: str, by: str) -> Column:
    """number / by to the nearest integer, of integers; NULL if ``by`` is 0."""
    return F.expr(f"""(2 * {number} + {by} - pmod(2 * {number} + {by}, nullif(2 * {by}, 0))) div nullif(2 * {by}, 0)""")


def _text(cents: Column, places: int) -> Column:
    return (cents.cast("decimal(24,0)") / F.lit(10**places)).cast(f"decimal(28,{places})").cast("string")


def ticker_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticker record (text numerics, millisecond times) per user and hour of events."""
    rows = ticks(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts"))
    text = "string"
    # of fixed width, to stay with the hash aggregate
    order = F.unix_micros("ts").cast("decimal(18,0)") * F.lit("1" + "0" * 19).cast("decimal(20,0)") + F.col("event_id")
    buys = F.count_if("is_taker_buy")
    hours = rows.withColumn("_at", order).groupBy("symbol_id", "hour").agg(
        F.min_by("price", "_at").alias("first"),
        F.max_by("price", "_at").alias("last"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("price").alias("total"),
        F.count(F.lit(1)).alias("count"),
        buys.alias("buys"),
        F.min("event_id").alias("firstId"),
        F.max("event_id").alias("lastId"),
    )
    cents = {f"{n}_cents": (F.col(n) * 100).cast("long") for n in ("first", "last", "total")}
    return hours.withColumns(cents).select(
        code_of(F.col("symbol_id")).alias("symbol"),
        (F.col("last") - F.col("first")).cast(text).alias("priceChange"),
        _text(_half_up("(100000 * (last_cents - first_cents))", "first_cents"), 3).alias("priceChangePercent"),
        _text(_half_up("total_cents", "count"), 2).alias("weightedAvgPrice"),
        F.col("first").cast(text).alias("prevClosePrice"),
        F.col("last").cast(text).alias("lastPrice"),
        F.lit("1").alias("lastQty"),
        F.col("low").cast(text).alias("bidPrice"),
        (F.col("count") - F.col("buys")).cast(text).alias("bidQty"),
        F.col("high").cast(text).alias("askPrice"),
        F.col("buys").cast(text).alias("askQty"),
        F.col("first").cast(text).alias("openPrice"),
        F.col("high").cast(text).alias("highPrice"),
        F.col("low").cast(text).alias("lowPrice"),
        F.col("count").cast(text).alias("volume"),
        F.col("total").cast(text).alias("quoteVolume"),
        (F.unix_millis("hour") + 1_234).alias("openTime"),
        (F.unix_millis("hour") + 86_400_000).alias("closeTime"),
        "firstId",
        "lastId",
        "count",
    )


# The same in SQL, behind TICKS: prices as decimals, the two quotients as doubles.
TICKER_HOURS = """hours AS (
  SELECT symbol_id, date_trunc('hour', ts) AS hour, arg_min(price, tick_order) AS first, arg_max(price, tick_order) AS last,
    max(price) AS high, min(price) AS low, sum(price) AS total, count(*) AS n, count(*) FILTER (taker) AS buys,
    min(event_id) AS first_id, max(event_id) AS last_id FROM ticks GROUP BY 1, 2),
cents AS (SELECT *, 2 * CAST(100000 * (last - first) * 100 AS BIGINT) + CAST(first * 100 AS BIGINT) AS up,
  nullif(2 * CAST(first * 100 AS BIGINT), 0) AS down, 2 * CAST(total * 100 AS BIGINT) + n AS mean_up FROM hours),
tickers AS (SELECT *, CAST((up - (up % down + down) % down) // down AS BIGINT) / 1000.0 AS percent,
  CAST((mean_up - (mean_up % (2 * n) + 2 * n) % (2 * n)) // (2 * n) AS BIGINT) / 100.0 AS mean FROM cents)"""


def kline_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute candles as raw kline records: text numerics, millisecond times."""
    c = candles_1m(spark, sf_dir)
    return c.select(
        F.unix_millis("open_time").alias("open_time"),
        *[F.col(f"{n}_price").cast("string").alias(n) for n in ("open", "high", "low", "close")],
        F.col("volume_base").cast("string").alias("volume"),
        F.unix_millis("close_time").alias("close_time"),
        F.col("volume_quote").cast("string").alias("quote_asset_volume"),
        "num_trades",
        F.col("volume_base").cast("string").alias("taker_buy_base_vol"),
        F.col("taker_buy_quote_volume").cast("string").alias("taker_buy_quote_vol"),
        F.lit("0").alias("ignore"),
        code_of(F.col("symbol_id")).alias("symbol"),
        F.col("open_time").cast("string").alias("open_time_dt"),
    )


def trade_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as raw trade records (text numerics, microsecond times) of symbols."""
    price = F.col("l_extendedprice").cast(MONEY)
    qty = F.col("l_quantity").cast("decimal(10,0)")
    return table(spark, sf_dir, "lineitem").select(
        code_of(F.col("l_suppkey")).alias("symbol"),
        F.col("l_orderkey").alias("trade_id"),
        price.cast("string").alias("price"),
        qty.cast("string").alias("qty"),
        (price * qty).cast("string").alias("quote_qty"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("time"),
        (F.col("l_returnflag") == "R").alias("is_buyer_maker"),
        F.lit(True).alias("is_best_match"),
    )


def spread(rows: int, parts: int = 1) -> int:
    """Files for each of ``parts`` equal parts of so many rows: their number grows with the rows,
    their size does not."""
    return max(1, ceil(rows / (parts * ROWS_PER_FILE)))


def _messages(df: DataFrame, parts: int) -> DataFrame:
    """Candles as JSON messages, spread over ``parts`` by hash, so times are shuffled between them."""
    body = F.to_json(F.struct(*[
        F.col(f.name).cast("string").alias(f.name) if f.dataType == AMOUNT else F.col(f.name) for f in df.schema]))
    return df.repartition(parts, F.xxhash64("symbol_id", "open_time")).select(
        body.alias("value"), F.col("close_time").alias("timestamp"))


def candle_messages(spark: SparkSession, sf_dir: str, parts: int = 1) -> tuple[str, int]:
    """One-minute candles as JSON messages in a fresh folder, and how many of its files make one
    of ``parts`` parts."""
    path = new_path(spark, "candle-messages")
    with shuffles_dropped(spark), stored(candles_1m(spark, sf_dir), "candles") as c:
        each = spread(c.count(), parts)
        _messages(c, parts * each).write.option("compression", "zstd").parquet(path)
    return path, each


def versioned_messages(spark: SparkSession, sf_dir: str, late_open: bool = True) -> tuple[str, int]:
    """Every minute in several versions, as equally many files each of a fresh folder in order of
    their age, and that number:
    first an early open version of all minutes and the closed one of every other symbol, then
    a later open version (if ``late_open``), also after the closed one, then the closed one
    of all twice. Open versions have fewer trades and other prices."""
    end = F.unix_millis("close_time")

    def version(df: DataFrame, is_closed: bool, before: int) -> DataFrame:
        if not is_closed:
            df = df.withColumns({
                "close_price": (F.col("open_price") + before).cast(AMOUNT),
                "volume_quote": (F.col("volume_quote") / 2).cast(AMOUNT),
                "num_trades": F.col("num_trades") - F.lit(1),
            })
        return df.withColumns({"is_closed": F.lit(is_closed), "event_time": end - before})

    path = new_path(spark, "versioned-messages")
    with shuffles_dropped(spark), stored(candles_1m(spark, sf_dir), "candles") as c:
        early, final = version(c, False, 40_000), version(c, True, 0)
        files = [early.unionByName(final.filter("symbol_id % 2 = 0"))]
        if late_open:
            files.append(version(c, False, 20_000))
        files.append(final.unionByName(final))
        each = spread(c.count())
        for df in files:
            _messages(df, each).write.mode("append").option("compression", "zstd").parquet(path)
    return path, each


MESSAGE_SCHEMA = "value string, timestamp timestamp"
