"""Streams drained over files derived from the test tables; the SQL is the batch answer."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.operators import candles as C
from tidelake.operators import contract
from tidelake.plans import inputs as I
from tidelake.plans.batch import Warehouse
from tidelake.plans.batch_queries import _stamp
from tidelake.plans.catalog import CODES, TICKS, TRADES, all_candles_sql, candle_columns, candles_sql, query
from tidelake.plans.lake import Lake, run_from_lake
from tidelake.plans.ranking_queries import MART_DIGITS, _SCORED, mart_sql
from tidelake.plans.io_queries import _LANDED_TOTALS, landed_totals, trade_rows
from tidelake.session import drop_shuffles, materialize, new_path, state_on_disk
from tidelake.operators.merge import STREAM_RULES
from tidelake.sinks import tables, upserts, versions
from tidelake.sources import files
from tidelake.sources.topics import read_folder
from tidelake.streaming import candles as SC
from tidelake.streaming import compaction, landing, late, raw, recompute, ring


def stream_session(spark: SparkSession) -> SparkSession:
    """Stateful operators keep the partition count they start with: one per core here."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return state_on_disk(drop_shuffles(session))


def _candles(session, spark, d, parts=1, per_trigger=None) -> DataFrame:
    """Candles in ``parts`` parts, of which a trigger takes ``per_trigger``, or all if None."""
    path, each = I.candle_messages(spark, d, parts)
    return contract.parse_candles(
        read_folder(session, path, I.MESSAGE_SCHEMA, files_per_trigger=per_trigger and per_trigger * each)
    )


def _resampled(spark, d, targets):
    session = stream_session(spark)
    table = tables.fact_klines(new_path(spark, "stream-fact"))
    queries = SC.start_resample(
        _candles(session, spark, d), table, new_path(spark, "checkpoint"), targets, trigger=None
    )
    SC.await_all(queries)
    return table.read(spark)


@query(
    "s9_topic_scan",
    f"WITH {TICKS}, {candles_sql('1m')} {candle_columns('1m')}",
)
def s9(spark, d):
    # bounded triggers: one of four parts at a time
    session = stream_session(spark)
    path = new_path(spark, "read-back")
    query = (
        _candles(session, spark, d, 4, 1).writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", new_path(spark, "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    back = spark.read.schema(schemas.STREAM_CANDLE).parquet(path)
    return back.withColumn("interval_code", F.lit("1m")).select(*schemas.FACT_KLINES.fieldNames())


@query("t2_stream_resample_1h", f"WITH {TICKS}, {candles_sql('1h')} {candle_columns('1h')}")
def t2_1h(spark, d):
    return _resampled(spark, d, ["1h"])


@query("t2_repeated_candles", f"WITH {TICKS}, {candles_sql('1h')} {candle_columns('1h')}")
def t2_repeated(spark, d):
    # all versions of a minute in one trigger: what comes after the watermark is late
    session = stream_session(spark)
    table = tables.fact_klines(new_path(spark, "stream-fact"))
    path, _ = I.versioned_messages(spark, d)
    source = contract.parse_candles(read_folder(session, path, I.MESSAGE_SCHEMA))
    SC.await_all(SC.start_resample(source, table, new_path(spark, "checkpoint"), ["1h"], trigger=None))
    return table.read(spark)


@query("t7_repeated_candles", all_candles_sql(C.INTERVALS))
def t7_repeated(spark, d):
    # the files of one age per trigger: open versions come before and after the closed one
    session = stream_session(spark)
    table = tables.fact_klines(new_path(spark, "recomputed"))
    path, each = I.versioned_messages(spark, d)
    source = contract.parse_candles(read_folder(session, path, I.MESSAGE_SCHEMA, files_per_trigger=each))
    recompute.start_recompute(
        source.withColumn("interval_code", F.lit("1m")), table, new_path(spark, "checkpoint"), trigger=None
    ).awaitTermination()
    return table.read(spark)


@query("t3_stream_two_intervals", all_candles_sql(["4h", "1d"]))
def t3(spark, d):
    return _resampled(spark, d, ["4h", "1d"])


@query("t7_late_safe_resample", all_candles_sql(C.INTERVALS))
def t7(spark, d):
    # three parts with shuffled times, one per trigger: most rows come late
    session = stream_session(spark)
    table = tables.fact_klines(new_path(spark, "recomputed"))
    source = _candles(session, spark, d, 3, 1).withColumn("interval_code", F.lit("1m"))
    query = recompute.start_recompute(
        source.select(*schemas.FACT_KLINES.fieldNames()), table, new_path(spark, "checkpoint"), trigger=None
    )
    query.awaitTermination()
    return table.read(spark)


@query("t7_bucketed", all_candles_sql(C.INTERVALS))
def t7_bucketed(spark, d):
    # three parts with shuffled times; a trigger reads and rewrites touched buckets of days only
    session = stream_session(spark)
    table = tables.fact_klines(new_path(spark, "recomputed"), buckets=2)
    source = _candles(session, spark, d, 3, 1).withColumn("interval_code", F.lit("1m"))
    recompute.start_recompute(
        source.select(*schemas.FACT_KLINES.fieldNames()), table, new_path(spark, "checkpoint"), trigger=None
    ).awaitTermination()
    return table.read(spark)


def _raw_messages(spark, d, parts: int) -> tuple[str, int]:
    """Every minute as messages of producers: every other symbol with the short keys of pushed
    candles, the rest with long ones, each before and after it is closed, beside messages
    of other intervals and some that are cut off; and how many files make one of the parts."""
    minutes = materialize(I.candles_1m(spark, d), "candles")
    c = minutes.withColumn("symbol", I.code_of(F.col("symbol_id")))
    end = F.unix_millis("close_time")

    def message(df: DataFrame, is_closed: bool, before: int, interval: str = "1m") -> DataFrame:
        values = {
            "open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price", "volume": "volume_base",
            "quote_volume": "volume_quote", "taker_buy_base_volume": "volume_base",
            "taker_buy_quote_volume": "taker_buy_quote_volume",
        }
        others = {
            "open_time": F.unix_millis("open_time"), "close_time": end, "interval": F.lit(interval),
            "num_trades": F.col("num_trades"), "is_closed": F.lit(is_closed),
        }
        fields = {**{k: F.col(v).cast("string") for k, v in values.items()}, **others}
        long = F.to_json(F.struct("symbol", (end - before).alias("event_time"), *[v.alias(k) for k, v in fields.items()]))
        short = {**contract.PUSHED_KLINE_TEXT, **contract.PUSHED_KLINE_OTHER}
        k = F.to_json(F.struct(*[fields[name].alias(key) for key, name in short.items()]))
        pushed = F.concat(
            F.lit('{"e":"kline","E":'), end - before, F.lit(',"s":"'), F.col("symbol"), F.lit('","k":'), k, F.lit("}"))
        value = F.when(F.col("symbol_id") % 2 == 0, pushed).otherwise(long)
        return df.select(value.alias("value"), F.timestamp_millis(end - before).alias("timestamp"), "symbol_id", "open_time")

    unfinished = c.withColumns({
        "close_price": F.col("close_price") + 1, "volume_quote": F.col("volume_quote") / 2, "num_trades": F.col("num_trades") - 1})
    final = message(c, True, 0)
    cut = final.withColumn("value", F.left("value", F.length("value") - 3))
    rows = final.unionByName(message(unfinished, False, 30_000)).unionByName(message(c, True, 0, "5m")).unionByName(cut)
    path, each = new_path(spark, "raw-messages"), I.spread(4 * minutes.count(), parts)
    rows.repartition(parts * each, F.xxhash64("open_time", "value")).select("value", "timestamp").write.parquet(path)
    return path, each


@query("t2_raw_topic", f"WITH {TICKS}, {candles_sql('1h')} {candle_columns('1h')}")
def t2_raw(spark, d):
    # raw messages, symbol lookup and windows in one stream
    session = stream_session(spark)
    table = tables.fact_klines(new_path(spark, "stream-fact"))
    dim = materialize(I.dim(spark, d), "dim")
    path, _ = _raw_messages(spark, d, 4)
    source = raw.resolved(read_folder(session, path, I.MESSAGE_SCHEMA), dim)
    SC.await_all(SC.start_resample(source, table, new_path(spark, "checkpoint"), ["1h"], trigger=None))
    return table.read(spark)


@query("t7_raw_topic_new_symbols", all_candles_sql(C.INTERVALS))
def t7_raw(spark, d):
    # three parts with shuffled times, one per trigger; two symbols of three are unknown in the
    # first trigger, one of three in the second
    session = stream_session(spark)
    table, kept = tables.fact_klines(new_path(spark, "from-raw")), new_path(spark, "waiting")
    whole = materialize(I.dim(spark, d), "dim")
    triggers = []

    def known(_):
        triggers.append(len(triggers))
        return whole.filter(F.col("symbol_id") % 3 < len(triggers))

    path, each = _raw_messages(spark, d, 3)
    source = read_folder(session, path, I.MESSAGE_SCHEMA, files_per_trigger=each)
    raw.start_raw(source, known, table, kept, new_path(spark, "checkpoint"), trigger=None).awaitTermination()
    return table.read(spark)


def _messages(session, spark, d) -> DataFrame:
    """events as raw trade messages; those of high value are no JSON objects."""
    rows = trade_rows(spark, d)
    good = F.to_json(F.struct(*[c for c in rows.columns]))
    value = F.when(F.col("price").cast("double") >= 100, F.lit("not json")).otherwise(good)
    path = new_path(spark, "messages")
    rows.select(value.alias("value"), F.timestamp_millis("time").alias("timestamp")).write.parquet(path)
    return read_folder(session, path, I.MESSAGE_SCHEMA)


_VALID_TOTALS = _LANDED_TOTALS.replace("FROM events", "FROM events WHERE value < 100")


def _land(spark, d, mode):
    session = stream_session(spark)
    root = new_path(spark, "lake")
    started = landing.start_landing(
        {"trades": _messages(session, spark, d)}, root, new_path(spark, "checkpoint"), mode, trigger=None
    )
    SC.await_all(started)
    return root


@query("k6_bronze_sink", _VALID_TOTALS)
def k6(spark, d):
    root = _land(spark, d, "BRONZE_ONLY")
    return landed_totals(spark.read.schema(files.with_layout(schemas.RAW_TRADE)).json(f"{root}/bronze/trades"))


def _mixed_messages(session, spark, d) -> DataFrame:
    """events as trade messages: a third with short keys, all with a field no schema knows, and
    those of high value cut off in the middle."""
    rows = trade_rows(spark, d)
    extra = F.struct(F.col("trade_id").alias("id")).alias("extra")
    long = F.to_json(F.struct(*rows.columns, extra))
    short = F.to_json(F.struct(
        F.col("symbol").alias("s"), F.col("event_time").alias("E"), F.col("trade_id").alias("t"),
        F.col("price").alias("p"), F.col("qty").alias("q"), extra))
    good = F.when(F.col("trade_id") % 3 == 0, short).otherwise(long)
    value = F.when(F.col("price").cast("double") >= 100, F.left(good, F.length(good) - 5)).otherwise(good)
    path = new_path(spark, "messages")
    rows.select(value.alias("value"), F.timestamp_millis("time").alias("timestamp")).write.parquet(path)
    return read_folder(session, path, I.MESSAGE_SCHEMA)


def _land_mixed(spark, d) -> str:
    session = stream_session(spark)
    root = new_path(spark, "lake")
    SC.await_all(landing.start_landing(
        {"trades": _mixed_messages(session, spark, d)}, root, new_path(spark, "checkpoint"), "BRONZE_ONLY", trigger=None))
    return root


@query(
    "k6_bronze_keeps_message",
    """SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n, sum(event_id) AS ids,
  count(*) FILTER (event_id % 3 = 0) AS short
FROM events WHERE value < 100 GROUP BY 1, 2""",
)
def k6_messages(spark, d):
    lines = spark.read.schema("value string, date string, symbol string, hour string").text(
        f"{_land_mixed(spark, d)}/bronze/trades")
    return lines.groupBy("symbol", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.get_json_object("value", "$.extra.id").cast("long")).alias("ids"),
        F.count(F.get_json_object("value", "$.s")).alias("short"))


@query(
    "t6_rejects",
    "SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM events WHERE value >= 100 GROUP BY 1",
)
def t6_rejects(spark, d):
    lines = spark.read.schema("value string, date string").text(f"{_land_mixed(spark, d)}/reject/trades")
    return lines.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("k7_silver_sink", _VALID_TOTALS)
def k7(spark, d):
    root = _land(spark, d, "SILVER_ONLY")
    schema = files.with_layout(schemas.RAW_TRADE)
    return landed_totals(files.load_silver(spark, f"{root}/silver/trades", "trades", schema))


@query(
    "t6_landing_both_layers",
    f"""SELECT layer, symbol, sum(n) AS n FROM ({_VALID_TOTALS}), (SELECT 'bronze' AS layer UNION ALL SELECT 'silver')
GROUP BY 1, 2""",
)
def t6(spark, d):
    root = _land(spark, d, "DUAL")
    schema = files.with_layout(schemas.RAW_TRADE)
    bronze = spark.read.schema(schema).json(f"{root}/bronze/trades").withColumn("layer", F.lit("bronze"))
    silver = spark.read.schema(schema).parquet(f"{root}/silver/trades").withColumn("layer", F.lit("silver"))
    return bronze.unionByName(silver).groupBy("layer", "symbol").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k10_micro_batch_upsert",
    f"WITH {TICKS}, {candles_sql('1m')} {candle_columns('1m')}",
)
def k10(spark, d):
    session = stream_session(spark)
    table = tables.fact_klines(new_path(spark, "upserted"))
    rows = _candles(session, spark, d, 2, 1).withColumn("interval_code", F.lit("1m"))
    write = SC.upsert_batches(table)
    query = (
        rows.writeStream.outputMode("append").option("checkpointLocation", new_path(spark, "checkpoint"))
        .foreachBatch(lambda batch, n: (write(batch, n), write(batch, n))[0])   # delivered twice
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return table.read(spark)


@query(
    "k10_delta_upsert",
    f"WITH {TICKS}, {candles_sql('1m')} {candle_columns('1m')}",
)
def k10_delta(spark, d):
    # all versions of a minute, older ones also after newer ones; every batch delivered twice
    session = stream_session(spark)
    table = upserts.kline_log(new_path(spark, "upsert-log"))
    path, each = I.versioned_messages(spark, d)
    source = contract.parse_candles(read_folder(session, path, I.MESSAGE_SCHEMA, files_per_trigger=each))
    write = upserts.log_batches(table, "candles", compact_every=2)
    query = (
        source.withColumn("interval_code", F.lit("1m")).writeStream.outputMode("append")
        .option("checkpointLocation", new_path(spark, "checkpoint"))
        .foreachBatch(lambda batch, n: (write(batch, n), write(batch, n))[0])
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return table.read(spark)


@query("t3_delta_two_intervals", all_candles_sql(["4h", "1d"]))
def t3_delta(spark, d):
    session = stream_session(spark)
    table = upserts.kline_log(new_path(spark, "upsert-log"), STREAM_RULES)
    SC.await_all(SC.start_resample(
        _candles(session, spark, d), table, new_path(spark, "checkpoint"), ["4h", "1d"], trigger=None, compact_every=1))
    return table.read(spark)


_NOW = dt.datetime(2024, 1, 25)


@query(
    "t8_recent_trades",
    "SELECT user_id AS symbol_id, event_id AS trade_id, ts AS trade_time, round(value, 2) AS price FROM events "
    "WHERE ts >= TIMESTAMP '2024-01-18'",
)
def t8(spark, d):
    # every trade is delivered twice, in different files and triggers
    session = stream_session(spark)
    path = new_path(spark, "trades")
    rows = I.table(spark, d, "events").select(
        F.col("user_id").alias("symbol_id"), F.col("event_id").alias("trade_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("time"),
        F.col("value").cast("string").alias("price"), F.lit("1").alias("qty"),
        F.lit(None).cast("string").alias("quote_qty"),
        (F.col("event_type") == "view").alias("is_buyer_maker"), F.lit(True).alias("is_best_match"),
    )
    for _ in range(2):
        rows.write.mode("append").parquet(path)
    table = tables.recent_trades(new_path(spark, "ring"))
    source = read_folder(session, path, rows.schema, files_per_trigger=1)
    query = ring.start_ring(
        contract.recent_trades(source, F.lit("2024-02-01").cast("timestamp")), table,
        new_path(spark, "checkpoint"), trigger=None,
    )
    query.awaitTermination()
    kept = ring.within_retention(table.read(spark, keep_partitions=True), _NOW)
    return kept.select("symbol_id", "trade_id", "trade_time", "price")


@query(
    "t8_pruned",
    "SELECT user_id AS symbol_id, event_id AS trade_id, ts AS trade_time, round(value, 2) AS price FROM events "
    "WHERE ts >= TIMESTAMP '2024-01-18'",
)
def t8_pruned(spark, d):
    # days beyond retention are removed after each batch, and what comes late for them is not taken
    session = stream_session(spark)
    path = new_path(spark, "trades")
    rows = I.table(spark, d, "events").select(
        F.col("user_id").alias("symbol_id"), F.col("event_id").alias("trade_id"), F.col("ts").cast("timestamp").alias("trade_time"),
        F.col("value").cast(schemas.AMOUNT).alias("price"), F.lit(1).cast(schemas.AMOUNT).alias("qty_base"),
        F.col("value").cast(schemas.AMOUNT).alias("quote_qty"), (F.col("event_type") == "view").alias("is_buyer_maker"),
        F.lit(True).alias("is_best_match"), F.lit("2024-02-01").cast("timestamp").alias("ingested_at"))
    for _ in range(2):      # every trade comes twice, in different triggers
        rows.write.mode("append").parquet(path)
    table, dates = tables.recent_trades(new_path(spark, "ring")), [_NOW.date() - dt.timedelta(days=5)]
    source = read_folder(session, path, rows.schema, files_per_trigger=1)

    def today():
        # time goes on from batch to batch: the first ones take days in that later ones remove
        dates.append(min(_NOW.date(), dates[-1] + dt.timedelta(days=1)))
        return dates[-1]

    ring.start_ring(source, table, new_path(spark, "checkpoint"), trigger=None, today=today).awaitTermination()
    ring.expire(table, spark, _NOW.date())
    return table.read(spark).select("symbol_id", "trade_id", "trade_time", "price")


@query(
    "k8_one_read",
    """SELECT layer, symbol, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, count(*) AS n, sum(event_id) AS ids
FROM (SELECT ts, event_id, CASE WHEN value >= 100 THEN '' ELSE event_type END AS symbol, value >= 100 AS bad FROM events)
JOIN (VALUES ('bronze', false), ('silver', false), ('reject', true)) AS l(layer, rejects) ON rejects = bad
GROUP BY 1, 2, 3""",
)
def k8_one_read(spark, d):
    # full hours; those of high value are cut off in the middle, behind their number
    session, root, path = stream_session(spark), new_path(spark, "lake"), new_path(spark, "messages")
    events = I.table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    body = F.to_json(F.struct(
        F.col("event_id").alias("trade_id"), F.col("event_type").alias("symbol"), F.unix_millis("at").alias("event_time"),
        F.col("value").cast("string").alias("price"), F.lit("1").alias("qty")))
    value = F.when(F.col("value") >= 100, F.left(body, F.length(body) - 5)).otherwise(body)
    # three batches, each of whole event types and of equally many files
    each = I.spread(events.count(), 3)
    for part in range(3):
        of_types = events.filter(F.pmod(F.hash("event_type"), F.lit(3)) == part)
        of_types.select(value.alias("value"), F.col("at").alias("timestamp")).repartition(each).write.mode("append").parquet(path)
    source = read_folder(session, path, I.MESSAGE_SCHEMA, files_per_trigger=each)
    SC.await_all(landing.start_landing_once({"trades": source}, root, new_path(spark, "checkpoint"), trigger=None))
    number = F.regexp_extract("value", '"trade_id":([0-9]+)', 1).cast("long")
    when = F.timestamp_millis(F.regexp_extract("value", '"event_time":([0-9]+)', 1).cast("long"))
    folder = F.to_timestamp(F.concat_ws(" ", "date", "hour"), "yyyy-MM-dd HH")
    found = {name: landing.landed(spark, root, name, "trades") for name in ("bronze", "silver", "reject")}
    parts = [
        found["bronze"].select(F.lit("bronze").alias("layer"), "symbol", folder.alias("hour"), number.alias("id")),
        found["silver"].select(F.lit("silver").alias("layer"), "symbol", folder.alias("hour"), F.col("trade_id").alias("id")),
        found["reject"].select(F.lit("reject").alias("layer"), F.lit("").alias("symbol"), F.date_trunc("hour", when).alias("hour"), number.alias("id")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("layer", "symbol", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query(
    "d5_publish_gate",
    f"""WITH {TICKS}, {candles_sql('1m')}
SELECT true AS first_published, false AS second_published, count(*) AS n, CAST(sum(volume_quote) AS DOUBLE) AS volume,
  count(*) FILTER (symbol_id % 7 = 0) AS no_price, count(*) FILTER (symbol_id % 5 = 0) AS repeated,
  count(*) FILTER (symbol_id % 3 = 0) AS orphans FROM candles""",
)
def d5_gate(spark, d):
    # the second batch has candles without a price, repeated ones, and some of unknown symbols
    rows = materialize(I.candles_1m(spark, d), "rows")
    known = I.dim(spark, d)
    keys = schemas.KEYS["fact_klines"]
    fact = tables.fact_klines(new_path(spark, "gated"))
    table = versions.VersionedTable(fact.path, fact.schema, fact.partitions)
    gate = {
        "checks": {"no_price": versions.missing(*schemas.NOT_NULL["fact_klines"])},
        "audits": {"repeated": versions.repeated_keys(*keys), "orphans": versions.unknown(known, "symbol_id")},
    }
    first = table.write(rows, **gate)
    lost = rows.filter("symbol_id % 3 = 0").withColumn("symbol_id", -F.col("symbol_id") - 1)
    no_price = F.when((F.col("symbol_id") % 7 != 0) | F.col("symbol_id").isNull(), F.col("open_price"))
    bad = rows.withColumn("open_price", no_price).unionByName(rows.filter("symbol_id % 5 = 0")).unionByName(lost)
    second = table.write(bad, **gate)
    return table.read(spark).agg(
        F.lit(first.published).alias("first_published"), F.lit(second.published).alias("second_published"),
        F.count(F.lit(1)).alias("n"), F.sum("volume_quote").alias("volume"),
        *[F.lit(second.found[n]).cast("long").alias(n) for n in ("no_price", "repeated", "orphans")])


@query(
    "k9_rolled_files",
    """SELECT symbol, sum(n) AS n, CAST(sum(ids) AS BIGINT) AS ids, CAST(sum(ceil(n / 3.0)) AS BIGINT) AS files, true AS within_limit FROM (
  SELECT event_type AS symbol, CAST(ts AS DATE), hour(ts) < 12, count(*) AS n, sum(event_id) AS ids
  FROM events WHERE value < 100 GROUP BY 1, 2, 3)
GROUP BY 1""",
)
def k9(spark, d):
    # a file closes after three records of one key, however many tasks read
    session = stream_session(spark)
    root = new_path(spark, "lake")
    SC.await_all(landing.start_landing(
        {"trades": _messages(session, spark, d)}, root, new_path(spark, "checkpoint"), "SILVER_ONLY",
        trigger=None, records_per_file=3, gather=True))
    rows = spark.read.schema(files.with_layout(schemas.RAW_TRADE)).parquet(f"{root}/silver/trades")
    by_file = rows.groupBy("symbol", F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("trade_id").alias("ids"))
    return by_file.groupBy("symbol").agg(
        F.sum("n").alias("n"), F.sum("ids").alias("ids"), F.count(F.lit(1)).alias("files"),
        (F.max("n") <= 3).alias("within_limit"))


@query(
    "k9_compacted",
    """SELECT event_type AS symbol, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, count(*) AS n, sum(event_id) AS ids
FROM events WHERE value < 100 GROUP BY 1, 2""",
)
def k9_compacted(spark, d):
    # four batches by time, full hours; those that end before the middle of the month are packed
    root = new_path(spark, "lake")
    events = I.table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp")).filter("value < 100")
    body = F.to_json(F.struct(
        F.col("event_id").alias("trade_id"), F.col("event_type").alias("symbol"), F.unix_millis("at").alias("event_time"),
        F.col("value").cast("string").alias("price"), F.lit("1").alias("qty")))
    messages = events.select(body.alias("value"), F.col("at").alias("timestamp"), "event_type")
    days = ["2000-01-01", "2024-01-08", "2024-01-16", "2024-01-24", "2100-01-01"]
    for n, (low, high) in enumerate(zip(days, days[1:])):
        mine = (F.col("timestamp") >= F.lit(low).cast("timestamp")) & (F.col("timestamp") < F.lit(high).cast("timestamp"))
        # as a topic keyed by symbol has them
        landing.land_batch(messages.filter(mine).repartition(8, "event_type").drop("event_type"), n, "trades", root, "SILVER_ONLY")
    assert compaction.pack(spark, root, "silver", "trades", dt.datetime(2024, 1, 16)) > 0
    hour = F.to_timestamp(F.concat_ws(" ", "date", "hour"), "yyyy-MM-dd HH")
    return compaction.read(spark, root, "silver", "trades").groupBy("symbol", hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("trade_id").alias("ids"))


@query(
    "t5_late_rows",
    f"""WITH {TICKS}, {candles_sql('1m')}, {candles_sql('1h', 'hours')}
SELECT (SELECT count(*) FROM candles WHERE open_time <= (SELECT max(open_time) FROM candles) - INTERVAL '2 minutes') AS late,
  count(*) AS windows, CAST(sum(volume_quote) AS DOUBLE) AS volume FROM hours""",
)
def t5(spark, d):
    # Every candle comes in three triggers. A trigger drops what is behind the watermark that
    # its predecessor started with: the second one knows all rows as copies, the third one
    # drops and counts them. The windows stay as they were.
    session = stream_session(spark)
    path = new_path(spark, "late-messages")
    copies = materialize(I.candles_1m(spark, d), "copies")
    parts = copies.repartition(I.spread(copies.count()), F.xxhash64("symbol_id", "open_time"))
    for _ in range(3):
        parts.write.mode("append").parquet(path)
    each = len(spark.read.parquet(path).inputFiles()) // 3
    table = tables.fact_klines(new_path(spark, "stream-fact"))
    source = read_folder(session, path, copies.schema, files_per_trigger=each)
    queries = SC.start_resample(source, table, new_path(spark, "checkpoint"), ["1h"], trigger=None)
    SC.await_all(queries)
    late = SC.dropped_late_rows(queries[0])
    return table.read(spark).agg(
        F.lit(late).cast("long").alias("late"), F.count(F.lit(1)).alias("windows"), F.sum("volume_quote").alias("volume"))


@query("t5_failed_query", all_candles_sql(["1h", "4h"]))
def t5_failed(spark, d):
    # the sink of one of two queries fails: the wait ends with its error and
    # both stop; started again from their checkpoints, they leave what they would have left
    session = stream_session(spark)
    rows = _candles(session, spark, d, 3)
    table, marks = tables.fact_klines(new_path(spark, "stream-fact")), new_path(spark, "checkpoint")
    write, down = SC.upsert_batches(table), [True]

    def failing(batch, n):
        if down:
            raise RuntimeError("sink is down")
        write(batch, n)

    def start(code, sink):
        return SC.start_windows(rows, code, sink, marks, trigger=None)

    queries = [start("1h", write), start("4h", failing)]
    try:
        SC.await_all(queries)
        raise AssertionError("the error was lost")
    except StreamingQueryException as error:
        assert "sink is down" in str(error)
    assert not any(query.isActive for query in queries)
    down.clear()
    SC.await_all([start("1h", write), start("4h", failing)])
    return table.read(spark)


@query("t4_late_table", f"WITH {TICKS}, {candles_sql('1h')} {candle_columns('1h')}")
def t4_late(spark, d):
    # four parts with shuffled times, one per trigger: what is behind the watermark goes to the
    # late side, and the windows of both sides together are those of a batch
    session, root = stream_session(spark), new_path(spark, "split")
    rows = _candles(session, spark, d, 4, 1)
    late.start_split(rows, root, new_path(spark, "checkpoint"), trigger=None).awaitTermination()
    table = tables.fact_klines(new_path(spark, "windows"))
    on_time = late.on_time_stream(session, root, rows.schema)
    queries = SC.start_resample(on_time, table, new_path(spark, "checkpoint"), ["1h"], trigger=None)
    SC.await_all(queries)
    assert SC.dropped_late_rows(queries[0]) == 0
    assert late.apply_late(spark, root, table, rows.schema, ["1h"]) > 0
    return table.read(spark)


# ----------------------------------------------------------------------- D10 from the lake

_LAKE_HALF = "2024-01-16"
_BY_TYPE = "dense_rank() OVER (ORDER BY event_type) AS symbol_id"
_LAKE_SQL = (
    mart_sql(_SCORED).replace("symbol_id, symbol_code,", "symbol_code,", 1)
    .replace(TICKS, TICKS.replace("user_id AS symbol_id", _BY_TYPE))
    .replace(CODES, f"codes AS (SELECT DISTINCT {_BY_TYPE}, upper(event_type) || 'USDT' AS symbol_code FROM events)")
    .replace(TRADES, f"trades AS (SELECT {_BY_TYPE}, CAST(value AS DECIMAL(18,2)) AS q, event_id % 2 = 0 AS maker FROM events)")
)


def land_in_two_parts(spark, d) -> tuple[Lake, callable]:
    """A lake of all three datasets with the event type as symbol, and a function that lands
    one of two parts. The first has what comes before the middle of the month; the second has
    the rest, and older and unfinished versions of the candles of the first one."""
    session = stream_session(spark)
    root, inbox, marks = new_path(spark, "lake"), new_path(spark, "inbox"), new_path(spark, "checkpoint")
    code = F.concat(F.upper("event_type"), F.lit("USDT"))
    events = I.table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    ticks = I.ticks(spark, d).join(events.select("event_id", code.alias("code")), "event_id").withColumn("symbol_id", F.col("code"))
    minutes = materialize(C.from_ticks(ticks, tie_break="event_id").withColumnRenamed("symbol_id", "symbol"), "by-type")

    def message(df, at, **fields):
        body = F.to_json(F.struct(*[F.expr(e).alias(n) for n, e in fields.items()]))
        return df.select(body.alias("value"), F.col(at).alias("timestamp"))

    def klines(df, closed: bool):
        return message(
            df, "close_time", symbol="symbol", event_time="unix_millis(close_time)", open_time="unix_millis(open_time)",
            close_time="unix_millis(close_time)", interval="'1m'", open="string(open_price)", high="string(high_price)",
            low="string(low_price)", close="string(close_price)", volume="string(volume_base)",
            quote_volume="string(volume_quote)", num_trades="num_trades", taker_buy_base_volume="string(volume_base)",
            taker_buy_quote_volume="string(taker_buy_quote_volume)", is_closed=str(closed))

    unfinished = minutes.withColumns({
        "num_trades": F.col("num_trades") - 1, "close_price": F.col("close_price") + 1, "volume_quote": F.col("volume_quote") / 2})
    tickers = minutes.groupBy("symbol", F.date_trunc("day", "open_time").alias("at")).agg(
        F.max("high_price").alias("high"), F.sum("num_trades").alias("n"))
    ticker = message(tickers, "at", symbol="symbol", event_time="unix_millis(at)", high_price="string(high)", num_trades="n")
    trades = message(
        # delivered once a day, so in one folder a day, with the times at which they were made
        events.withColumn("symbol", code), "at", symbol="symbol", event_time="unix_millis(date_trunc('day', at))", time="unix_millis(at)",
        trade_id="event_id", price="string(value)", qty="'1'", quote_qty="string(value)", is_buyer_maker="event_id % 2 = 0")

    def land(part: int) -> None:
        early = F.col("timestamp") < F.lit(_LAKE_HALF).cast("timestamp")
        here = early if part == 0 else ~early
        rows = {"klines": klines(minutes, True).filter(here), "ticker": ticker.filter(here), "trades": trades.filter(here)}
        if part:
            rows["klines"] = rows["klines"].unionByName(klines(unfinished, False))
        for name, df in rows.items():
            # as a topic keyed by symbol has them
            df.repartition(5, F.get_json_object("value", "$.symbol")).write.mode("append").parquet(f"{inbox}/{name}")
        SC.await_all(landing.start_landing(
            {n: read_folder(session, f"{inbox}/{n}", I.MESSAGE_SCHEMA) for n in rows},
            root, marks, "SILVER_ONLY", trigger=None))

    return Lake(root), land


@query("d10_from_silver", _LAKE_SQL, **MART_DIGITS)
def d10_from_silver(spark, d):
    lake, land = land_in_two_parts(spark, d)
    warehouse = Warehouse(new_path(spark, "warehouse"))
    for part in (0, 1):
        land(part)
        run_from_lake(spark, lake, warehouse, now=_stamp() - F.expr(f"INTERVAL {1 - part} DAY"))
    assert run_from_lake(spark, lake, warehouse) is None
    return warehouse.top(spark).filter(F.col("computed_at") == _stamp()).drop("symbol_id")
