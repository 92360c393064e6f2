"""Recent trades: append once, keep for a retention period."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.operators.merge import latest_wins
from tidelake.sinks.tables import KeyedTable

# fixed value: days a trade is kept
RETENTION_DAYS = 7


def within_retention(trades: DataFrame, now, days: int = RETENTION_DAYS) -> DataFrame:
    """Trades of the last ``days`` days before ``now``; prunes dated partitions too."""
    cutoff = now - timedelta(days=days)
    kept = trades.filter(F.col("trade_time") >= F.lit(cutoff))
    if "trade_date" in trades.columns:
        kept = kept.filter(F.col("trade_date") >= F.lit(cutoff.date()))
    return kept


def start_ring(
    trades: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    trigger: str | None = "30 seconds",
    today=None,
) -> StreamingQuery:
    """Append each trade once. Copies are recognised by the table's keys, however far
    apart they arrive, so the stream needs no state and drops no late trade: a watermark
    before the key check would. The first version of a trade stays, and a batch that is
    delivered again adds nothing. With ``today``, a function that gives the date, days
    beyond retention are removed after each batch, and their late trades not taken in."""

    def write(batch: DataFrame, batch_id: int) -> None:
        order = [F.col("ingested_at").asc_nulls_last()]
        if today is not None:
            batch = batch.filter(F.to_date("trade_time") >= F.lit(today() - timedelta(days=RETENTION_DAYS)))
        table.insert_new(latest_wins(batch, table.keys, order))
        if today is not None:
            expire(table, batch.sparkSession, today())

    writer = (
        trades.writeStream.queryName("recent_trades")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def expire(table: KeyedTable, spark: SparkSession, today: date, days: int = RETENTION_DAYS) -> list[str]:
    """Remove the days that retention has passed, by folder; the days removed."""
    cutoff = (today - timedelta(days=days)).isoformat()
    return table.remove_partitions(spark, lambda day: day < cutoff)


def expired_partitions(table: KeyedTable, spark, today: date, days: int = RETENTION_DAYS) -> DataFrame:
    """Dated partitions that retention has passed and :func:`expire` would remove."""
    cutoff = today - timedelta(days=days)
    stored = table.read(spark, keep_partitions=True)
    return stored.filter(F.col("trade_date") < F.lit(cutoff)).select("trade_date").distinct()
