"""Streaming resample: one stateful query per target interval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.operators.candles import INTERVALS, TARGETS, ohlcv
from tidelake.operators.merge import STREAM_RULES, latest_wins
from tidelake.schemas import FACT_KLINES
from tidelake.sinks.tables import KeyedTable
from tidelake.sinks.upserts import COMPACT_EVERY, UpsertLog, log_batches

# fixed values: accepted lateness and trigger period
LATENESS = "2 minutes"
TRIGGER = "30 seconds"
# Seconds in which a failure is noticed at the latest.
POLL = 1.0


def closed(candles_1m: DataFrame) -> DataFrame:
    """Final candles. Those without the mark, or without the column, count as final."""
    if "is_closed" not in candles_1m.columns:
        return candles_1m
    return candles_1m.filter(F.coalesce("is_closed", F.lit(True)))


def windowed(candles_1m: DataFrame, interval: str, lateness: str = LATENESS) -> DataFrame:
    """Candles of ``interval``, kept open until the watermark passes their window.

    A minute counts once: open candles are left out, and a closed one that is sent again is
    recognised for as long as the watermark would admit it.
    """
    bars = (
        closed(candles_1m).withWatermark("open_time", lateness)
        .dropDuplicatesWithinWatermark(["symbol_id", "open_time"])
        .groupBy("symbol_id", F.window("open_time", f"{INTERVALS[interval]} seconds").alias("w"))
        .agg(*ohlcv())
        .withColumn("open_time", F.col("w.start"))
        .withColumn("interval_code", F.lit(interval))
    )
    return bars.select(*FACT_KLINES.fieldNames())


def upsert_batches(table: KeyedTable, rules: dict[str, str] | None = None):
    """foreachBatch callback. Every update carries the full state of its window, so a
    batch that is delivered again leaves the table as it was. Where a batch holds several
    versions of a candle, the best one is merged."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(latest_wins(batch, table.keys), STREAM_RULES if rules is None else rules)

    return write


def _started(writer, trigger: str | None) -> StreamingQuery:
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def start_windows(
    candles_1m: DataFrame,
    code: str,
    write,
    checkpoints: str,
    trigger: str | None = TRIGGER,
    lateness: str = LATENESS,
) -> StreamingQuery:
    """The query of one interval, into the foreachBatch callback ``write``."""
    writer = (
        windowed(candles_1m, code, lateness)
        .writeStream.queryName(f"resample_{code}")
        .outputMode("update")
        .option("checkpointLocation", f"{checkpoints}/{code}")
        .foreachBatch(write)
    )
    return _started(writer, trigger)


def start_resample(
    candles_1m: DataFrame,
    table: KeyedTable | UpsertLog,
    checkpoints: str,
    targets=TARGETS,
    trigger: str | None = TRIGGER,
    lateness: str = LATENESS,
    rules: dict[str, str] | None = None,
    compact_every: int = COMPACT_EVERY,
) -> list[StreamingQuery]:
    """Start one query per interval; ``trigger=None`` drains what is there and stops.

    Into a :class:`UpsertLog` a trigger writes its own rows only, and the log's rules resolve
    them; into a :class:`KeyedTable` it rewrites the partitions it touches. The queries touch
    different ``interval_code`` partitions, so their merges into one table do not meet.
    """
    queries = []
    for code in targets:
        if isinstance(table, UpsertLog):
            write = log_batches(table, f"resample_{code}", compact_every)
        else:
            write = upsert_batches(table, rules)
        queries.append(start_windows(candles_1m, code, write, checkpoints, trigger, lateness))
    return queries


def await_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Return, or raise, as soon as one query ends, whichever it is."""
    spark.streams.awaitAnyTermination(timeout)


def await_all(queries: list[StreamingQuery]) -> None:
    """For draining queries: wait for each. The first one that fails stops the others, which
    can go on from their checkpoints, and its error is raised at once, whichever it is."""
    try:
        running = list(queries)
        while running:
            # a finished query tells its error when it is waited for
            running = [query for query in running if not query.awaitTermination(POLL / len(running))]
    finally:
        for query in queries:
            query.stop()


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows the watermark has excluded, over the reported progress of ``query``."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )
