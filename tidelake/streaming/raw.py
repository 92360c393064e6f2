"""Raw candle messages to stored candles in one stream, symbols resolved on the way.

    waiting/batch=<id>/…   records of symbols that were unknown when they came
    waiting/_whole/<id>    that batch's folder also has what is left of all earlier ones

Producers send the symbol's code, tables hold its id. The dimension grows while a stream runs,
so :func:`start_raw` looks codes up anew in every trigger and keeps what it cannot resolve.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidelake.operators import contract, dims
from tidelake.operators.candles import TARGETS
from tidelake.operators.filters import sane
from tidelake.operators.skew import broadcast_checked
from tidelake.session import stored
from tidelake.sinks.tables import KeyedTable, _files
from tidelake.sources.files import _or_none
from tidelake.streaming.candles import _started
from tidelake.streaming.recompute import apply_batch

MINUTE = "1m"


def records(messages: DataFrame, payload: str = "value") -> DataFrame:
    """1-minute candle records with their symbol's code, from messages with long or short keys.

    What is no JSON object, has no symbol, or is of another interval is left out; a missing
    interval counts as a minute. Works on streams: every message is looked at by itself.
    """
    lines = messages.select(F.col(payload).cast("string").alias("_line"))
    fields = contract.message_fields(lines, "klines", "_line").filter("_readable").drop("_readable", "_line")
    of_minutes = F.coalesce("interval", F.lit(MINUTE)) == MINUTE
    return contract.normalise(fields.filter(of_minutes & (F.col("symbol") != "")), "klines")


def facts(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Records of known symbols as candles, with what tells their versions apart."""
    return sane(contract.kline_facts(dims.with_symbol_id(rows, dim), versions=True))


def resolved(messages: DataFrame, dim: DataFrame, payload: str = "value") -> DataFrame:
    """A stream of candles for :func:`tidelake.streaming.candles.start_resample`, with the
    dimension as it is when the stream starts: symbols that come later need a restart."""
    return facts(records(messages, payload), dim)


def _whole(spark: SparkSession, path: str) -> list[int]:
    """The batches whose folder replaces all earlier ones."""
    files, at = _files(spark, path)
    marks, found = at(f"{path}/_whole"), []
    if files.util().exists(marks):
        listing = files.listStatus(marks)
        while listing.hasNext():
            name = listing.next().getPath().getName()
            if name.isdigit():
                found.append(int(name))
    return sorted(found)


def waiting(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame | None:
    """The records kept for unknown symbols, or None if there never were any; with ``before``
    as they were ahead of that batch."""
    rows = _or_none(lambda: spark.read.schema(StructType(list(schema.fields)).add("batch", "long")).parquet(path))
    if rows is None:
        return None
    first = max((n for n in _whole(spark, path) if before is None or n < before), default=0)
    rows = rows.filter(F.col("batch") >= first)
    return rows if before is None else rows.filter(F.col("batch") < before)


def _release(spark: SparkSession, path: str, batch_id: int) -> None:
    """Let the folder of this batch replace all earlier ones. Those that it was made from stay
    until the next time, for a batch that is delivered again; older ones are removed."""
    files, at = _files(spark, path)
    first = max((n for n in _whole(spark, path) if n < batch_id), default=0)
    flag = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_whole/{batch_id}")
    flag.getFileSystem(spark._jsc.hadoopConfiguration()).create(flag, True).close()
    for folder in (path, f"{path}/_whole"):
        listing = files.listStatus(at(folder))
        while listing.hasNext():
            found = listing.next().getPath()
            number = found.getName().removeprefix("batch=")
            if number.isdigit() and int(number) < first:
                files.delete(found, True)


def apply_raw(
    rows: DataFrame, batch_id: int, dim: DataFrame, table: KeyedTable, kept: str, targets=TARGETS
) -> None:
    """Store one batch of :func:`records`, and what was kept of symbols known by now.

    Records of unknown symbols go to the batch's folder, so a batch that is delivered again
    writes the same folder; their number of symbols makes no difference. Once some of what
    waits is known, the folder takes the rest of all earlier ones too and replaces them after
    the candles are stored; a run that dies in between stores them again, which changes nothing.
    """
    spark = rows.sparkSession
    with stored(rows, "raw") as batch, stored(dim.select("symbol_id", "symbol_code"), "dim") as known:
        codes = broadcast_checked(known.select(F.col("symbol_code").alias("symbol")))
        strange = batch.join(codes, "symbol", "left_anti")
        before = waiting(spark, kept, batch.schema, batch_id)
        released = before is not None and not before.join(codes, "symbol", "left_semi").isEmpty()
        if released:
            before = before.drop("batch")
            strange = strange.unionByName(before.join(codes, "symbol", "left_anti"))
            batch = batch.unionByName(before.join(codes, "symbol", "left_semi"))
        (
            strange.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "static")
            .parquet(f"{kept}/batch={batch_id}")
        )
        apply_batch(facts(batch, known), table, targets)
        if released:
            _release(spark, kept, batch_id)


def start_raw(
    messages: DataFrame,
    dim: Callable[[SparkSession], DataFrame],
    table: KeyedTable,
    kept: str,
    checkpoint: str,
    targets=TARGETS,
    trigger: str | None = "30 seconds",
    payload: str = "value",
) -> StreamingQuery:
    """One query from raw messages to candles of all intervals: minutes are resolved and
    stored, and every longer candle they belong to is rebuilt, so none is ever too late.

    ``dim`` is called in each trigger. Records of symbols it does not have wait under ``kept``
    and are taken by the first trigger after their symbol is known.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        apply_raw(batch, batch_id, dim(batch.sparkSession), table, kept, targets)

    writer = (
        records(messages, payload).writeStream.queryName("raw_klines").outputMode("append")
        .option("checkpointLocation", checkpoint).foreachBatch(write)
    )
    return _started(writer, trigger)
