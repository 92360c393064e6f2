"""Late candles kept beside the windows they missed.

    root/on_time/batch=<id>/…   what the windowed stream reads
    root/late/batch=<id>/…      what was behind the watermark when it came
    root/_marks/<id>=<micros>   finished batches, with the newest time up to each

A stream that drops late rows inside its state cannot hand them out. So they are split off
before it, by the same rule, and the stream behind the split drops nothing: its watermark
never runs ahead of the one that its rows have passed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidelake.operators.candles import TARGETS
from tidelake.operators.merge import latest_wins
from tidelake.schemas import FACT_KLINES, KEYS
from tidelake.session import partitions_for, stored
from tidelake.sinks.tables import KeyedTable, _files, kline_partitions, kline_places
from tidelake.streaming.candles import LATENESS, _started, closed
from tidelake.streaming.recompute import rebuild_touched

SIDES = ("late", "on_time")     # in the order in which they are published


def _marks(spark: SparkSession, root: str) -> dict[int, int]:
    """Newest time, in microseconds, up to each finished batch."""
    files, at = _files(spark, root)
    if not files.util().exists(at(f"{root}/_marks")):
        return {}
    listing, out = files.listStatus(at(f"{root}/_marks")), {}
    while listing.hasNext():
        number, _, newest = listing.next().getPath().getName().partition("=")
        if number.isdigit():
            out[int(number)] = int(newest)
    return out


def split_batch(batch: DataFrame, batch_id: int, root: str, lateness: str = LATENESS) -> None:
    """Write one batch of final 1-minute candles to its two sides.

    A row is late if its time is not after the newest time of all earlier batches less
    ``lateness``. A batch that is delivered again is split as before: what is published of it
    stays, since the rule looks at earlier batches only.
    """
    spark = batch.sparkSession
    marks = _marks(spark, root)
    if batch_id in marks:
        return
    earlier = [newest for n, newest in marks.items() if n < batch_id]
    files, at = _files(spark, root)
    with stored(closed(batch), "split") as rows:
        newest = rows.agg(F.max(F.unix_micros("open_time"))).first()[0]
        late = F.lit(False)
        if earlier:
            watermark = F.timestamp_micros(F.lit(max(earlier))) - F.expr(f"INTERVAL {lateness}")
            late = F.col("open_time") <= watermark
        for side, part in zip(SIDES, (rows.filter(late), rows.filter(~late))):
            folder, draft = f"{root}/{side}/batch={batch_id}", f"{root}/_drafts/{side}-{batch_id}"
            if files.util().exists(at(folder)):
                continue
            part.write.mode("overwrite").parquet(draft)
            files.mkdir(at(f"{root}/{side}"), None, True)
            path = spark._jvm.org.apache.hadoop.fs.Path(draft)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).rename(path, at(folder))
    top = max([*earlier, *([] if newest is None else [newest])], default=None)
    if top is not None:
        flag = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_marks/{batch_id}={top}")
        flag.getFileSystem(spark._jsc.hadoopConfiguration()).create(flag, True).close()


def start_split(
    candles_1m: DataFrame, root: str, checkpoint: str, lateness: str = LATENESS, trigger: str | None = "30 seconds"
) -> StreamingQuery:
    writer = (
        candles_1m.writeStream.queryName("split_late").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, n: split_batch(batch, n, root, lateness))
    )
    return _started(writer, trigger)


def side(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    """All rows of one side, whole batches only."""
    folders = [f"{root}/{name}/batch={n}" for n in sorted(_marks(spark, root))]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def on_time_stream(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The on-time side as a stream, for :func:`tidelake.streaming.candles.start_resample`."""
    return spark.readStream.schema(schema).parquet(f"{root}/on_time/batch=*")


def apply_late(spark: SparkSession, root: str, table: KeyedTable, schema: StructType, targets=TARGETS) -> int:
    """Replace the windows that late candles belong to, from both sides; how many are late.

    A window lies in one day of one symbol: only such days are read again, as in
    :mod:`tidelake.streaming.recompute`, and only the folders they fall in are rewritten.
    With it the table is what a batch over all rows gives. It can be repeated.
    """
    late = side(spark, root, "late", schema)
    number = late.count()
    if not number:
        return 0
    both = late.unionByName(side(spark, root, "on_time", schema)).withColumn("interval_code", F.lit("1m"))
    places = kline_places(table, late)
    days = sorted({place[0] for place in places})
    of_days = both.filter(F.to_date("open_time").isin(days))
    best = latest_wins(of_days, KEYS["fact_klines"]).select(*FACT_KLINES.fieldNames())
    minutes = best.withColumn("open_date", F.to_date("open_time"))
    fresh = late.select("symbol_id", "open_time")
    rows = of_days.count()
    with partitions_for(spark, len(targets) * rows):
        table.upsert(
            rebuild_touched(minutes, fresh, targets, rows), rules={}, touched=kline_partitions(targets, places))
    return number
