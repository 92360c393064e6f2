"""Streamed upserts as appended batches, resolved when they are read.

    path/deltas/query=<name>/batch=<id>/part-*   the rows of one batch, as they came
    path/base/…                                  rows up to the last compaction, by partition

A trigger writes its own rows and nothing else. Readers put base and batches together in one
aggregate. Compaction resolves the batches into the partitions they touch and publishes these
together with the numbers of the batches they hold, so no reader sees a batch twice or not
at all.
"""

from __future__ import annotations

import threading
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from tidelake import schemas
from tidelake.operators.merge import latest_wins
from tidelake.sinks.tables import _files, fact_klines
from tidelake.sinks.versions import VersionedTable
from tidelake.sources.files import _or_none

VERSION = DecimalType(38, 0)
COMPACT_EVERY = 20          # batches of a query
_LOCKS: dict[str, threading.Lock] = defaultdict(threading.Lock)


def candle_version(df: DataFrame, batch_id: int) -> Column:
    """One number that rises with the version of a candle: closed before open, then event time,
    trades, and batch. Candles without a mark count as closed, as windows of a stream do,
    whose trades grow from update to update."""

    def digits(value: Column, n: int) -> Column:
        return F.lpad(F.greatest(F.coalesce(value.cast("long"), F.lit(0)), F.lit(0)).cast("string"), n, "0")

    closed = F.coalesce(F.col("is_closed"), F.lit(True)) if "is_closed" in df.columns else F.lit(True)
    event = F.col("event_time") if "event_time" in df.columns else F.lit(0)
    return F.concat(
        F.when(closed, "1").otherwise("0"), digits(event, 15), digits(F.col("num_trades"), 12), digits(F.lit(batch_id), 10),
    ).cast(VERSION)


@dataclass(frozen=True)
class UpsertLog:
    """A keyed table. ``rules`` as in :func:`tidelake.operators.merge.merge_frames`: by default
    the row of the highest version stays; ``keep`` takes a column from the lowest one."""

    path: str
    schema: StructType
    keys: list[str]
    partitions: dict[str, Column]
    rules: dict[str, str] = field(default_factory=dict)

    @property
    def base(self) -> VersionedTable:
        stored = StructType(list(self.schema.fields)).add("_version", VERSION).add("_first", VERSION)
        return VersionedTable(f"{self.path}/base", stored, self.partitions)

    def append(self, batch: DataFrame, query: str, batch_id: int, version: Column | None = None) -> bool:
        """Write one batch; False if it is there already, as when it is delivered again.

        Where a batch has several versions of a key the best one stays. The folder appears
        by a rename when it is whole, so a batch is read whole or not at all.
        """
        spark = batch.sparkSession
        files, at = _files(spark, self.path)
        folder = f"{self.path}/deltas/query={query}/batch={batch_id}"
        if files.util().exists(at(folder)):
            return False
        number = candle_version(batch, batch_id) if version is None else version
        rows = batch.select(*self.schema.fieldNames(), number.alias("_version"))
        rows = latest_wins(rows, self.keys, [F.col("_version").desc()]).withColumn("_first", F.col("_version"))
        draft = f"{self.path}/_drafts/{query}-{batch_id}"
        rows.hint("rebalance").write.mode("overwrite").parquet(draft)
        files.mkdir(at(f"{self.path}/deltas/query={query}"), None, True)
        spark._jvm.org.apache.hadoop.fs.Path(draft).getFileSystem(
            spark._jsc.hadoopConfiguration()).rename(at(draft), at(folder))
        return True

    def _deltas(self, spark: SparkSession, done: dict[str, int]) -> DataFrame | None:
        """Batches that the base lacks; the others are pruned by folder."""
        schema = StructType(list(self.base.schema.fields)).add("query", "string").add("batch", "long")
        rows = _or_none(lambda: spark.read.schema(schema).parquet(f"{self.path}/deltas"))
        if rows is None:
            return None
        for query, last in done.items():
            rows = rows.filter((F.col("query") != query) | (F.col("batch") > last))
        return rows

    def _done(self, spark: SparkSession) -> dict[str, int]:
        return {q: int(n) for q, n, state in self.base.listed(spark) if state == "compacted"}

    def _resolved(self, rows: DataFrame) -> DataFrame:
        """One row per key; fixed-width values, so that Spark keeps the hash aggregate."""
        def value(c: str) -> Column:
            match self.rules.get(c, "replace"):
                case "keep":
                    return F.min_by(c, "_first").alias(c)
                case "greatest":
                    return F.max(c).alias(c)
                case "least":
                    return F.min(c).alias(c)
            return F.max_by(c, "_version").alias(c)

        values = [c for c in self.schema.fieldNames() if c not in self.keys]
        best = rows.groupBy(*self.keys).agg(
            *map(value, values), F.max("_version").alias("_version"), F.min("_first").alias("_first"))
        return best.select(*self.base.schema.fieldNames())

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of now: base and later batches in one aggregate."""
        columns = self.base.schema.fieldNames()
        deltas = self._deltas(spark, self._done(spark))
        rows = self.base.read(spark).select(*columns)
        if deltas is not None:
            rows = rows.unionByName(deltas.select(*columns))
        return self._resolved(rows).select(*self.schema.fieldNames())

    def compact(self, spark: SparkSession) -> int:
        """Resolve the batches into the base; the number of partitions that were rewritten.

        Only partitions in which a batch has rows are read and written. Batches stay until the
        next compaction, for readers that began before this one was published.
        """
        with _LOCKS[self.path]:
            before = self._done(spark)
            deltas = self._deltas(spark, before)
            if deltas is None:
                return 0
            last = {r[0]: r[1] for r in deltas.groupBy("query").agg(F.max("batch")).collect()}
            if not last:
                return 0
            # batches that come meanwhile are not part of it
            for query, n in last.items():
                deltas = deltas.filter((F.col("query") != query) | (F.col("batch") <= n))
            deltas = deltas.filter(F.col("query").isin(list(last)))
            folder = F.concat_ws("/", *[
                F.concat(F.lit(f"{n}="), c.cast("string")) for n, c in self.partitions.items()])
            touched = [r[0] for r in deltas.select(folder).distinct().collect()]
            columns = self.base.schema.fieldNames()
            rows = self.base.read(spark, touched).select(*columns).unionByName(deltas.select(*columns))
            done = {**before, **last}
            self.base.write(self._resolved(rows), notes=[(q, str(n), "compacted") for q, n in done.items()])
            files, at = _files(spark, self.path)
            for query, n in before.items():
                listing = files.listStatus(at(f"{self.path}/deltas/query={query}"))
                while listing.hasNext():
                    batch = listing.next().getPath()
                    if int(batch.getName().removeprefix("batch=")) <= n:
                        files.delete(batch, True)
            return len(touched)


def kline_log(path: str, rules: dict[str, str] | None = None) -> UpsertLog:
    """Candles, by interval and day as in :func:`tidelake.sinks.tables.fact_klines`."""
    return UpsertLog(path, schemas.FACT_KLINES, schemas.KEYS["fact_klines"], fact_klines(path).partitions, rules or {})


def log_batches(table: UpsertLog, query: str, compact_every: int = COMPACT_EVERY):
    """foreachBatch callback: append the batch, and compact after each ``compact_every``. Queries
    of one driver may share a table under different names; their batches are numbered apart."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, query, batch_id)
        if (batch_id + 1) % compact_every == 0:
            table.compact(batch.sparkSession)

    return write


