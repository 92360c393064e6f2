"""Keyed, replaced and appended tables on partitioned Parquet."""

from __future__ import annotations

import uuid
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake import schemas
from tidelake.operators.merge import merge_frames
from tidelake.session import stored


def _write(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions present in ``df``.

    Dynamic mode stages the new files and swaps folders at commit. It is set on the
    write itself, because under the static default untouched partitions would be lost.
    The rebalance hint lets adaptive execution merge small and split large partitions.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


@dataclass(frozen=True)
class KeyedTable:
    """A Parquet table with a unique key, partitioned by columns derived from that key.

    ``partitions`` maps each partition column to its expression, which must depend on
    key columns only, so that a row never moves between partitions.
    """

    path: str
    schema: StructType
    keys: list[str]
    partitions: dict[str, Column]
    rules: dict[str, str] = field(default_factory=dict)
    # of the files that insert_new writes, such as Bloom filters of key columns
    options: dict[str, str] = field(default_factory=dict)

    def _stored(self) -> StructType:
        names = [n for n in self.partitions if n not in self.schema.fieldNames()]
        stored = StructType(list(self.schema.fields))
        for name in names:
            stored = stored.add(name, "date" if name.endswith("date") else "string")
        return stored

    def read(self, spark: SparkSession, keep_partitions: bool = False) -> DataFrame:
        try:
            df = spark.read.schema(self._stored()).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            df = spark.createDataFrame([], self._stored())
        return df if keep_partitions else df.select(*self.schema.fieldNames())

    def upsert(
        self,
        source: DataFrame,
        rules: dict[str, str] | None = None,
        staged: bool = False,
        touched: list[tuple] | None = None,
        order: list[Column] | None = None,
    ) -> None:
        """Merge rows with unique keys into the partitions they fall in.

        Only those partitions are read and rewritten. Their names are the one thing
        collected: each is a folder the commit has to handle on the driver anyway.
        Repeating an upsert changes nothing. With ``order`` the first of the stored and
        the new row in that order stays, so an older version that arrives later is ignored.

        The source is read twice, once for those names, so it is stored first unless it
        is ``staged`` already or the caller knows which partitions it can touch.
        """
        names = list(self.partitions)
        incoming = source.select(*self.schema.fieldNames()).withColumns(self.partitions)
        scope = nullcontext(incoming) if staged or touched else stored(incoming, "upsert")
        with scope as rows:
            if touched is None:
                touched = [tuple(r) for r in rows.select(*names).distinct().collect()]
            if not touched:
                return
            keys = [*self.keys, *[n for n in names if n not in self.keys]]
            target = self.partitions_of(source.sparkSession, touched)
            rules = self.rules if rules is None else rules
            merged = merge_frames(target, rows, keys, rules, order=order)
            _write(merged, self.path, names)

    def insert_new(self, source: DataFrame) -> None:
        """Append the rows whose key is not stored yet; stored rows never change.

        Reads no more than the keys of the partitions the source falls in, and of these only
        row groups that may hold a key of the source (:meth:`possible`); rewrites nothing.
        The source's own keys must be unique.
        """
        names, spark = list(self.partitions), source.sparkSession
        incoming = source.select(*self.schema.fieldNames()).withColumns(self.partitions)
        with stored(incoming, "insert") as rows:
            touched = [tuple(r) for r in rows.select(*names).distinct().collect()]
            if not touched:
                return
            keys = [*self.keys, *[n for n in names if n not in self.keys]]
            known = self.possible(rows, self.partitions_of(spark, touched)).select(*keys)
            fresh = rows.join(known, keys, "left_anti").hint("rebalance", *names)
            with _wide_in_lists(spark):
                fresh.write.mode("append").options(**self.options).partitionBy(*names).parquet(self.path)

    def possible(self, rows: DataFrame, known: DataFrame) -> DataFrame:
        """``known`` without most rows whose key ``rows`` lack, by conditions that reach the scan:
        each integer key lies between the least and the greatest of ``rows``, which row-group
        statistics answer, and is one of theirs if these are few, which Bloom filters answer."""
        numbers = [k for k in self.keys if self.schema[k].dataType.typeName() in ("long", "integer")]
        if not numbers:
            return known
        found = rows.agg(
            *[F.min(k).alias(f"min_{k}") for k in numbers], *[F.max(k).alias(f"max_{k}") for k in numbers],
            F.count(F.lit(1)).alias("n")).first()
        few = found["n"] <= IN_LIST
        lists = rows.agg(*[F.collect_set(k).alias(k) for k in numbers]).first() if few else {}
        for k in numbers:
            known = known.filter(F.col(k).between(found[f"min_{k}"], found[f"max_{k}"]))
            if few:
                known = known.filter(F.col(k).isin(lists[k]))
        return known

    def remove_partitions(self, spark: SparkSession, condition) -> list[str]:
        """Delete the folders of the first partition column for whose value ``condition`` holds;
        their values. No file is opened."""
        files, at = _files(spark, self.path)
        first, out = next(iter(self.partitions)), []
        if not files.util().exists(at(self.path)):
            return out
        listing = files.listStatus(at(self.path))
        while listing.hasNext():
            folder = listing.next().getPath()
            name, _, value = folder.getName().partition("=")
            if name == first and condition(value):
                files.delete(folder, True)
                out.append(value)
        return sorted(out)

    def partitions_of(self, spark: SparkSession, wanted: list[tuple]) -> DataFrame:
        """The rows of exactly these partitions; the rest is pruned by folder."""
        label = F.concat_ws("\u0001", *[F.col(n).cast("string") for n in self.partitions])
        names = ["\u0001".join(str(v) for v in values) for values in wanted]
        return self.read(spark, keep_partitions=True).filter(label.isin(names))


# So many keys of a batch are looked up one by one; it bounds what reaches the driver.
IN_LIST = 1_000


@contextmanager
def _wide_in_lists(spark: SparkSession):
    """Let lists of up to ``IN_LIST`` values reach the Parquet reader, whose default is 10."""
    name = "spark.sql.parquet.pushdown.inFilterThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, IN_LIST)
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Intervals with so few candles a day that a folder holds a month of them.
MONTHLY = ("4h", "1d")


def fact_klines(path: str, rules: dict[str, str] | None = None, buckets: int | None = None) -> KeyedTable:
    """Candles by interval and day; long intervals by interval and first of the month.

    With ``buckets`` each of these folders is divided by a hash of the symbol, so that a write
    for some symbols leaves the files of most others alone. Choose it for a folder to hold some
    files' worth of rows; it is part of the layout and never changes.
    """
    monthly = F.col("interval_code").isin(*MONTHLY)
    slot = F.when(monthly, F.trunc("open_time", "month")).otherwise(F.to_date("open_time"))
    partitions = {"interval_code": F.col("interval_code"), "open_date": slot}
    if buckets:
        partitions["bucket"] = F.pmod(F.hash("symbol_id"), F.lit(buckets)).cast("string")
    return KeyedTable(path, schemas.FACT_KLINES, schemas.KEYS["fact_klines"], partitions, rules or {})


def kline_places(table: KeyedTable, rows: DataFrame) -> list[tuple]:
    """The days of ``rows``, each with its bucket if the table has any; a folder each at least,
    so few."""
    below = [e.alias(n) for n, e in table.partitions.items() if n not in ("interval_code", "open_date")]
    return [tuple(r) for r in rows.select(F.to_date("open_time"), *below).distinct().collect()]


def kline_partitions(intervals, places: list) -> list[tuple]:
    """The partitions of :func:`fact_klines` that hold these intervals of these places, or of
    these days in a table without buckets."""
    split = [place if isinstance(place, tuple) else (place,) for place in places]
    return sorted({
        (code, day.replace(day=1) if code in MONTHLY else day, *below) for code in intervals for day, *below in split
    })


def fact_ticker(path: str) -> KeyedTable:
    return KeyedTable(
        path, schemas.FACT_TICKER, schemas.KEYS["fact_ticker_24h_snapshots"],
        {"snapshot_date": F.to_date("snapshot_time")},
    )


def recent_trades(path: str) -> KeyedTable:
    """Unique per (symbol, trade, day): a trade has one time, so one day."""
    return KeyedTable(
        path, schemas.FACT_RECENT_TRADES,
        [*schemas.KEYS["fact_recent_trades"], "trade_time"],
        {"trade_date": F.to_date("trade_time")},
        options={
            "parquet.bloom.filter.enabled#trade_id": "true",
            "parquet.bloom.filter.expected.ndv#trade_id": "500000",
        },
    )


# The file that names the folder a snapshot is read from.
_POINTER = "_current"


def _files(spark: SparkSession, path: str):
    fs, settings = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    store = fs.Path(path).getFileSystem(settings).getUri()
    return fs.FileContext.getFileContext(store, settings), fs.Path


def _current(spark: SparkSession, path: str) -> str | None:
    """The version folder in force, or None if there is none yet."""
    files, at = _files(spark, path)
    pointer = at(f"{path}/{_POINTER}")
    if not files.util().exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def replace_snapshot(df: DataFrame, path: str) -> None:
    """Replace a whole table: rows go into a new version folder, then a pointer is renamed into
    place. Readers see the old rows until that rename and the new ones after it; a run that
    dies in between leaves the old table as it was. The version before the last one is kept
    for readers that have already begun, older ones are removed.
    """
    spark = df.sparkSession
    before = _current(spark, path)
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    _switch(spark, path, version)
    files, at = _files(spark, path)
    listed = files.listStatus(at(path))
    while listed.hasNext():
        folder = listed.next().getPath()
        if folder.getName().startswith("version-") and folder.getName() not in (version, before):
            files.delete(folder, True)


def _switch(spark: SparkSession, path: str, version: str) -> None:
    files, at = _files(spark, path)
    jvm = spark._jvm
    fresh = at(f"{path}/{_POINTER}-{version}")
    system = fresh.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(fresh, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.rename(fresh, at(f"{path}/{_POINTER}"), options)


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table as of now; a path without any snapshot is reported as not found."""
    return spark.read.schema(schema).parquet(f"{path}/{_current(spark, path) or 'version-none'}")


def read_history(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All runs of :func:`append_history`."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def append_history(df: DataFrame, path: str) -> bool:
    """Add one run to a history table; an empty run adds nothing."""
    if df.isEmpty():
        return False
    df.write.mode("append").parquet(path)
    return True


def save_universe(symbols: DataFrame, path: str, updated_at: Column | None = None) -> None:
    """The list of active symbols, shared by all jobs."""
    stamp = F.current_timestamp() if updated_at is None else updated_at
    replace_snapshot(symbols.select("symbol", stamp.alias("updated_at")), path)


def load_universe(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored list, or None if there is none yet or it is empty."""
    try:
        df = read_snapshot(spark, path, "symbol string, updated_at timestamp")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if df.isEmpty() else df


def active_universe(spark: SparkSession, path: str, discover) -> DataFrame:
    """The stored list if present; otherwise ``discover()``'s, which is then stored."""
    known = load_universe(spark, path)
    if known is None:
        save_universe(discover(), path)
        known = load_universe(spark, path)
        if known is None:
            raise RuntimeError("no active symbols found")
    return known
