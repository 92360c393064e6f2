"""Session options, the shared working folder, and materialised intermediates."""

from __future__ import annotations

import hashlib
import io
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Only options the engine's semantics depend on, plus split sizing. Memory, executors
# and connector settings belong to the deployment.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": "128m",
}


# Rows a shuffle partition begins with; adaptive execution merges small ones by bytes.
ROWS_PER_PARTITION = 100_000


def get_session(
    app_name: str = "tidelake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    options: dict[str, str] | None = None,
    initial_partitions: int | None = None,
) -> SparkSession:
    """Create or get a session with the engine's options.

    Adaptive execution merges shuffle partitions but never adds any, so large batch jobs
    set ``initial_partitions`` to about shuffle bytes / 128 MB. ``shuffle_partitions``
    then only matters for stateful streams, which cannot change it later.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(options or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if initial_partitions:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions)
        )
    spark = builder.getOrCreate()
    context = spark.sparkContext
    # without a shared folder yet, it is for the caller to name one and then ship
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or context.master.startswith("local"):
        ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, whose functions run in them, without having it
    installed: it goes to them as a zip from the shared folder. A local master's workers get it
    too. Shipped once per context and content."""
    home, packed = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(home.rglob("*.py")):
            entry = zipfile.ZipInfo(str(Path(home.name) / file.relative_to(home)))
            archive.writestr(entry, file.read_bytes())
    name = f"{home.name}-{hashlib.sha256(packed.getvalue()).hexdigest()[:16]}.zip"
    if any(f.endswith(name) for f in spark.sparkContext.listFiles):
        return
    path = f"{shared_dir(spark)}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(packed.getvalue()))
    finally:
        stream.close()
    spark.sparkContext.addPyFile(path)


def use_utc(spark: SparkSession) -> SparkSession:
    """Every window, date and hour in the engine is a UTC one."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where the one machine is the cluster, falls back to a fresh
    temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidelake-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where a frame is read several times and every read must see the same rows
    (ranks, stage hand-over). Unlike a cached frame it survives the loss of executors,
    keeps column pruning, and its row count comes from the footers.
    """
    return _written(df, new_path(df.sparkSession, label))


@contextmanager
def stored(df: DataFrame, label: str = "table") -> Iterator[DataFrame]:
    """:func:`materialize` for the length of a block, after which the copy is removed.
    Nothing derived from it may be used later."""
    spark = df.sparkSession
    path = new_path(spark, label)
    try:
        yield _written(df, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# Remove the shuffle files of a query when it ends, not when the driver happens to collect garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def drop_shuffles(session: SparkSession) -> SparkSession:
    """For sessions whose frames are run once each, as those of a stream's triggers are: disk
    then holds the shuffles of the queries that run, not of all that have run. A frame that
    is run again shuffles again."""
    session.conf.set(_SHUFFLE_CLEANUP, "true")
    return session


def state_on_disk(session: SparkSession) -> SparkSession:
    """For sessions of stateful streams: state lies in RocksDB files on the workers' disks, of
    which a bounded part is in memory, and not as objects on their heaps. New checkpoints only;
    one that exists keeps the store it began with."""
    store = "spark.sql.streaming.stateStore"
    session.conf.set(
        f"{store}.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.conf.set(f"{store}.rocksdb.boundedMemoryUsage", "true")
    # else each row that is put is looked up first, to count them
    session.conf.set(f"{store}.rocksdb.trackTotalNumberOfRows", "false")
    return session


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """:func:`drop_shuffles` for what is run in a block."""
    before = spark.conf.get(_SHUFFLE_CLEANUP)
    drop_shuffles(spark)
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)


@contextmanager
def partitions_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Let the shuffles that run in a block begin with a partition per ``ROWS_PER_PARTITION``
    of so many rows, and never with fewer than before: what a task holds then does not grow
    with the rows. Frames that are only built in it and run later are not affected."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    least = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(name, max(least, ceil(rows / ROWS_PER_PARTITION)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
