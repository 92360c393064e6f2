"""Which files of a lake have been read: a list that is published like any snapshot.

A run reads the files that the list lacks, and publishes the longer list as its last step. A
run that dies before that leaves the list as it was, so the next one reads the same files
again; what it does with them must bear repetition, as keyed tables do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.session import stored
from tidelake.sinks.tables import read_snapshot, replace_snapshot
from tidelake.sources.files import _or_none

SCHEMA = "dataset string, path string, length bigint, modified timestamp"
# What makes a file the same: one that has grown or was written anew is read again.
IDENTITY = ["dataset", "path", "length", "modified"]


def listed(spark: SparkSession, folder: str, dataset: str) -> DataFrame | None:
    """The files below ``folder``, from listings alone; None if there is no such folder. Of a
    folder that a stream writes, only files of finished triggers count."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = _or_none(lambda: reader.load(folder))
    if found is None:
        return None
    return found.select(
        F.lit(dataset).alias("dataset"), "path", "length", F.col("modificationTime").alias("modified"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    known = _or_none(lambda: read_snapshot(spark, path, SCHEMA))
    return spark.createDataFrame([], SCHEMA) if known is None else known


def unread(found: DataFrame, known: DataFrame) -> DataFrame:
    return found.join(known, IDENTITY, "left_anti")


def publish(spark: SparkSession, path: str, fresh: DataFrame) -> None:
    """Add ``fresh`` files to the list. A file that was read in an earlier form keeps one row."""
    known = read_manifest(spark, path)
    kept = known.join(fresh.select("dataset", "path"), ["dataset", "path"], "left_anti")
    with stored(kept.unionByName(fresh.select(*IDENTITY)), "manifest") as rows:
        replace_snapshot(rows.coalesce(1), path)
