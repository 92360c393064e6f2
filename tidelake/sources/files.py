"""File scans: CSV, NDJSON, Parquet; columns taken from paths; input audit."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidelake.operators.contract import normalise

# Partition columns of the landing layout; text, so that hour 03 stays 03.
LAYOUT = ("date", "symbol", "hour")

# fixed value: trade files are named after their symbol and span in days
TRADE_FILE = r"trades_([A-Z0-9]+)_\d+d\.csv"


def _or_none(read) -> DataFrame | None:
    """The frame, or None if its path or glob matches nothing."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def with_layout(schema: StructType) -> StructType:
    """``schema`` plus the partition columns it lacks."""
    full = StructType(list(schema.fields))
    for name in LAYOUT:
        if name not in full.fieldNames():
            full = full.add(name, StringType())
    return full


def load_csv(
    spark: SparkSession, path: str, schema: StructType, header: bool = True
) -> DataFrame | None:
    """All CSV files of a path or glob; unreadable fields become NULL."""
    reader = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    return _or_none(lambda: reader.csv(path))


def load_json(
    spark: SparkSession, path: str, schema: StructType, base_path: str | None = None
) -> DataFrame | None:
    """NDJSON files; with ``base_path`` a glob below it keeps its partition columns."""
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if base_path:
        reader = reader.option("basePath", base_path)
    return _or_none(lambda: reader.json(path))


def load_silver(
    spark: SparkSession, path: str, dataset: str, schema: StructType | None = None
) -> DataFrame | None:
    """A partitioned Parquet dataset with canonical names.

    Partition discovery stays on, so filters on date, symbol and hour skip folders. Only
    without a schema are the footers merged.
    """
    if schema is not None:
        df = _or_none(lambda: spark.read.schema(schema).parquet(path))
    else:
        df = _or_none(lambda: spark.read.option("mergeSchema", "true").parquet(path))
    return None if df is None else normalise(df, dataset)


def from_file_name(pattern: str = TRADE_FILE) -> Column:
    """First group of ``pattern`` in the name of the file a row came from."""
    return F.regexp_extract(F.col("_metadata.file_name"), pattern, 1)


def load_trades_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    df = load_csv(spark, path, schema)
    return None if df is None else df.select("*", from_file_name().alias("symbol"))


def discover_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Sorted distinct symbols of a partitioned dataset, from its file list: no file of
    the dataset is opened."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select(F.regexp_extract("path", "/symbol=([^/]+)/", 1).alias("symbol"))
    )
    return found.filter(F.col("symbol") != "").distinct().orderBy("symbol")


def layout_time() -> Column:
    """Snapshot time from the date and hour folders of a row."""
    return F.try_to_timestamp(F.concat_ws(" ", "date", "hour"), F.lit("yyyy-MM-dd HH"))


def audit_inputs(spark: SparkSession, globs: dict[str, str]) -> DataFrame:
    """(dataset, files) for every input, from file listings alone.

    Raises if no dataset has any file; a single missing one only shows as 0.
    """
    def listed(name: str, glob: str) -> DataFrame:
        files = _or_none(lambda: spark.read.format("binaryFile").load(glob))
        if files is None:
            return spark.range(0).select(F.lit(name).alias("dataset"), F.lit("").alias("path"))
        return files.select(F.lit(name).alias("dataset"), "path")

    expected = reduce(
        DataFrame.union, (spark.range(1).select(F.lit(n).alias("dataset")) for n in globs)
    )
    found = reduce(DataFrame.unionByName, (listed(n, g) for n, g in globs.items()))
    counts = found.groupBy("dataset").agg(F.count(F.lit(1)).alias("files"))
    audit = expected.join(counts, "dataset", "left").withColumn(
        "files", F.coalesce("files", F.lit(0).cast("long"))
    )
    if audit.filter(F.col("files") > 0).isEmpty():
        raise FileNotFoundError(f"no input files for any of: {', '.join(globs)}")
    return audit
