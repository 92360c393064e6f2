"""Checks on tables and files, and repair of drifted files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidelake.operators.filters import strangers
from tidelake.session import materialize


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    return strangers(fact, dim, key, dim_key)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, nulls) for every mandatory column, from one pass."""
    counts = [F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]
    return df.agg(*counts).unpivot([], columns, "column_name", "nulls")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, actual), one row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("actual")).select(F.lit(name).alias("table_name"), "actual")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile(counts: DataFrame, baseline: DataFrame, tolerance: float = 0.0001) -> DataFrame:
    """Compare (table_name, actual) with (table_name, expected).

    A table missing from the counts has none; an expected 0 tolerates nothing else.
    """
    gap = F.abs(F.col("actual") - F.col("expected"))
    ok = F.when(F.col("expected") == 0, gap == 0).otherwise(gap / F.col("expected") <= tolerance)
    return (
        baseline.join(counts, "table_name", "left")
        .withColumn("actual", F.coalesce("actual", F.lit(0).cast("long")))
        .select("table_name", "expected", "actual", F.try_divide(gap, F.col("expected")).alias("drift"), ok.alias("ok"))
    )


# ------------------------------------------------------------------- schema drift

LAYOUT = ("date", "symbol", "hour")

# Stores that Arrow opens by itself. Files of any other store come through Spark's readers,
# which knows their settings, at the price of reading whole files.
ARROW_STORES = ("file", "hdfs", "s3", "s3a", "gs", "abfss")

_FOUND = (
    "path string, date string, symbol string, hour string, num_rows long, created_by string, "
    "mismatches array<struct<field:string,stored:string,expected:string>>, error string"
)


def _handle(uri: str, content: bytes | None):
    """A file as Arrow reads it: from the bytes Spark has read, or opened by name."""
    import pyarrow as pa
    from pyarrow import fs

    if content is not None:
        return pa.BufferReader(content)
    system, name = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return system.open_input_file(name)


def _parquet_files(spark: SparkSession, path: str, through_spark: bool | None) -> DataFrame:
    """(path, content) of all Parquet files below ``path``; content is NULL where Arrow is to
    open the file. The list is a DataFrame and never visits the driver."""
    if through_spark is None:
        scheme = path.partition("://")[0] if "://" in path else "file"
        if path.startswith("file:/"):
            scheme = "file"
        through_spark = scheme not in ARROW_STORES
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    content = F.col("content") if through_spark else F.lit(None).cast("binary")
    return listed.select("path", content.alias("content"), "length", F.col("modificationTime").alias("modified"))


def _folder(name: str):
    return F.regexp_extract("path", rf"/{name}=([^/]+)", 1).alias(name)


def rescan_drift(
    spark: SparkSession, path: str, schema: StructType, previous: DataFrame | None = None, through_spark: bool | None = None
) -> DataFrame:
    """:func:`scan_drift` with each file's ``length`` and time ``modified``; of the files that a
    ``previous``, stored result has in the same form its rows are kept, so only new or changed
    files are opened. Files that are gone are left out."""
    files = _parquet_files(spark, path, through_spark)
    if previous is None:
        return _with_form(scan_drift(spark, path, schema, through_spark, files), files)
    form = ["path", "length", "modified"]
    old = previous.join(files.select(*form), form, "left_semi")
    new = files.join(previous.select(*form), form, "left_anti")
    return old.unionByName(_with_form(scan_drift(spark, path, schema, through_spark, new), new))


def _with_form(scan: DataFrame, files: DataFrame) -> DataFrame:
    return scan.join(files.select("path", "length", "modified"), "path")


def scan_drift(
    spark: SparkSession, path: str, schema: StructType, through_spark: bool | None = None, files: DataFrame | None = None
) -> DataFrame:
    """One row per Parquet file below ``path`` with everything in which its columns differ
    from ``schema``, and a ``status``: ERROR (unreadable, see ``error``), DRIFT or OK.

    Columns that only one side has are no mismatch: readers fill or ignore them. Workers
    read footers only, unless files must come through Spark (``through_spark``).
    """
    expected = {f.name: f.type for f in to_arrow_schema(schema) if f.name not in LAYOUT}

    def compare(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for file in batch.to_pylist():
                row = {n: file[n] for n in ("path", *LAYOUT)} | {"mismatches": []}
                try:
                    with _handle(file["path"], file["content"]) as handle:
                        footer = pq.ParquetFile(handle)
                        row |= {"num_rows": footer.metadata.num_rows, "created_by": footer.metadata.created_by}
                        for column in footer.schema_arrow:
                            want = expected.get(column.name)
                            if want is not None and column.type != want:
                                row["mismatches"].append(
                                    {"field": column.name, "stored": str(column.type), "expected": str(want)})
                except (OSError, pa.ArrowException) as problem:
                    row["error"] = f"{type(problem).__name__}: {problem}"
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=found)

    found = to_arrow_schema(StructType.fromDDL(_FOUND))
    files = _parquet_files(spark, path, through_spark) if files is None else files
    status = (
        F.when(F.col("error").isNotNull(), "ERROR").when(F.size("mismatches") > 0, "DRIFT").otherwise("OK")
    )
    return (
        files.select("path", "content", *[_folder(n) for n in LAYOUT])
        .mapInArrow(compare, _FOUND).withColumn("status", status)
    )


def drift_summaries(scans: dict[str, DataFrame]) -> DataFrame:
    """Files per (dataset, status)."""
    named = [s.select(F.lit(name).alias("dataset"), "status") for name, s in scans.items()]
    return reduce(DataFrame.unionByName, named).groupBy("dataset", "status").agg(
        F.count(F.lit(1)).alias("files"))


# Paths are dealt to this many tasks at most; one task handles its files one after the other.
MAX_REPAIR_TASKS = 10_000


def repair_tasks(files: int) -> int:
    return max(1, min(files, MAX_REPAIR_TASKS))


def repair_drift(
    spark: SparkSession,
    scan: DataFrame,
    target: str,
    schema: StructType,
    dry_run: bool = False,
    limit: int | None = None,
    through_spark: bool = False,
) -> DataFrame:
    """Write the drifted files of a stored ``scan``, in the types of ``schema``, below
    ``target``; the originals stay as they are until :func:`swap_repaired`.

    The paths are spread over a stated number of tasks, which read their files batch by batch
    and cast what differs. A file that cannot be read or cast is left out and reported; the
    others are written in the landing layout, replacing the touched folders of ``target``, so
    a second run leaves the same rows. If every file of the scan is unreadable, the store
    itself is out of reach, and the repair fails. ``limit`` bounds the files of one run, in
    path order. Returns (path, num_rows, status, detail) with status REPAIRED, FAILED or
    PLANNED (dry run).
    """
    states = {r["status"]: r["count"] for r in scan.groupBy("status").count().collect()}
    if states and set(states) == {"ERROR"}:
        raise RuntimeError("no file of the scan can be read: check the access of the workers")
    drifted = scan.filter(F.col("status") == "DRIFT").select("path", *LAYOUT, "num_rows")
    if limit is not None:
        drifted = drifted.orderBy("path").limit(limit)
    if dry_run:
        return drifted.select(
            "path", "num_rows", F.lit("PLANNED").alias("status"), F.lit(None).cast("string").alias("detail"))
    columns = to_arrow_schema(schema)
    out = columns.append(_text_field("_path")).append(_text_field("_problem"))

    def rewrite(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        def cast(file, rows):
            for field in columns:
                if field.name in LAYOUT:
                    yield pa.repeat(pa.scalar(file[field.name], field.type), rows.num_rows)
                elif field.name in rows.schema.names:
                    yield rows.column(field.name).cast(field.type)
                else:
                    yield pa.nulls(rows.num_rows, field.type)

        for batch in batches:
            for file in batch.to_pylist():
                problem = None
                try:
                    with _handle(file["path"], file.get("content")) as handle:
                        for rows in pq.ParquetFile(handle).iter_batches():
                            n = rows.num_rows
                            values = list(cast(file, rows))
                            yield pa.RecordBatch.from_arrays(
                                [*values, pa.repeat(pa.scalar(file["path"]), n), pa.nulls(n, pa.string())], schema=out)
                except (OSError, pa.ArrowException) as found:
                    problem = f"{type(found).__name__}: {found}"
                if problem:
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.nulls(1, f.type) for f in columns], pa.array([file["path"]]), pa.array([problem])],
                        schema=out)

    tasks = repair_tasks(drifted.count())
    paths = drifted.select("path", *LAYOUT)
    if through_spark:
        root = _common_folder(scan)
        paths = _parquet_files(spark, root, True).drop("length", "modified").join(paths, "path") if root else paths
    attempt = materialize(
        paths.repartition(tasks, "path").mapInArrow(
            rewrite, StructType([*schema.fields]).add("_path", "string").add("_problem", "string")),
        "repair",
    )
    failed = materialize(
        attempt.filter("_problem IS NOT NULL").groupBy("_path").agg(F.first("_problem").alias("detail")), "failed")
    good = attempt.join(failed.select("_path"), "_path", "left_anti")
    (
        good.select(schema.fieldNames()).hint("rebalance", *LAYOUT).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*LAYOUT).parquet(target)
    )
    return drifted.join(failed.withColumnRenamed("_path", "path"), "path", "left").select(
        "path", "num_rows",
        F.when(F.col("detail").isNull(), "REPAIRED").otherwise("FAILED").alias("status"), "detail")


def _text_field(name: str):
    import pyarrow as pa

    return pa.field(name, pa.string())


def _common_folder(scan: DataFrame) -> str | None:
    """The folder above the layout's own folders."""
    row = scan.select(F.regexp_extract("path", r"^(.*?)/date=", 1)).first()
    return row[0] if row else None


def publish_repaired(spark: SparkSession, table, scan: DataFrame, repaired: DataFrame, target: str) -> list[str]:
    """Put the repaired copies below ``target`` into a :class:`VersionedTable`, all at once: a
    reader sees the old rows of every repaired partition or the new ones, and a run that dies
    has changed nothing. Sound files of these partitions go along. Partitions in which a
    file could not be repaired stay as they are. The partitions replaced.

    What reaches the driver are the names of folders and of the sound files in them.
    """
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{n}="), n) for n in LAYOUT])
    states = scan.join(repaired.select("path", F.col("status").alias("outcome")), "path", "left").withColumn("folder", folder)
    able = states.groupBy("folder").agg(
        F.count_if(F.col("outcome") == "REPAIRED").alias("good"), F.count_if(F.col("outcome") == "FAILED").alias("bad"),
        F.count_if(F.col("status") == "ERROR").alias("lost"),
    ).filter("good > 0 AND bad = 0 AND lost = 0")
    folders = [r[0] for r in able.select("folder").collect()]
    if not folders:
        return []
    sound = [r[0] for r in states.join(able, "folder", "left_semi").filter("status = 'OK'").select("path").collect()]
    names = table.schema.fieldNames()
    rows = spark.read.schema(table.schema).option("basePath", target).parquet(*[f"{target}/{f}" for f in folders]).select(*names)
    if sound:
        base = table.path if "/version=" not in sound[0] else sound[0].partition("/date=")[0]
        rows = rows.unionByName(spark.read.schema(table.schema).option("basePath", base).parquet(*sound).select(*names))
    table.write(rows)
    return folders


def swap_repaired(spark: SparkSession, repaired: DataFrame, target: str, root: str) -> int:
    """Put the repaired copies into a plain lake, file by file, so that readers may meanwhile miss
    rows (:func:`publish_repaired` switches at once): each repaired original is renamed to a hidden
    name, which readers skip, and the new files of its folder are moved beside it. Returns
    the number of originals set aside. A swap that was broken off can be run again.

    File names visit the driver, as many as were repaired; a rename is a call of the store's
    and needs no task.
    """
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    system = path_of(root).getFileSystem(spark._jsc.hadoopConfiguration())
    aside, folders = 0, set()
    for r in repaired.filter("status = 'REPAIRED'").select("path").toLocalIterator():
        old = path_of(r["path"])
        folders.add(r["path"].rpartition("/")[0])
        if system.exists(old):
            system.rename(old, path_of(old.getParent(), f"_replaced-{old.getName()}"))
            aside += 1
    for folder in sorted(folders):
        tail = "/".join(folder.split("/")[-len(LAYOUT):])
        fresh = path_of(f"{target}/{tail}")
        if system.exists(fresh):
            for status in system.listStatus(fresh):
                if status.getPath().getName().endswith(".parquet"):
                    system.rename(status.getPath(), path_of(folder, status.getPath().getName()))
    return aside
