"""JDBC scans. Driver jar, URL and credentials come from the deployment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed value: rows per fetch round trip
FETCH_SIZE = 10_000


def scan_options(
    properties: dict[str, str] | None = None,
    column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. With a numeric, date or timestamp ``column`` and its bounds the
    table is read by many connections; without them by one."""
    options = {"fetchsize": str(FETCH_SIZE), **(properties or {})}
    if column:
        if not bounds or not partitions:
            raise ValueError("a partitioned scan needs bounds and a number of partitions")
        options.update(
            partitionColumn=column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def scan(spark: SparkSession, url: str, table: str, **how) -> DataFrame:
    """A table. Filters and column choices on the result run in the database, so a
    predicate needs no sub-query: ``scan(...).filter("interval_code = '1d'")``."""
    options = scan_options(**how)
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
