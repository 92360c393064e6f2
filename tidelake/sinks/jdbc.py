"""JDBC writes: staging overwrite, snapshot replace, history append."""

from __future__ import annotations

from pyspark.sql import DataFrame

# fixed values: rows per insert batch, and connections opened at once
BATCH_SIZE = 5_000
CONNECTIONS = 3


def write_options(
    properties: dict[str, str] | None = None,
    truncate: bool = False,
    batch_size: int = BATCH_SIZE,
    connections: int = CONNECTIONS,
) -> dict[str, str]:
    options = {"batchsize": str(batch_size), "numPartitions": str(connections)}
    if truncate:
        options["truncate"] = "true"
    return {**options, **(properties or {})}


def _write(df: DataFrame, url: str, table: str, mode: str, options: dict[str, str]) -> None:
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, **options).save()


def stage(df: DataFrame, url: str, table: str, **how) -> None:
    """Drop and refill a staging table."""
    _write(df, url, table, "overwrite", write_options(**how))


def replace(df: DataFrame, url: str, table: str, **how) -> None:
    """Empty a table and refill it; its definition and indexes stay."""
    _write(df, url, table, "overwrite", write_options(truncate=True, **how))


def append(df: DataFrame, url: str, table: str, **how) -> bool:
    """Add one run's rows; an empty run opens no connection."""
    if df.isEmpty():
        return False
    _write(df, url, table, "append", write_options(**how))
    return True
