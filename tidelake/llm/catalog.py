"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: build(use_utc(spark), sf_dir.rstrip("/"))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
