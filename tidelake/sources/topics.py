"""Message topics as streaming frames of (key, value, timestamp)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# fixed value: most records a trigger of the candle stream reads
CANDLES_PER_TRIGGER = 10_000


def topic_options(
    servers: str, topic: str, per_trigger: int | None = None, start: str = "earliest"
) -> dict[str, str]:
    """Everything the topic holds from its start, unless told otherwise: a limit per trigger
    below the topic's rate would fall behind for ever, a late start leaves records out."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    return options if per_trigger is None else options | {"maxOffsetsPerTrigger": str(per_trigger)}


def candle_options(servers: str, topic: str) -> dict[str, str]:
    """Of the stream of 1-minute candles: bounded triggers, from now on."""
    return topic_options(servers, topic, CANDLES_PER_TRIGGER, "latest")


def read_topic(spark: SparkSession, servers: str, topic: str, **how) -> DataFrame:
    """Needs the Kafka connector that matches the Spark version on the class path."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **how)).load()


def read_folder(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
    files_per_trigger: int | None = None, **options: str,
) -> DataFrame:
    """Files appearing in a folder, where no broker is at hand."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
