"""The six batch stages fed from landed files, reading only what is new since the last run."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.candles import TARGETS
from tidelake.operators.contract import normalise
from tidelake.plans.batch import Inputs, Run, Warehouse, run_batch
from tidelake.session import stored
from tidelake.sources import files, manifest
from tidelake.streaming import landing


@dataclass(frozen=True)
class Lake:
    """Landed files of one layer: ``silver`` Parquet records or ``bronze`` messages, one a line."""

    root: str
    layer: str = "silver"

    def folder(self, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/{self.layer}/{landing.FOLDERS[dataset]}"

    def files(self, spark: SparkSession) -> DataFrame:
        """(dataset, path, length, modified) of everything landed."""
        found = [manifest.listed(spark, self.folder(d), d) for d in landing.FOLDERS]
        none = spark.createDataFrame([], manifest.SCHEMA)
        return reduce(DataFrame.unionByName, [f for f in found if f is not None], none)

    def read(self, spark: SparkSession, dataset: str, paths: list[str]) -> DataFrame | None:
        """The records of these files with canonical names and their date, symbol and hour."""
        if not paths:
            return None
        base = spark.read.option("basePath", self.folder(dataset))
        if self.layer == "silver":
            rows = base.schema(landing.silver_schema(spark, dataset)).parquet(*paths)
        else:
            lines = base.schema(f"value string, {', '.join(f'{c} string' for c in landing.LAYOUT)}").text(paths)
            # the folder's hour stands in for the time of reception, as it was derived from it
            rows = landing.records(lines.select("value", files.layout_time().alias("timestamp")), dataset)
        return normalise(rows, dataset)


def run_from_lake(
    spark: SparkSession,
    lake: Lake,
    warehouse: Warehouse,
    top_n: int = 10,
    now: Column | None = None,
    adjust: bool = False,
    targets=TARGETS,
) -> Run | None:
    """Bring the warehouse up to date with the files landed since the last run; None if there
    are none.

    Old files are not opened: new ones are found by comparing listings with the manifest in
    the warehouse, whose paths are all that reaches the driver. Candles compete with stored
    ones by version, tickers replace the snapshot of their hour, trades are added to those
    kept, and the marts are made from the whole tables, so any division of the files into
    runs gives the same marts. The manifest is published after the last stage: a run that
    dies is repeated by the next one.
    """
    at = warehouse.path(f"_files_{lake.layer}")
    with stored(manifest.unread(lake.files(spark), manifest.read_manifest(spark, at)), "new-files") as fresh:
        paths: dict[str, list[str]] = {}
        for dataset, path in fresh.select("dataset", "path").collect():
            paths.setdefault(dataset, []).append(path)
        if not paths:
            return None
        given = Inputs(
            **{d: lake.read(spark, "ticker" if d == "tickers" else d, paths.get("ticker" if d == "tickers" else d, []))
               for d in ("klines", "tickers", "trades")},
            incremental=True,
        )
        run = run_batch(spark, given, warehouse, top_n, now, adjust, targets)
        manifest.publish(spark, at, fresh)
    return run
