"""Small landed files packed into files of a useful size.

    root/<layer>_packed/<dataset>/version=<id>/date=<day>/part-*     see sinks/versions.py

A landed batch has a file per symbol and hour. Once all hours of a batch are over, its rows
move to the files of their days, merged and split to the advisory partition size and ordered
by symbol and hour, where row-group statistics find what folders found before. The list that
names a day's files also names the batches they hold, so readers see a batch in one place or
the other, never in both or neither, wherever a run dies.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.sinks.tables import _files
from tidelake.sinks.versions import VersionedTable
from tidelake.streaming import landing

# States of the list's notes: batches held by packed files, and of these the ones that the
# last run has moved, whose own files stay until the next run for readers that have begun.
PACKED, LEAVING = "packed", "leaving"


def packed_table(spark: SparkSession, root: str, layer: str, dataset: str) -> VersionedTable:
    return VersionedTable(
        f"{root}/{layer}_packed/{landing.FOLDERS[dataset]}", landing.landed_schema(spark, layer, dataset),
        {"date": F.col("date")})


def _ranges(numbers: set[int]) -> list[str]:
    """Batch numbers as "first-last", so that the list does not grow with the batches."""
    out: list[list[int]] = []
    for n in sorted(numbers):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [f"{a}-{b}" for a, b in out]


def _noted(listed: list[tuple[str, str, str]], state: str) -> set[int]:
    pairs = [p.split("-") for p, _, s in listed if s == state]
    return {n for a, b in pairs for n in range(int(a), int(b) + 1)}


def read(spark: SparkSession, root: str, layer: str, dataset: str) -> DataFrame | None:
    """What is landed in a layer, packed or not; None if nothing is."""
    batches = landing.landed_batches(spark, root, dataset)
    if not batches:
        return None
    table = packed_table(spark, root, layer, dataset)
    held = _noted(table.listed(spark), PACKED)
    loose = landing.rows_of(spark, root, layer, dataset, [n for n in batches if n not in held])
    return loose.unionByName(table.read(spark)) if held else loose


def pack(spark: SparkSession, root: str, layer: str, dataset: str, now: dt.datetime) -> int:
    """Pack the batches of a layer whose hours (days, for rejects) all lie before the one of
    ``now``; their number. Late rows reach a packed day with their batch, which rewrites that
    day alone. One run at a time; landing may go on meanwhile. Run it as often as there is
    about a target file of new rows per day."""
    table = packed_table(spark, root, layer, dataset)
    listed = table.listed(spark)
    held = _noted(listed, PACKED)
    loose = [n for n in landing.landed_batches(spark, root, dataset) if n not in held]
    files, at = _files(spark, root)
    for n in _noted(listed, LEAVING):
        files.delete(at(landing._landed_folder(root, layer, dataset, n)), True)
    rows = landing.rows_of(spark, root, layer, dataset, loose)
    hour = F.lit("23") if layer == "reject" else F.col("hour")
    last = rows.groupBy("batch").agg(F.max(F.concat_ws("T", "date", hour)).alias("last"))
    still = {r["batch"] for r in last.filter(F.col("last") >= now.strftime("%Y-%m-%dT%H")).collect()}
    moved = {n for n in loose if n not in still}
    if not moved:
        return 0
    fresh = landing.rows_of(spark, root, layer, dataset, sorted(moved))
    days = [f"date={r[0]}" for r in fresh.select("date").distinct().collect()]
    whole = fresh.unionByName(table.read(spark, days))
    sort = [c for c in ("symbol", "hour") if c in whole.columns]
    notes = [(r, "", PACKED) for r in _ranges(held | moved)] + [(r, "", LEAVING) for r in _ranges(moved)]
    table.write(whole, notes=notes, sort=sort)
    return len(moved)
