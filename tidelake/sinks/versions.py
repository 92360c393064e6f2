"""A table whose partitions are replaced together, behind one published list.

    path/version=<id>/<partition folders>/part-*     rows, never changed once written
    path/<partition folders>/part-*                  rows of a plain dataset that was adopted
    path/_list/…                                     which version of each partition is in force

A writer puts its rows into a new version and then publishes the list that names it for the
partitions it has, by a rename. Readers follow the list they have read: they see all of a
write or nothing of it, and a writer that dies has changed nothing. The partitions that a
write replaces stay until the next one, for readers that have already begun. One writer at a
time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake.operators.filters import strangers
from tidelake.sinks.tables import _files, read_snapshot, replace_snapshot
from tidelake.sources.files import _or_none

# state is "live", "old" (replaced by the last write), or a label of the caller's own notes
LIST = "partition string, version string, state string"
LIVE, OLD = "live", "old"


@dataclass
class Report:
    """What a write has found. ``published`` is False where any count is not 0."""

    found: dict[str, int] = field(default_factory=dict)
    published: bool = True


@dataclass(frozen=True)
class VersionedTable:
    """``partitions`` maps each partition column to its expression over the row."""

    path: str
    schema: StructType
    partitions: dict[str, Column]

    def _stored(self) -> StructType:
        out = StructType(list(self.schema.fields)).add("version", "string")
        for name in self.partitions:
            if name not in out.fieldNames():
                out = out.add(name, "date" if name.endswith("date") else "string")
        return out

    def listed(self, spark: SparkSession) -> list[tuple[str, str, str]]:
        """The published list: a row per partition, which is a folder, and the notes."""
        found = _or_none(lambda: read_snapshot(spark, f"{self.path}/_list", LIST))
        return [] if found is None else [tuple(r) for r in found.collect()]

    def _folders(self, spark: SparkSession, wanted: list[str] | None) -> list[str]:
        keep = None if wanted is None else set(wanted)
        return [
            self._folder(partition, version) for partition, version, state in self.listed(spark)
            if state == LIVE and (keep is None or partition in keep)
        ]

    def _folder(self, partition: str, version: str) -> str:
        return f"{self.path}/version={version}/{partition}" if version else f"{self.path}/{partition}"

    def _rows(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        mine = [f for f in folders if f.startswith(f"{self.path}/version=")]
        adopted = [f for f in folders if not f.startswith(f"{self.path}/version=")]
        out = spark.createDataFrame([], self._stored()).drop("version")
        for part in (mine, adopted):
            if part:
                rows = spark.read.schema(self._stored()).option("basePath", self.path).parquet(*part).drop("version")
                out = rows if part is mine else out.unionByName(rows) if mine else rows
        return out

    def adopt(self, spark: SparkSession) -> int:
        """Publish the partitions of a plain dataset at ``path`` as they lie there, so that later
        writes can replace them together; their number. Nothing is moved. From then on readers
        go through the list."""
        names = "/".join(f"{n}=[^/]+" for n in self.partitions)
        found = self._partitions_below(spark, self.path, f"^.*?/({names})/[^/]+$")
        rows = [(p, "", LIVE) for p in found]
        replace_snapshot(spark.createDataFrame(rows, LIST).coalesce(1), f"{self.path}/_list")
        return len(rows)

    def _partitions_below(self, spark: SparkSession, folder: str, pattern: str) -> list[str]:
        paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
        found = paths.filter(~F.contains("path", F.lit("/version="))) if folder == self.path else paths
        return sorted(r[0] for r in found.select(F.regexp_extract("path", pattern, 1)).distinct().collect() if r[0])

    def read(self, spark: SparkSession, wanted: list[str] | None = None) -> DataFrame:
        """Rows as published, with the partition columns; only the ``wanted`` partitions
        (folders as in :meth:`listed`) if given."""
        return self._rows(spark, self._folders(spark, wanted))

    def write(
        self,
        df: DataFrame,
        checks: dict[str, Column] | None = None,
        audits: dict[str, Callable[[DataFrame], int]] | None = None,
        notes: list[tuple[str, str, str]] | None = None,
        drop: list[str] | None = None,
        sort: list[str] | None = None,
    ) -> Report:
        """Replace the partitions that ``df`` has rows for, and remove those in ``drop``.

        ``checks`` are aggregates that count violations; they are taken while the rows are
        written and cost no pass. ``audits`` get the written rows, for what needs the rows of
        a key together. The list is published only if all of them give 0; otherwise the new
        version is removed and readers stay with the old rows. ``notes`` replace those of the
        list. ``sort`` orders the rows of a file, so that statistics of row groups prune them.
        """
        spark = df.sparkSession
        version, names = uuid.uuid4().hex, list(self.partitions)
        rows = df.select(*[c for c in self.schema.fieldNames()]).withColumns(self.partitions)
        seen = Observation() if checks else None
        if seen is not None:
            rows = rows.observe(seen, *[c.cast("long").alias(n) for n, c in checks.items()])
        folder = f"{self.path}/version={version}"
        dealt = rows.hint("rebalance", *names)
        if sort:
            dealt = dealt.sortWithinPartitions(*names, *sort)
        dealt.write.partitionBy(*names).parquet(folder)
        found = dict(seen.get) if seen is not None else {}
        touched = self._partitions_below(spark, folder, r"/version=[^/]+/(.+)/[^/]+$")
        for name, audit in (audits or {}).items():
            found[name] = int(audit(self._rows(spark, [f"{folder}/{t}" for t in touched])))
        report = Report(found, not any(found.values()))
        if not report.published:
            self._delete(spark, [folder])
            return report
        before, gone = self.listed(spark), {*touched, *(drop or [])}
        live = [r for r in before if r[2] == LIVE]
        after = [r for r in live if r[0] not in gone] + [(t, version, LIVE) for t in touched]
        after += [(p, v, OLD) for p, v, _ in live if p in gone]
        after += notes if notes is not None else [r for r in before if r[2] not in (LIVE, OLD)]
        replace_snapshot(spark.createDataFrame(after, LIST).coalesce(1), f"{self.path}/_list")
        self._delete(spark, [self._folder(p, v) for p, v, state in before if state == OLD])
        return report

    def _delete(self, spark: SparkSession, folders: list[str]) -> None:
        files, at = _files(spark, self.path)
        for folder in folders:
            files.delete(at(folder), True)


def repeated_keys(*keys: str) -> Callable[[DataFrame], int]:
    """An audit that counts keys with more than one row."""
    return lambda rows: rows.groupBy(*keys).count().filter("count > 1").count()


def missing(*columns: str) -> Column:
    """A check that counts rows in which any of these columns is NULL."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return F.count_if(any_null)


def unknown(dim: DataFrame, key: str) -> Callable[[DataFrame], int]:
    """An audit that counts rows whose ``key`` the dimension lacks."""
    return lambda rows: strangers(rows, dim, key).count()


def off_baseline(expected: int, tolerance: float = 0.0001) -> Callable[[DataFrame], int]:
    """An audit that gives 1 if the number of rows is further than ``tolerance`` from ``expected``."""
    return lambda rows: int(abs(rows.count() - expected) > tolerance * expected)
