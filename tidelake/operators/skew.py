"""Joins that hold when one key carries a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest lookup sent to every executor: about 64 MB at 32 bytes per row.
BROADCAST_ROWS = 2_000_000
# A key above this many detail rows is hot: too much for one shuffle partition.
HOT_ROWS = 5_000_000
# Hot keys are broadcast, so their number is bounded too.
MAX_HOT_KEYS = 100_000


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint if ``df`` has been counted and fits; otherwise ``df`` unchanged,
    which leaves the join to a shuffle with adaptive skew splitting.

    Meant for stored tables, whose count is read from file footers.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def lookup_join(
    detail: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    weight: str,
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join of ``detail`` with one ``lookup`` row per key.

    ``lookup`` must be stored (it is read more than once) and ``weight`` must hold the
    number of detail rows of each key. A small lookup is broadcast, so the detail is
    not shuffled at all. A large one is split: hot keys are broadcast (never more than
    ``MAX_HOT_KEYS``, because each of them owns at least its share of all rows) and
    only the remaining keys, none of them hot, are joined by shuffle.
    """
    count, total = lookup.agg(F.count(F.lit(1)), F.sum(weight)).first()
    columns = lookup.drop(weight)
    if count <= max_rows:
        return detail.join(F.broadcast(columns), keys)
    limit = max(hot_rows, (total or 0) // MAX_HOT_KEYS)
    is_hot = F.col(weight) > F.lit(limit)
    hot = lookup.filter(is_hot).drop(weight)
    cold = lookup.filter(~is_hot).drop(weight)
    hot_part = detail.join(F.broadcast(hot), keys)
    cold_part = detail.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return hot_part.unionByName(cold_part)
