"""Running totals, row numbers and percent ranks over orderings of any length.

A window without PARTITION BY, or with a hot partition key, runs in one task. Up to
``SINGLE_TASK_ROWS`` rows that is the cheapest plan. Beyond it the rows are range
partitioned on the whole ordering and stored together with their range number, so each
task sees one range, and what precedes a range is added from a table with at most two
rows per range. Adaptive execution may merge neighbouring ranges, which keeps the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidelake.operators.skew import BROADCAST_ROWS, HOT_ROWS, lookup_join
from tidelake.session import materialize

SINGLE_TASK_ROWS = 200_000
# Values of a histogram that one range, so one task, orders.
ROWS_PER_RANGE = 1_000_000

_RANGE = "_range"


def running_total(
    df: DataFrame,
    measure: str,
    group: list[str],
    order: list[Column],
    total: str = "running",
    group_total: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Inclusive running sum of a bigint ``measure`` per group, in ``order``.

    ``order`` must be unique within the group. ``group`` may be empty, and may contain
    a key that owns most rows. ``ranges`` is best taken from the number of rows, if it is
    known; otherwise there are as many as shuffle partitions, merged where they are small.
    """
    keys = [*[F.col(g) for g in group], *order]
    cut = df.repartitionByRange(*keys) if ranges is None else df.repartitionByRange(ranges, *keys)
    ranged = materialize(cut.withColumn(_RANGE, F.spark_partition_id()), "ranges")
    part = [_RANGE, *group]
    sums = ranged.groupBy(*part).agg(F.sum(measure).alias("_part"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    # A group is contiguous, so a range holds at most two groups that reach beyond it.
    spill = (
        sums.withColumn("_before", F.coalesce(F.sum("_part").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_part").over(whole))
        .filter(F.col("_total") != F.col("_part"))
        .drop("_part")
    )
    for g in group:   # the group may be NULL
        spill = spill.withColumnRenamed(g, f"_g_{g}")
    match = F.col(_RANGE) == F.col("_r")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    local = Window.partitionBy(*part)
    running = local.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (
        ranged.join(F.broadcast(spill.withColumnRenamed(_RANGE, "_r")), match, "left")
        .withColumn(total, F.sum(measure).over(running) + F.coalesce("_before", F.lit(0)))
    )
    if group_total:
        out = out.withColumn(
            group_total, F.coalesce(F.col("_total"), F.sum(measure).over(local))
        )
    return out.drop(_RANGE, "_r", "_before", "_total", *[f"_g_{g}" for g in group])


def row_numbers(
    df: DataFrame,
    order: list[Column],
    group: list[str] | None = None,
    name: str = "row_num",
    group_total: str | None = None,
    single_task: bool = False,
) -> DataFrame:
    """Row number per group in ``order``, exact for groups of any size.

    ``single_task=True`` states that every group is known to be small.
    """
    group = group or []
    if single_task:
        window = Window.partitionBy(*group)
        out = df.withColumn(name, F.row_number().over(window.orderBy(*order)).cast("long"))
        if group_total:
            out = out.withColumn(group_total, F.count(F.lit(1)).over(window))
        return out
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    return running_total(ones, "_one", group, order, name, group_total).drop("_one")


def percent_ranks(
    df: DataFrame,
    key: str,
    metrics: dict[str, str],
    single_task_rows: int = SINGLE_TASK_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    kind: DecimalType = DecimalType(38, 12),
) -> DataFrame:
    """Add one ascending percent rank per entry of ``metrics`` (column -> new column).

    ``key`` must be unique. Ranks follow Spark's rule: NULL sorts first, ties share a
    rank, a single row gets 0. All metrics are compared as ``kind``.

    Many rows are ranked by their values: one histogram holds those of all metrics, is ordered
    by ranges whose number follows its stored size, and gives each value its rank, which a
    join per metric brings to the rows. Rows are never exploded or grouped again; they
    move only where a metric has more different values than can be broadcast.
    """
    df = materialize(df, "rank-input")
    rows = df.count()
    if rows <= single_task_rows:
        ranks = [
            F.percent_rank().over(Window.orderBy(F.col(metric).cast(kind).asc())).alias(name)
            for metric, name in metrics.items()
        ]
        return df.select("*", *ranks)

    # One long frame of values for all metrics, which is aggregated before it moves.
    pairs = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast(kind).alias("value")) for m in metrics
    ]
    long = df.select(F.explode(F.array(*pairs)).alias("_p")).select(
        F.col("_p.metric").alias("metric"),
        F.col("_p.value").isNotNull().alias("known"),   # NULL (false) sorts first
        F.coalesce(F.col("_p.value"), F.lit(0).cast(kind)).alias("value"),
    )
    slot = ["metric", "known", "value"]
    histogram = materialize(long.groupBy(*slot).agg(F.count(F.lit(1)).alias("n")), "histogram")
    ranges = max(1, -(-histogram.count() // ROWS_PER_RANGE))
    upto = running_total(histogram, "n", ["metric"], [F.col("known"), F.col("value")], "upto", ranges=ranges)
    ranked = materialize(
        upto.select(*slot, "n", ((F.col("upto") - F.col("n")) / F.lit(max(rows - 1, 1))).alias("pr")), "ranks")
    for m, name in metrics.items():
        mine = ranked.filter(F.col("metric") == m).select(
            F.col("known").alias("_known"), F.col("value").alias("_value"), F.col("n").alias("_n"), F.col("pr").alias(name))
        here = F.col(m).cast(kind)
        df = lookup_join(
            df.withColumns({"_known": here.isNotNull(), "_value": F.coalesce(here, F.lit(0).cast(kind))}),
            mine, ["_known", "_value"], "_n", broadcast_rows, hot_rows,
        ).drop("_known", "_value")
    return df


def top_n(df: DataFrame, order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows in ``order`` with their rank; only ``n`` rows reach the window."""
    best = df.orderBy(*order).limit(n)
    return best.withColumn(name, F.row_number().over(Window.orderBy(*order)))
