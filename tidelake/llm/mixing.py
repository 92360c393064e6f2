"""Mixing sources to target weights (method: weighted fair queueing).

Every source sends its documents in a fixed shuffled order, ``passes`` times over. The item
that brings a source to c tokens in total has virtual finish time c / weight. Served in the
order of finish times, sources advance in proportion to their weights; one that has sent
all it may drops out, and the rest share what it leaves. Cutting the order at the budget
therefore takes from each source min(passes * size, weight * v) for one common v.
"""

from __future__ import annotations

from functools import reduce
from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators.ranks import running_total
from tidelake.llm.names import join_marked, own_names, row_mark
from tidelake.session import materialize

WORDS = r"[^\x20\x09-\x0D]+"
# Documents of one source and one shuffle block, on average, of the largest source.
BLOCK_ROWS = 100_000
MIN_BLOCKS = 16


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, passes: int) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources in code-point order, NULL last, take ``weights`` in turn. ``share`` of the total
    is divided by weight; no target exceeds ``passes`` times its source. Windows run over
    the list of sources, one row each, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    named = sizes.select("source", "source_size", weight.cast("long").alias("weight"))
    # Sources that fill up at a lower level come first. The level is right at the first
    # source that is not yet full at it.
    full_at = F.col("source_size") * passes / F.col("weight")
    ranked = named.withColumn("_full", full_at).withColumn(
        "_k", F.row_number().over(Window.orderBy("_full", F.col("source").asc_nulls_last()))
    )
    before = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("_k").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * share
        - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * passes
    ) / F.sum("weight").over(rest)
    leveled = ranked.withColumn("_level", level)
    right = F.when(F.col("_level") <= F.col("_full"), F.struct("_k", "_level"))
    return leveled.withColumn("_v", F.min(right).over(everything)["_level"]).select(
        "source", "source_size", "weight",
        F.least(
            (F.col("source_size") * passes).cast("double"),
            F.coalesce(F.col("weight") * F.col("_v"), F.lit(0.0)),
        ).alias("target"),
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, passes: int = 2,
    key: str = "doc_id", source: str = "source", text: str = "text", mark: Column | None = None,
) -> DataFrame:
    """(key, size, source_size, target, taken) for every row of ``docs``, and ``_mark`` if
    ``mark``, a bigint of the row, is given.

    ``size`` is the number of words, ``taken`` the words the mix takes of the document,
    0 to ``passes`` times its size. The total taken stays within ``share`` of all sizes and
    misses it by less than one document, so each source comes within about one document of
    its target. The shuffle order is the MD5 of the key, so reruns agree; equal keys go by
    size and ``mark``, and wholly equal rows are interchangeable.

    NULL text has size 0, NULL sources are one source, a table without words takes nothing.
    Only (key, source, size) leave the scan. Positions within a source are sums within
    (source, block of the MD5) plus the sums of the blocks before; the number of blocks
    follows the largest source, so no source is one task. The order over all sources is a
    range sort with sums per range.
    """
    slim = materialize(
        docs.select(
            F.col(key).alias("key"), F.col(source).alias("source"), word_count(text).alias("size"),
            F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("turn"),
            (F.lit(None).cast("long") if mark is None else mark).alias("mark"),
        ), "mix-sizes",
    )
    totals = materialize(
        slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")),
        "mix-sources",
    )
    facts = totals.agg(F.sum("source_size"), F.max("_rows")).first()
    total, most = facts[0] or 0, facts[1] or 0
    digits = 1
    while 16**digits < max(MIN_BLOCKS, most // BLOCK_ROWS):
        digits += 1
    targets = source_targets(totals.drop("_rows"), weights, share, passes)
    unit = reduce(lcm, weights)

    blocked = slim.withColumn("block", F.substring("turn", 1, digits))
    block_sums = blocked.groupBy("source", "block").agg(F.sum("size").alias("_in_block"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    block_starts = block_sums.select(
        F.col("source").alias("_s"), F.col("block").alias("_b"),
        F.coalesce(F.sum("_in_block").over(earlier), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("source", "block").orderBy("turn", "key", "size", "mark")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = targets.withColumnRenamed("source", "_n")
    timed = materialize(
        blocked.withColumn("_sum", F.sum("size").over(running))
        .join(block_starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
        .join(named, F.col("source").eqNullSafe(F.col("_n")))
        .select(
            "key", "mark", "source", "size", "source_size", "target",
            (F.lit(unit) / F.col("weight")).cast("long").alias("_step"),
            (F.col("_before") + F.col("_sum")).alias("_upto"),
        ), "mix-times",
    )

    def finish(k: int) -> Column:
        return (F.col("_upto") + F.col("source_size") * k) * F.col("_step")

    # One number orders all: finish times of one source differ, and sources that finish
    # together go by name.
    order = [F.col("finish"), F.col("source").asc_nulls_last()]
    items = timed.filter("size > 0").select(
        "source", "size", F.explode(F.array(*[finish(k) for k in range(passes)])).alias("finish")
    )
    last = (
        running_total(items, "size", [], order, "sent")
        .filter(F.col("sent") <= F.lit(int(total * share)))
        .agg(F.max(F.struct("finish", F.col("source").isNull().alias("none"), "source")).alias("cut"))
        .first()["cut"]     # the one place where the order is cut
    )
    if last is None:
        times = F.lit(0)
    else:
        name = F.lit(last["source"]).cast("string")
        # NULL comes last: if it is in, all are
        at_cut = F.lit(True) if last["none"] else F.coalesce(F.col("source") <= name, F.lit(False))
        reached = [
            (finish(k) < F.lit(last["finish"])) | ((finish(k) == F.lit(last["finish"])) & at_cut)
            for k in range(passes)
        ]
        times = reduce(lambda a, b: a + b, [F.when(r, 1).otherwise(0) for r in reached])
    return timed.select(
        F.col("key").alias(key), "size", "source_size", "target",
        (F.col("size") * times).cast("long").alias("taken"),
        *([] if mark is None else [F.col("mark").alias("_mark")]),
    )


@own_names
def mixed(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken, those never taken left
    out. Documents without words are never taken.

    A row is known by its key and its mark (:func:`row_mark`), so rows that share a key, or
    have none, have copies of their own; wholly equal rows have theirs in one. The rows taken
    are joined by the same plan at every size, which shuffles the texts once.
    """
    taken = mix(docs, key=key, mark=row_mark(docs), **options).groupBy(
        F.col(key).alias("_key"), "_mark"
    ).agg(
        F.sum(F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0)).cast("int").alias("_copies"),
        F.count(F.lit(1)).alias("_times"),
    ).filter("_copies > 0")
    taken = materialize(taken, "mix-taken")
    out = join_marked(docs, taken, key)
    rows = out.filter("_times = 1")
    if not taken.filter("_times > 1").isEmpty():
        rows = rows.unionByName(out.filter("_times > 1").dropDuplicates([key, "_mark"]))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(docs.columns)
