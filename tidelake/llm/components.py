"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.session import materialize


def components(edges: DataFrame, label: str = "edges") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b bigint): root is the smallest node of
    its component. Loops and repeated edges are allowed; without edges the result is empty.

    Alternates two steps until the edges are stars. First every node hands its smallest
    neighbour to its larger neighbours, then to its smaller ones and itself. The number of
    rounds grows with the logarithm of the component size. Edges are stored in the shared
    folder after each round, never collected; smallest neighbours are combined before the
    shuffle, and the joins that bring them back to the edges split a node with very many
    neighbours at run time (adaptive execution), as each is a plain join of two tables.
    """
    flat = materialize(
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    state = _state(flat)
    while state[0]:
        both = flat.unionByName(flat.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a != b").distinct()
        )
        large = materialize(large, label)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")
        ).select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
        flat = materialize(small.filter("a != b").distinct(), label)
        before, state = state, _state(flat)
        if state == before:
            break
    roots = flat.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return flat.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Number of edges and two order-free sums over them: equal for equal edge sets."""
    mixed = F.xxhash64("a", "b")
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.shiftright(mixed, 16)), F.sum(mixed.bitwiseAND(0xFFFF))
    ).first()
    return tuple(row)
