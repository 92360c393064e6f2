"""SimHash near-duplicates (method: segment-popcount embedding)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.arrow import slices, text_buffers
from tidelake.llm.components import components
from tidelake.llm.names import join_marked, own_names, row_mark
from tidelake.session import materialize

FIELDS = 32     # segments of two bits, whose bit counts fit into the same two bits
MASK = 0x5555555555555555
SHINGLES_AT_ONCE = 1 << 16


def simhash(words: list[bytes], size: int, seed: int) -> int:
    """Fingerprint of a word sequence: bit i is set if it is in over half the XXH64 of its
    shingles. Fewer than ``size`` words are one shingle; no words give 0."""
    if not words:
        return 0
    shingles = zip(*(words[k:] for k in range(size))) if len(words) >= size else [words]
    n = max(1, len(words) - size + 1)
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(seed)), np.uint64, n
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = hashes[at:at + SHINGLES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, size: int = 3, seed: int = 42, key: str = "doc_id", text: str = "text",
    mark: Column | None = None,
) -> DataFrame:
    """(key, fp bigint) of whole texts; A-Z lower-cased, words between ASCII white space.
    With ``mark``, a bigint of the row, (key, mark, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            data, offsets = text_buffers(batch.column(1))
            raw = data.tobytes()
            fps = [simhash(raw[a:b].lower().split(), size, seed)
                   for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(fps, pa.int64())],
                names=[key, *batch.schema.names[2:], "fp"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(f"`{key}`", f"`{text}`", *([] if mark is None else [mark.alias("mark")]))
    marks = "" if mark is None else "mark bigint, "
    return rows.mapInArrow(run, f"`{key}` {kind}, {marks}fp bigint")


def _embedding(fp: Column) -> Column:
    """The bit counts of the 32 two-bit segments, two bits each, in one bigint."""
    mask = F.lit(MASK)
    low, high = fp.bitwiseAND(mask), F.shiftrightunsigned(fp, 1).bitwiseAND(mask)
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _cells(fps: DataFrame) -> DataFrame:
    """Each fingerprint in the grid cell of its embedding and all cells one step away.

    Two points at Manhattan distance 2 or less share such a cell: a path between them has a
    middle one step from both. In two-bit fields a step is an XOR: 01 turns 0 and 1 into
    each other, 11 does so for 1 and 2.
    """
    here = fps.select("fp", _embedding(F.col("fp")).alias("at")).withColumn(
        "k", F.explode(F.sequence(F.lit(0), F.lit(2 * FIELDS)))
    )
    field = F.expr("shiftrightunsigned(at, 2 * ((k - 1) % 32)) & 3")
    allowed = (
        F.when(F.col("k") == 0, F.lit(True))
        .when(F.col("k") <= FIELDS, field < 2)
        .otherwise(field > 0)
    )
    step = F.expr(f"""CASE WHEN k = 0 THEN 0L WHEN k <= {FIELDS} THEN shiftleft(1L, 2 * (k - 1))
                           ELSE shiftleft(3L, 2 * (k - 1 - {FIELDS})) END""")
    return here.filter(allowed).select(F.col("at").bitwiseXOR(step).alias("cell"), "fp")


def near_pairs(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of different values of ``fps`` (fp, no repeats) that differ in one or two
    bits, each pair once.

    The Manhattan distance of the embeddings never exceeds the Hamming distance. So the join
    runs on grid cells and tests each candidate exactly in its condition; only true pairs
    leave it. A value has at most 65 cells and 2080 partners, whatever the data. The join is
    always one by sorting: Spark takes cells for as few as the values they are made of, and
    would broadcast some 50 times what it expects.
    """
    cells = _cells(fps).hint("merge")
    left, right = cells.toDF("cell", "a"), cells.toDF("cell", "b")
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return left.join(
        right, (left["cell"] == right["cell"]) & (F.col("a") < F.col("b")) & (differ <= 2)
    ).select("a", "b").distinct()


def _rooted(nodes: DataFrame) -> DataFrame:
    """(fp, first, root): stored (fp, first) with a name of the component."""
    roots = components(near_pairs(nodes.select("fp")))
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame, size: int = 3, seed: int = 42, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, fingerprint, component_id) for every row of ``docs``.

    Fingerprints are linked at two or fewer differing bits; ``component_id`` is the smallest
    key reachable over links. Copies share one fingerprint and are one node, so groups of any
    size cost one row each. Fingerprint zero (no words) is linked like any other. Rows with
    equal keys keep their own fingerprints. Fingerprints and components are stored in the
    shared folder; the last join splits hot fingerprints at run time.
    """
    marked = materialize(fingerprints(docs, size, seed, key, text), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min(key).alias("first")), "nodes")
    named = _rooted(nodes)
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = materialize(named.join(smallest, "root").select("fp", "component_id"), "classes")
    return marked.join(classes, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@own_names
def without_near_duplicates(
    docs: DataFrame, size: int = 3, seed: int = 42, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest key, NULL last, and among
    rows of that key the one of the smallest mark.

    A row is known by its key and its mark (:func:`row_mark`), so rows that share a key, or
    have none, are told apart; wholly equal rows are one. The kept rows are joined by the
    same plan at every size, which shuffles the texts once.
    """
    marked = materialize(fingerprints(docs, size, seed, key, text, row_mark(docs)), "fingerprints")
    rows = marked.groupBy(F.col(key).alias("key"), "mark", "fp").agg(F.count(F.lit(1)).alias("times"))
    first = F.struct(F.col("key").isNull().alias("none"), "key", "mark", "times")
    nodes = materialize(rows.groupBy("fp").agg(F.min(first).alias("first")), "nodes")
    keep = materialize(
        _rooted(nodes).groupBy("root").agg(F.min("first").alias("first")).select(
            F.col("first.key").alias("_key"), F.col("first.mark").alias("_mark"),
            F.col("first.times").alias("_times")),
        "kept",
    )
    out = join_marked(docs, keep, key)
    single = out.filter("_times = 1").select(docs.columns)
    if keep.filter("_times > 1").isEmpty():
        return single
    return single.unionByName(
        out.filter("_times > 1").dropDuplicates([key, "_mark"]).select(docs.columns)
    )
