"""Filter interaction audit (method: counting-Bloom prepass, then additive mask counts).

Each document gets a mask of the filters it fails. Four filters look at the text alone. The
fifth, the exact repeat, needs other documents: every task enters its texts' hashes in a
counting Bloom sketch, the sketches are merged, and a text with a counter of 1 is certainly
unique. Only the others are shuffled, whole, to find the smallest id of each text. Masks are
counted, and as removal in any order only depends on the mask, all orders are filled in from
these counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.arrow import slices, text_buffers
from tidelake.session import materialize

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 100, 80, 10    # words, per cent, per cent
UPPER = bytes(range(ord("A"), ord("Z") + 1))
ODD = re.compile(rb"[#$%&*|]")
REPEATED = 1 << FILTERS.index("E")

COUNTERS_PER_TEXT = 16      # or up to twice as many
HASHES = 3
SEGMENTS = 64               # a sketch is merged in so many parts
MAX_BITS = 1 << 30          # of the merged filter, which is broadcast: 128 MB


def own_mask(raw: bytes) -> int:
    """Filters A to D that a text fails, as bits 0 to 3."""
    words = raw.split()
    points = len(raw) if raw.isascii() else len(raw.decode())
    upper = len(raw) - len(raw.translate(None, UPPER))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * upper > MOST_UPPER * points) << 2
        | (ODD.search(raw) is not None) << 3
    )


def counters(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The ``HASHES`` counters of each hash, from 0 to bits - 1 (a power of two)."""
    x = hashes.astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    a, b = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return np.stack([(a + np.uint64(i) * b) & np.uint64(bits - 1) for i in range(HASHES)]).astype(np.int64)


def repeat_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """One bit per counter of the merged sketch: whether it has counted more than one text.

    A task's sketch holds the counters it has met, each with 1 or 2 for more, in parts by
    segment; parts of a segment are added up by one task. The driver gets ``bits`` / 8 bytes.
    """
    size = bits // SEGMENTS

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            met, n = np.unique(counters(h, bits), return_counts=True)
            edges = np.searchsorted(met, np.arange(SEGMENTS + 1) * size)
            there = [s for s in range(SEGMENTS) if edges[s + 1] > edges[s]]
            pack = [(met[edges[s]:edges[s + 1]] - s * size).astype(np.int64) << 1 | (n[edges[s]:edges[s + 1]] > 1) for s in there]
            yield pa.RecordBatch.from_arrays(
                [pa.array(there, pa.int32()), pa.array([p.astype(np.uint32).tobytes() for p in pack], pa.binary())],
                names=["segment", "met"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, met in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = own.setdefault(s, np.zeros(size, np.uint8))
                pack = np.frombuffer(met, np.uint32)
                at = (pack >> 1).astype(np.int64)
                n[at] = np.minimum(n[at] + 1 + (pack & 1).astype(np.uint8), 2)
        for s, n in own.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([np.packbits(n > 1, bitorder="little").tobytes()], pa.binary())],
                names=["segment", "bits"])

    parts = hashes.mapInArrow(sketch, "segment int, met binary").repartition(SEGMENTS, "segment")
    out = np.zeros((SEGMENTS, size // 8), np.uint8)
    for r in parts.mapInArrow(merge, "segment int, bits binary").collect():
        out[r["segment"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def possible_repeats(hashes: DataFrame, max_bits: int = MAX_BITS):
    """A function from a hash column to a condition that holds for every hash met twice or more,
    and for few others. ``hashes`` is a stored column of bigints.

    The filter has ``COUNTERS_PER_TEXT`` bits per text or up to twice as many; beyond
    ``max_bits`` it stays at that size, so ever fewer texts are cleared, none wrongly.
    """
    bits = 1 << max(16, (hashes.count() * COUNTERS_PER_TEXT - 1).bit_length())
    bits = min(bits, max_bits)
    held = hashes.sparkSession.sparkContext.broadcast(repeat_filter(hashes, bits))

    def probe(h: pd.Series) -> pd.Series:
        at = counters(h.to_numpy(np.int64).view(np.uint64), bits)
        return pd.Series((held.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=0))

    return F.pandas_udf(probe, "boolean")


def masks(
    docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", max_bits: int = MAX_BITS,
) -> DataFrame:
    """(_key, _part, _mask, n): failed filters of all rows, equal rows counted together."""
    h = F.xxhash64("_text")
    slim = docs.select(
        F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("_part"))
    kind = docs.schema[key].dataType.simpleString()

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            data, offsets = text_buffers(batch.column(1))
            raw = data.tobytes()
            own = [own_mask(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(own, pa.int32())],
                names=["_key", "_part", "_hash", "_mask"])

    flags = materialize(
        slim.select("_key", "_text", "_part", h.alias("_hash"))
        .mapInArrow(flag, f"_key {kind}, _part string, _hash bigint, _mask int"), "flags")
    maybe = possible_repeats(flags.select("_hash"), max_bits)
    # the smallest key of each possibly repeated text; copies are combined before the shuffle
    least = materialize(
        slim.select("_key", "_text").filter(maybe(h)).groupBy("_text").agg(F.min("_key").alias("_least"))
        .filter(F.col("_least").isNotNull()).select(h.alias("_h"), "_least"), "least")
    rows = flags.withColumn("_maybe", maybe("_hash")).groupBy("_key", "_part", "_hash", "_mask", "_maybe").agg(
        F.count(F.lit(1)).alias("n"))
    known = ["_key", "_part", "_mask", "n"]
    keyed = rows.filter("_key IS NOT NULL")
    # of the rows of one text only those of the smallest key are no repeats
    first = keyed.join(least, (F.col("_hash") == F.col("_h")) & (F.col("_key") == F.col("_least")), "left")
    keyed = first.withColumn(
        "_mask", F.col("_mask").bitwiseOR(F.when(F.col("_maybe") & F.col("_least").isNull(), REPEATED).otherwise(0)))
    # rows without a key come after all others of their text
    unkeyed = rows.filter("_key IS NULL").join(least.select("_h").distinct(), F.col("_hash") == F.col("_h"), "left")
    unkeyed = unkeyed.withColumn(
        "_mask", F.col("_mask").bitwiseOR(F.when(F.col("_h").isNotNull(), REPEATED).otherwise(0)))
    return keyed.select(known).unionByName(unkeyed.select(known))


def every_order(counts: DataFrame) -> DataFrame:
    """From (part, mask, n, good, toxic) to one row per part, filter order and step."""
    orders = [x.decode() for x in map(bytes, permutations(FILTERS.encode()))]
    failed = F.concat(*[
        F.when(F.col("mask").bitwiseAND(1 << i) != 0, c).otherwise("") for i, c in enumerate(FILTERS)])
    steps = (
        counts.withColumn("failed", failed)
        .select("*", F.explode(F.array(*map(F.lit, orders))).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    )
    letter = F.expr("substring(filter_order, step, 1)")
    # filters before this one that the mask fails
    before = F.expr("translate(failed, substring(filter_order, step, 5), '')")
    fails, gone = F.contains(F.col("failed"), letter), before != ""
    only = F.col("failed") == letter
    share = (F.lit(len(orders)) / F.length("failed")).cast("long")     # orders in which it is first

    def total(condition: Column, what: str | Column) -> Column:
        return F.sum(F.when(condition, what).otherwise(0)).cast("long")

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone, F.col("n")).alias("kept"),
        total(fails & ~gone, F.col("n")).alias("removed"),
        total(fails & gone, F.col("n")).alias("redundant"),
        total(only, F.col("n")).alias("unique_fails"),
        total(fails & ~gone, F.col("good")).alias("good_lost"),
        total(fails & ~gone, F.col("toxic")).alias("toxic_lost"),
        total(fails, F.col("n") * share).alias("shapley"),
    )


def filter_audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley): what each filter does to each part in every order of the five.

    A: under 100 words; B: under 80 % different words; C: over 10 % letters A-Z; D: any of
    ``#$%&*|``; E: the text of a row with a smaller key. Words are runs of other bytes than
    ASCII blanks. NULL text is an empty one, NULL part an empty string. Rows with one key and
    one text are no repeats of each other; a NULL key is larger than any other, and rows without
    a key are no repeats of each other either. A key is good or toxic if any of its labels says
    so; labels without a key or a document, and NULL ones, play no part. Empty ``docs`` give no
    rows. Other columns, whatever their names, play no part.

    Texts are read twice; only those that may be repeats are shuffled, once, and what is joined
    to them afterwards are keys and hashes (64 bits of XXH64 with the key stand for a text
    whose smallest key is known).
    """
    marks = labels.select(
        F.col(f"`{key}`").alias("_label"), (F.col("quality") == 1).cast("int").alias("_good"),
        (F.col("toxic") == 1).cast("int").alias("_toxic"),
    ).filter("_label IS NOT NULL AND (_good = 1 OR _toxic = 1)").groupBy("_label").agg(
        F.max("_good").alias("_good"), F.max("_toxic").alias("_toxic"))
    rows = masks(docs, key, text, part, max_bits)
    marked = rows.join(marks, F.col("_key") == F.col("_label"), "left")
    counts = marked.groupBy(F.col("_part").alias("part"), F.col("_mask").alias("mask")).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("_good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("_toxic", F.lit(0))).alias("toxic"))
    return every_order(counts)
