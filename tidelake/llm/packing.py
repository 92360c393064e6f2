"""Packing documents into training sequences (method: length-histogram planning).

Best fit decreasing is decided on the histogram of lengths, at most ``capacity`` numbers,
never on documents. Equal bins are handled as one interval of bins, so a plan is a list of
runs: "of length L, ranks a to b go to bins f, f + 1, ... with k in each, from offset o".
Documents then take their planned places by their rank within their length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.arrow import slices, text_buffers
from tidelake.llm.transducers import transducers
from tidelake.session import materialize

# Ranks within a length are counted in this many hash buckets at least, so that a length
# that many pieces share (full pieces above all) is never one task.
RANK_BUCKETS = 64
ROWS_PER_BUCKET = 1_000_000


class Run(NamedTuple):
    length: int
    first_rank: int
    items: int
    per_bin: int
    first_bin: int
    offset: int


def plan(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit-decreasing runs for ``histogram`` (length -> number of pieces).

    A bin that takes one piece stays the best fit for the next of the same length while it
    has room, so bins of one interval take ``room // length`` each. Every length leaves at
    most four intervals more, hence the plan's size depends on ``capacity`` alone.
    """
    rooms: list[int] = []                               # sorted
    intervals: dict[int, list[tuple[int, int]]] = {}    # room -> [(first bin, bins)]
    runs: list[Run] = []
    bins = 0

    def add(room: int, first: int, count: int) -> None:
        if count and room:
            if room not in intervals:
                bisect.insort(rooms, room)
                intervals[room] = []
            intervals[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect.bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, count = intervals[room].pop()
                if not intervals[room]:
                    del intervals[room], rooms[k]
            else:
                room, first = capacity, bins
                count = -(-left // (capacity // length))
                bins += count
            each = room // length
            full = min(count, left // each)
            if full:
                runs.append(Run(length, rank, full * each, each, first, capacity - room))
                add(room - each * length, first, full)
                left, rank = left - full * each, rank + full * each
            if left and full < count:
                runs.append(Run(length, rank, left, left, first + full, capacity - room))
                add(room - left * length, first + full, 1)
                add(room, first + full + 1, count - full - 1)
                left = 0
            else:
                add(room, first + full, count - full)
    return runs


def token_pieces(
    docs: DataFrame, vocab: str, capacity: int = 2048, end_id: int | None = 0,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: key, piece, start, length, ids_crc32.

    A document is its token ids (byte-level BPE file ``vocab``, no special tokens added)
    and ``end_id``, if given. Only longer ones are cut; then the first piece is the shorter
    one. NULL and empty texts are the end id alone, or no piece without one. Equal rows
    give equal pieces. One narrow pass.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducers(vocab)
        for batch in slices(batches, 1):
            ids, owners = machine.encode(*text_buffers(batch.column(1)))
            row, piece, start, length, crc = [], [], [], [], []
            tail = [] if end_id is None else [end_id]
            for i in range(batch.num_rows):
                own = np.append(ids[owners[i]:owners[i + 1]], tail).astype("<u4")
                at, k = 0, 0
                while at < len(own):
                    to = at + ((len(own) - at - 1) % capacity + 1)
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(own[at:to].tobytes()))
                    at, k = to, k + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[key, "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(f"`{key}`", f"`{text}`").mapInArrow(
        cut, f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def pack(pieces: DataFrame, capacity: int = 2048, key: str = "doc_id") -> DataFrame:
    """``pieces`` (of :func:`token_pieces`) plus sequence_id and offset: best fit decreasing.

    The pieces are stored once, without texts. What reaches the driver is the histogram, at
    most ``capacity`` rows; what is sent to the workers is the plan, whose size depends on
    ``capacity`` alone. Ranks are row numbers within (length, hash bucket) plus the counts
    of the buckets before, so no length is one task. Equal pieces may swap their places.
    """
    pieces = materialize(pieces, "pieces")
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    buckets = max(RANK_BUCKETS, -(-max(histogram.values(), default=0) // ROWS_PER_BUCKET))
    # flat arrays, ordered by (length, rank): a place is found by one binary search
    runs = np.array(sorted(plan(histogram, capacity)) or np.zeros((0, 6)), np.int64)
    held = spark.sparkContext.broadcast(runs)

    part = pieces.withColumn(
        # by place in the stored table: equal pieces are spread like all others
        "_bucket", F.pmod(F.xxhash64("_metadata.file_path", "_metadata.row_index"), F.lit(buckets)).cast("int")
    )
    sizes = part.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("length", "_bucket").orderBy(key, "piece", "start", "ids_crc32")
    ranked = part.withColumn("_row", F.row_number().over(inside)).join(
        offsets, ["length", "_bucket"]
    ).select(*pieces.columns, (F.col("_before") + F.col("_row") - 1).alias("_rank"))

    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        # one sortable number for (length, rank); ranks stay below 2^50
        starts = (table[:, 0] << 50) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(starts, (length << 50) + rank, side="right") - 1
            _, first_rank, _, per_bin, first_bin, offset = table[at].T
            step = rank - first_rank
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(first_bin + step // per_bin),
                 pa.array(offset + step % per_bin * length)],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, vocab: str, capacity: int = 2048, **options) -> DataFrame:
    """All documents in as few sequences of ``capacity`` tokens as best fit finds."""
    key = options.get("key", "doc_id")
    return pack(token_pieces(docs, vocab, capacity, **options), capacity, key)
