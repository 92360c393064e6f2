"""Target-distribution importance resampling (method: array-scored weights, then bisection of a
numeric threshold).

Runs of one to three words are hashed into buckets. A bucket's gain is the logarithm of how
much more frequent it is in the target texts than in the documents; a document's weight is the
sum over its runs. Scores are weights plus Gumbel noise drawn from the key, so the highest
scores are a sample without replacement, proportional to the weights' exponentials. The lowest
score drawn is found by counting stored scores above ever closer thresholds, the last key
drawn among equal scores likewise; only the drawn rows are ordered, by ranges.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.arrow import slices, text_buffers
from tidelake.session import materialize

BUCKETS = 10_000
SCALE = 1000                # scores are integers of 1/1000
PROBES = 31                 # thresholds counted by one job: an interval shrinks 32-fold
POLYNOMIAL = 0xEDB88320     # of CRC-32, as in zlib (fixed value)
TABLED = 64                 # longest piece that is appended by tables

# Everything but ASCII letters and digits, and bytes of other characters, separates words.
_SEPARATED = bytes(b if b >= 128 or b < 128 and chr(b).isalnum() else 32 for b in range(256))


class _Numbers(dict):
    """Running numbers of different words."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _append_tables() -> np.ndarray:
    """What n further zero bytes make of a CRC-32, by n and by each of its four bytes.

    CRC-32 is linear: crc(A B) is crc(A) carried over len(B) zero bytes, xor crc(B).
    """
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1).astype(np.uint32)
    out = np.empty((TABLED + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(TABLED):
        out[n + 1] = (out[n] >> 8) ^ one[out[n] & 255]
    return out.reshape(-1)


class Hasher:
    """Bucket numbers of all runs of one to three words of texts."""

    def __init__(self, buckets: int = BUCKETS) -> None:
        self.buckets = np.uint32(buckets)
        self.tables = _append_tables()

    def _append(self, before: np.ndarray, ids: np.ndarray, crc: np.ndarray, size: np.ndarray,
                words: list[bytes]) -> np.ndarray:
        """CRC-32 of what has ``before``, a space, and the words ``ids``."""
        n = size[ids]
        at = np.minimum(n, TABLED) * 1024
        out = crc[ids]
        for k in range(4):
            out ^= self.tables[at + (256 * k + ((before >> np.uint32(8 * k)) & np.uint32(255))).astype(np.int64)]
        for i in np.flatnonzero(n > TABLED).tolist():
            out[i] = zlib.crc32(b" " + words[ids[i]], int(before[i]))
        return out

    def runs(self, column: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Number of words of each text, and for runs of 1, 2 and 3 words their buckets, text
        after text, and the number of runs of each text."""
        data, offsets = text_buffers(column)
        raw = data.tobytes().lower().translate(_SEPARATED)
        numbers, parts = _Numbers(), []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            words = raw[a:b].split()
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        sizes = np.array([len(p) for p in parts], np.int64)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        words = list(numbers)
        first = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        after = np.fromiter((zlib.crc32(b" " + w) for w in words), np.uint32, len(words))
        length = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(ids))     # words from here on
        crc, out = first[ids], []
        for n in (1, 2, 3):
            if n > 1:       # runs of n - 1 words that another word follows
                more = np.flatnonzero(left >= n)
                crc = self._append(crc[left[left >= n - 1] >= n], ids[more + n - 1], after, length, words)
            out.append(((crc % self.buckets).astype(np.int64), np.maximum(sizes - (n - 1), 0)))
        return sizes, out


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket is met in all texts. A task counts what it reads in one array
    before anything is shuffled; the driver gets one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, n = Hasher(buckets), np.zeros(buckets, np.int64)
        for batch in slices(batches, 0):
            for found, _ in hasher.runs(batch.column(0))[1]:
                n += np.bincount(found, minlength=buckets)
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(n[there])], names=["b", "n"])

    out = np.zeros(buckets, np.int64)
    rows = texts.select(F.col(f"`{text}`")).mapInArrow(count, "b int, n bigint").groupBy("b").agg(F.sum("n")).collect()
    for b, n in rows:
        out[b] = n
    return out


def gains(seen: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: 1000 times the logarithm of its smoothed share in the target over that in
    the documents, rounded down."""
    n = len(seen)
    s, t = float(seen.sum() + n), float(target.sum() + n)
    return np.array([
        math.floor(SCALE * math.log((float(b) + 1) * s / ((float(a) + 1) * t)))
        for a, b in zip(seen.tolist(), target.tolist())
    ], np.int64)


def noise(key: str, seed: int = 42) -> Column:
    """Gumbel noise times 1000, rounded down, from SHA-256 of ``seed:key`` (NULL as empty)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000.0 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def _reach(rows: DataFrame, value: Column, wanted: int) -> int | None:
    """The largest v for which ``wanted`` rows or more have ``value`` >= v, by exact counts; None
    if fewer rows have a value at all. Each job counts ``PROBES`` thresholds at once."""
    low, high, n = rows.agg(F.min(value), F.max(value), F.count(value)).first()
    if n < wanted:
        return None
    high += 1           # too few from here on
    while high - low > 1:
        steps = min(PROBES + 1, high - low)
        probes = [low + (high - low) * i // steps for i in range(1, steps)]
        found = rows.agg(*[F.count_if(value >= F.lit(p)) for p in probes]).first()
        enough = sum(c >= wanted for c in found)
        low, high = [low, *probes][enough], [*probes, high][enough]
    return low


def draw(scored: DataFrame, wanted: int, key: str = "_key", score: str = "score") -> tuple[Column, int]:
    """A condition for the ``wanted`` highest scores of stored rows, ties to smaller keys, and
    how many rows meet it: more than wanted only where the last score and key are repeated.
    Rows with a NULL key come after others of their score. ``key`` is an integer."""
    # NOT turns the order of integers round, the smallest bigint's too
    s, turned = F.col(score), F.bitwise_not(F.col(key).cast("bigint"))
    least = _reach(scored, s, wanted) if wanted else None
    if least is None:
        return (F.lit(False), 0) if not wanted else (F.lit(True), scored.count())
    above = scored.filter(s > F.lit(least)).count()
    tied = scored.filter(s == F.lit(least))
    last = _reach(tied, turned, wanted - above)
    taken = s > F.lit(least)
    if last is None:
        taken = taken | (s == F.lit(least))
    else:
        taken = taken | (s == F.lit(least)) & F.coalesce(turned >= F.lit(last), F.lit(False))
    return taken, scored.filter(taken).count()


def ranked(drawn: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``drawn`` with 1, 2, 3, ... in ``order``: rows are range-partitioned, sorted and stored,
    and each range starts where the counted ones before it end."""
    sorted_rows = drawn.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(sorted_rows.withColumn(name, F.monotonically_increasing_id()), "drawn")
    part = F.shiftrightunsigned(F.col(name), 33).cast("int")
    counts = dict(stored.groupBy(part.alias("p")).count().collect())     # a row per range
    starts = np.zeros(max(counts, default=0) + 1, np.int64)
    for p, n in counts.items():
        starts[p] = n
    starts = np.cumsum(starts) - starts
    inside = F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
    return stored.withColumn(name, F.get(F.lit(starts), part) + inside + 1)


def importance_resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
    key: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS,
) -> DataFrame:
    """(key, n_features, weight, score, rank) for every row of ``docs``; of those with at least
    ``least_words`` words, ``percent`` per cent (rounded down) have a rank, the others NULL.

    Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z
    lower-cased; NULL and empty texts have none: weight 0, never drawn. Ties go to smaller
    keys; rows that share score and key are ranked by their number of features, then by their
    place in the stored table. A NULL key counts as an empty one for its noise and as the
    largest for ties. Empty tables give no rows; without target texts all buckets count as
    smoothed. Other columns of ``docs`` play no part, whatever their names. ``key`` must be an
    integer. Texts are read twice and never shuffled; scores are stored in the shared folder.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    kind = docs.schema[key].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(buckets)
        for batch in slices(batches, 1):
            sizes, found = hasher.runs(batch.column(1))
            n, weight = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for bucket, runs in found:
                total, end = np.concatenate([[0], np.cumsum(gain[bucket])]), np.cumsum(runs)
                weight += total[end] - total[end - runs]
                n += runs
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(n), pa.array(weight)],
                names=["_key", "_words", "n_features", "weight"])

    slim = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    scored = materialize(
        slim.mapInArrow(weigh, f"_key {kind}, _words bigint, n_features bigint, weight bigint")
        .withColumn("score", F.col("weight") + noise("_key", seed)), "scored")
    enough = F.col("_words") >= least_words
    wanted = percent * scored.filter(enough).count() // 100
    taken, _ = draw(scored.filter(enough), wanted)
    taken = taken & enough
    columns = ["_key", "n_features", "weight", "score"]
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    drawn = ranked(
        scored.filter(taken).select(*columns, *place),
        [F.desc("score"), F.asc_nulls_last("_key"), F.asc("n_features"), F.asc("_file"), F.asc("_row")])
    first = drawn.select(*columns, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    rest = scored.filter(~taken).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return first.unionByName(rest).withColumnRenamed("_key", key)
