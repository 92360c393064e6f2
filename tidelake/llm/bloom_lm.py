"""Language-model scoring (method: log-frequency Bloom filter).

The filter holds n-grams with quantised counts: an n-gram of class q, which rises with the
logarithm of its count, is entered with the numbers 1 to q. Its class is read back by
probing 1, 2, ... until one is missing. Errors only ever make a class larger.

    P(w | v) = share * c(v, w) / c(v) + (1 - share) * P(w)
    P(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))

with counts from the filter, where a class stands for the mean count of its members.

The filter grows with the entries. It is built by segments, which n-grams' hashes name, and
broadcast in pieces of a stated size. A task reduces some texts to their different n-grams and
asks the pieces one after the other, so that no process holds more than one of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.arrow import text_buffers
from tidelake.session import materialize

END, BEGIN = b" ", b"  "            # no word holds a space
HALF_STEPS = 2                      # classes per factor two
HASHES = 4                          # bits of an entry
BITS_PER_ENTRY = 8
SEGMENTS = 256                      # an n-gram's bits lie in one segment, named by its hash
SEGMENT_BITS = 1 << 23              # 1 MB: from there on segments become more, not larger
SEGMENTS_PER_TASK = 8               # filled at once, on average; a bit takes a byte meanwhile
MAX_FREQUENT = 200_000              # words whose exact counts are broadcast, 16 bytes each
BLOCK = 4 << 20                     # bytes of text handled at once
SCORED = 2 << 20                    # the same where they are scored
SWEPT = 64 << 20                    # bytes of text that ask each piece of the filter together
PIECE_BITS = 1 << 29                # of the filter in one broadcast: 64 MB
PACKS = 1 << 14                     # ranges of hashes by which counts are shuffled, some 600 bytes of a block each
PROBED = 1 << 18                    # n-grams probed at once
UNIGRAM, BIGRAM = 1, 2


class _Numbers(dict):
    """Running numbers of different words."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


@dataclass
class Block:
    """Some rows of a batch as numbers of their tokens: words, then the end."""

    first: int              # first row in the batch
    ids: np.ndarray         # token numbers of all rows
    ends: np.ndarray        # end of each row in ``ids``
    hashes: np.ndarray      # by token number, uint64


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[Block]:
    """Rows of a text column in blocks of about ``size`` bytes; a text is never divided."""
    data, offsets = text_buffers(column)
    raw, at = data.tobytes(), 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        numbers, parts = _Numbers({BEGIN: 0, END: 1}), []
        for a, b in zip(offsets[at:to].tolist(), offsets[at + 1:to + 1].tolist()):
            words = raw[a:b].lower().split()
            words.append(END)
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
        yield Block(at, np.concatenate(parts), np.cumsum([len(p) for p in parts]), hashes)
        at = to


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def unigram_keys(hashes: np.ndarray) -> np.ndarray:
    return _mixed(hashes)


def bigram_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(left + np.uint64(0x9E3779B97F4A7C15)) + right)


def _pairs(block: Block) -> np.ndarray:
    """Bigrams as left number << 32 | right number; the first left one is the beginning."""
    left = np.empty_like(block.ids)
    left[0], left[1:] = 0, block.ids[:-1]
    left[block.ends[:-1]] = 0
    return left << 32 | block.ids


def fold(key: str) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5


def ngram_counts(docs: DataFrame, text: str = "text", least: int = 2) -> DataFrame:
    """(kind, h, n): all words with their counts, and bigrams that occur ``least`` times or more.

    Counts are made per block of texts first. They are shuffled in packs: a block gives one row
    for each of ``PACKS`` ranges of hashes, with its keys and counts as bytes, and a task merges
    the flat arrays of its ranges. No key has more entries than there are blocks.
    """
    packed = pa.schema([("pack", pa.int32()), *[(f"{x}{k}", pa.binary()) for k in (UNIGRAM, BIGRAM) for x in "hn"]])

    def pack(keys: np.ndarray, n: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        where = (keys >> np.uint64(64 - PACKS.bit_length() + 1)).astype(np.uint16)
        order = np.argsort(where, kind="stable")
        ends = np.searchsorted(where[order], np.arange(PACKS), side="right").tolist()
        keys, n = keys[order].tobytes(), n[order].astype(np.int32).tobytes()
        cuts = list(zip([0, *ends], ends))
        return [keys[8 * i:8 * j] for i, j in cuts], [n[4 * i:4 * j] for i, j in cuts]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                single = np.bincount(block.ids, minlength=len(block.hashes))
                there = np.flatnonzero(single)
                pairs, n = np.unique(_pairs(block), return_counts=True)
                keys = bigram_keys(block.hashes[pairs >> 32], block.hashes[pairs & 0xFFFFFFFF])
                columns = [*pack(unigram_keys(block.hashes[there]), single[there]), *pack(keys, n)]
                some = [i for i in range(PACKS) if columns[0][i] or columns[2][i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), *[pa.array([c[i] for i in some], pa.binary()) for c in columns]],
                    schema=packed)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[bytes]] = {name: [] for name in packed.names[1:]}
        for batch in batches:
            for name, own in parts.items():
                own.append(b"".join(batch.column(name).to_pylist()))
        for k in (UNIGRAM, BIGRAM):
            h = np.frombuffer(b"".join(parts.pop(f"h{k}")), np.int64)
            n = np.frombuffer(b"".join(parts.pop(f"n{k}")), np.int32)
            keys, at = np.unique(h, return_inverse=True)
            total = np.bincount(at, n, len(keys)).astype(np.int64)
            if k == BIGRAM:
                keys, total = keys[total >= least], total[total >= least]
            for i in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys[i:i + 100_000]), k, np.int8)),
                     pa.array(keys[i:i + 100_000]), pa.array(total[i:i + 100_000])],
                    names=["kind", "h", "n"])

    schema = "kind tinyint, h bigint, n bigint"
    counted = docs.select(f"`{text}`").mapInArrow(count, "pack int, h1 binary, n1 binary, h2 binary, n2 binary")
    return counted.repartition("pack").mapInArrow(merge, schema)


def _class(n: np.ndarray, least: int) -> np.ndarray:
    """Class of counts: 1 from ``least`` on, two more for each doubling, 0 below."""
    q = np.floor(np.log2(np.maximum(n, 1) / least) * HALF_STEPS + 1e-9).astype(np.int64) + 1
    return np.where(n >= least, q, 0)


def _places(keys: np.ndarray, number: int, segment_bits: int) -> list[np.ndarray]:
    """Bits, within its segment, of each key entered with ``number``."""
    x = _mixed(keys ^ np.uint64(number * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    a, b = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return [((a + np.uint64(i) * b) & np.uint64(segment_bits - 1)).astype(np.int64) for i in range(HASHES)]


def _segment(keys: np.ndarray, segments: int) -> np.ndarray:
    """Segments of keys: the first bits of the hash, so keys in order have theirs in order."""
    return (keys >> np.uint64(65 - segments.bit_length())).astype(np.int64)


@dataclass
class Model:
    """What scoring needs; all but ``bits`` is bounded, most of it by MAX_FREQUENT."""

    tokens: int                 # N
    different: int              # V
    cut: dict[int, int]         # least count in the filter, by kind
    means: dict[int, np.ndarray]    # mean count of a class, by kind; class 0 is 0
    segments: int               # a power of two
    segment_bits: int           # of each, a power of two
    frequent: np.ndarray        # keys of frequent words, sorted
    counts: np.ndarray          # their exact counts
    share: float
    bits: np.ndarray | None = None  # segments x bytes, where all of them are held (build)

    def classes(self, keys: np.ndarray, kind: int, bits: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Classes of keys by the rows of ``bits`` that hold their segments."""
        q = np.zeros(len(keys), np.uint8)
        alive = np.arange(len(keys))
        for number in range(1, len(self.means[kind])):
            key, at = keys[alive], row[alive]
            held = np.ones(len(alive), bool)
            for place in _places(key + np.uint64(kind), number, self.segment_bits):
                held &= (bits[at, place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            alive = alive[held]
            if not len(alive):
                break
            q[alive] = number
        return q

    def quantised(self, keys: np.ndarray, kind: int) -> np.ndarray:
        """Counts as the filter tells them."""
        return self.means[kind][self.classes(keys, kind, self.bits, _segment(keys, self.segments))]

    def floor(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.5) / (self.tokens + 0.5 * (self.different + 1))

    def exact(self, keys: np.ndarray) -> np.ndarray:
        """Exact counts of frequent words, -1 for others."""
        if not len(self.frequent):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.frequent, keys), len(self.frequent) - 1)
        return np.where(self.frequent[at] == keys, self.counts[at], -1)

    def log10(self, single: np.ndarray, both: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """log10 P of ``right`` given ``left``, from the classes of words and of the pairs."""
        single = self.means[UNIGRAM][single]
        before = single[left]
        follows = np.where(before > 0, np.minimum(self.means[BIGRAM][both], before) / np.maximum(before, 1), 0)
        return np.log10(self.share * follows + (1 - self.share) * self.floor(single[right]))


def build(counts: DataFrame, **options) -> Model:
    """:func:`plan` with all segments of the filter in ``bits``: for corpora of which one
    process can hold the filter. Scoring does not use it."""
    model, segments = plan(counts, **options)
    model.bits = np.zeros((model.segments, model.segment_bits // 8), np.uint8)
    for r in segments.collect():
        model.bits[r["segment"]] = np.frombuffer(r["bits"], np.uint8)
    return model


def plan(counts: DataFrame, share: float = 0.1, max_bits: int | None = None,
         max_frequent: int = MAX_FREQUENT, least: int = 2) -> tuple[Model, DataFrame]:
    """The model from stored :func:`ngram_counts`, and its filter: (segment, bits).

    The filter has ``BITS_PER_ENTRY`` bits per entry or up to twice as many, whatever their
    number; a segment has ``SEGMENT_BITS`` at most, and segments without entries are left out.
    Only where ``max_bits`` is given and more would be needed, the least count of an n-gram in
    it is doubled until the entries fit. The driver gets one row per class and the exact
    counts of at most ``max_frequent`` words.
    """
    doubling = F.floor(F.log2("n") * HALF_STEPS + 1e-9).cast("int")
    table = counts.groupBy("kind", doubling.alias("k")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("sum")).collect()
    tokens = sum(r["sum"] for r in table if r["kind"] == UNIGRAM)
    different = sum(r["rows"] for r in table if r["kind"] == UNIGRAM)
    rungs = range(0, 128, HALF_STEPS)

    def above(kind: int, k: int) -> list:
        return [r for r in table if r["kind"] == kind and r["k"] >= k]

    def entries(kind: int, k: int) -> int:
        return sum(r["rows"] * (r["k"] - k + 1) for r in above(kind, k))

    rung = {UNIGRAM: 0, BIGRAM: HALF_STEPS * int(math.log2(least))}
    while max_bits and sum(entries(k, r) for k, r in rung.items()) * BITS_PER_ENTRY > max_bits:
        largest = max(rung, key=lambda k: entries(k, rung[k]))
        rung[largest] += HALF_STEPS
    needed = sum(entries(k, r) for k, r in rung.items()) * BITS_PER_ENTRY
    bits = 1 << max(1, needed - 1).bit_length()
    bits = max(SEGMENTS * 64, min(max_bits, bits) if max_bits else bits)
    cut = {k: 1 << (r // HALF_STEPS) for k, r in rung.items()}
    means = {}
    for kind, r0 in rung.items():
        top = max((r["k"] for r in above(kind, r0)), default=r0 - 1)
        # a class without members, which a false probe may still name: its middle
        means[kind] = 2.0 ** ((np.arange(top - r0 + 2) - 0.5 + r0) / HALF_STEPS)
        means[kind][0] = 0
        for r in above(kind, r0):
            means[kind][r["k"] - r0 + 1] = r["sum"] / r["rows"]
    segments = max(SEGMENTS, bits // SEGMENT_BITS)
    size = bits // segments

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            kind, h, n = (batch.column(i).to_numpy() for i in range(3))
            keys = h.view(np.uint64)
            q = np.zeros(len(keys), np.int64)
            for k, c in cut.items():
                q = np.where(kind == k, _class(n, c), q)
            segment = _segment(keys, segments)
            salted = keys + kind.astype(np.uint64)
            for s in np.unique(segment).tolist():
                there = maps.setdefault(s, np.zeros(size, bool))
                mine = segment == s
                key, top = salted[mine], q[mine]
                for number in range(1, int(top.max(initial=0)) + 1):
                    for place in _places(key[top >= number], number, size):
                        there[place] = True
        for s, there in maps.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([np.packbits(there, bitorder="little").tobytes()], pa.binary())],
                names=["segment", "bits"])

    in_filter = counts.filter(" OR ".join(f"(kind = {k} AND n >= {c})" for k, c in cut.items()))
    tasks = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), segments // SEGMENTS_PER_TASK)
    stored = in_filter.repartition(
        tasks, F.shiftrightunsigned("h", 65 - segments.bit_length())
    ).mapInArrow(fill, "segment int, bits binary")
    enough = next((1 << (k // HALF_STEPS) for k in rungs
                   if sum(r["rows"] for r in above(UNIGRAM, k)) <= max_frequent), 1 << 62)
    rows = counts.filter(f"kind = {UNIGRAM} AND n >= {enough}").select("h", "n").toPandas()
    keys = rows["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Model(tokens, different, cut, means, segments, size, keys[order],
                 rows["n"].to_numpy(np.int64)[order], share), stored


class Asked:
    """A block reduced to what scoring needs: its different n-grams with room for their classes,
    and what exact counts of frequent words tell."""

    def __init__(self, model: Model, rows: pa.Array, block: Block) -> None:
        self.rows = rows
        self.sizes = np.diff(block.ends, prepend=0)
        self.starts = block.ends - self.sizes
        self.words = unigram_keys(block.hashes)
        c = model.exact(self.words)[block.ids]
        known = c >= 0
        self.base = np.add.reduceat(np.where(known, np.log10(model.floor(np.maximum(c, 0))), 0.0), self.starts)
        self.known = np.add.reduceat(known.astype(np.int64), self.starts)
        self.rare = self.words[block.ids[~known]].view(np.int64)
        self.rares = np.concatenate([[0], np.cumsum(~known)])[np.append(self.starts, block.ends[-1])]
        pairs, back = np.unique(_pairs(block), return_inverse=True)
        left, right = pairs >> 32, pairs & 0xFFFFFFFF
        self.pairs = bigram_keys(block.hashes[left], block.hashes[right])
        # a text begins as often as one ends
        self.left, self.right = np.where(left == 0, 1, left).astype(np.int32), right.astype(np.int32)
        self.back = back.astype(np.int32)
        self.classes = {UNIGRAM: np.zeros(len(self.words), np.uint8), BIGRAM: np.zeros(len(self.pairs), np.uint8)}

    def probe(self, model: Model, first: int, bits: np.ndarray) -> None:
        """Fill in the classes of n-grams whose segments are the rows of ``bits``, from ``first`` on."""
        for kind, keys in ((UNIGRAM, self.words), (BIGRAM, self.pairs)):
            row = _segment(keys, model.segments) - first
            mine = np.flatnonzero((row >= 0) & (row < len(bits)))
            for at in (mine[i:i + PROBED] for i in range(0, len(mine), PROBED)):
                self.classes[kind][at] = model.classes(keys[at], kind, bits, row[at])

    def scored(self, model: Model, key: str) -> pa.RecordBatch:
        logs = model.log10(self.classes[UNIGRAM], self.classes[BIGRAM], self.left, self.right)
        return pa.RecordBatch.from_arrays([
            self.rows, pa.array(self.sizes), pa.array(np.add.reduceat(logs[self.back], self.starts)),
            pa.array(self.base), pa.array(self.known),
            pa.ListArray.from_arrays(pa.array(self.rares.astype(np.int32)), pa.array(self.rare)),
        ], names=[key, "n_tokens", "score", "base", "known", "rare"])


def broadcast_pieces(model: Model, segments: DataFrame) -> list[tuple[int, Broadcast]]:
    """The stored filter as broadcasts of at most ``PIECE_BITS`` each, with their first segments.
    The driver holds one piece at a time."""
    size, out = max(1, PIECE_BITS // model.segment_bits), []
    for first in range(0, model.segments, size):
        bits = np.zeros((min(size, model.segments - first), model.segment_bits // 8), np.uint8)
        for r in segments.filter(F.col("segment").between(first, first + len(bits) - 1)).collect():
            bits[r["segment"] - first] = np.frombuffer(r["bits"], np.uint8)
        out.append((first, segments.sparkSession.sparkContext.broadcast(bits)))
    return out


def answered(model: Model, pieces: list[tuple[int, Broadcast]], asked: list[Asked], key: str) -> Iterator[pa.RecordBatch]:
    """Scores of blocks that ask the pieces one after the other, so that a process holds one
    piece; with a single one it is kept from block to block."""
    for first, piece in pieces if asked else ():
        bits = piece.value
        for block in asked:
            block.probe(model, first, bits)
        del bits
        if len(pieces) > 1:
            vars(piece).pop("_value", None)     # it is read from the worker's disk again when needed
    for block in asked:
        yield block.scored(model, key)


def score_texts(
    docs: DataFrame, training: Column | None = None, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``;
    the model is learnt from the rows for which ``training`` holds (all by default).

    Tokens are words, A-Z lower-cased, and one end per text. ``score`` is the filter model's
    log10 probability of the whole text. ``base_score`` and ``n_known`` are from exact
    counts: those of frequent words travel with the model, those of the others are joined by
    hash from the table of all counts (64 bits of XXH64 stand for a word). NULL text is the
    end alone. Without training rows all counts are 0 and N = V = 0. Repeated rows are scored
    each. Counts, the filter, and texts reduced to scores and rare words are stored in the
    shared folder; texts are never shuffled.
    """
    spark = docs.sparkSession
    learnt = docs if training is None else docs.filter(training)
    counts = materialize(ngram_counts(learnt, text), "ngrams")
    model, segments = plan(counts, **options)
    held, pieces = spark.sparkContext.broadcast(model), broadcast_pieces(model, materialize(segments, "filter"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, together = held.value, 1 if len(pieces) == 1 else SWEPT // SCORED
        waiting: list[Asked] = []
        for batch in batches:
            for block in blocks(batch.column(1), SCORED):
                waiting.append(Asked(own, batch.column(0)[block.first:block.first + len(block.ends)], block))
                if len(waiting) == together:
                    yield from answered(own, pieces, waiting, key)
                    waiting = []
        yield from answered(own, pieces, waiting, key)

    slim = docs.select(f"`{key}`", f"`{text}`")
    scored = slim.mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, score double, base double, known bigint, rare array<bigint>")
    scored = materialize(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    norm = model.tokens + 0.5 * (model.different + 1)
    words = counts.filter(f"kind = {UNIGRAM}").select("h", "n")
    rare = (
        scored.select("_row", F.explode("rare").alias("h")).groupBy("_row", "h").count()
        .join(words, "h", "left")
        .groupBy("_row").agg(
            F.sum(F.col("count") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(norm))).alias("_base"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("count")).otherwise(0)).alias("_known"))
    )
    return scored.join(rare, "_row", "left").select(
        key, "n_tokens", (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"), "score",
    )
