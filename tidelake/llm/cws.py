"""Document fingerprints (method: consistent weighted sampling). DataFrame functions only.

A text is its words with their counts as weights. Sample k of a text is the word, and the
level t of its weight, that has the smallest

    ln a = ln c - r (t - b + 1),   t = floor(ln(weight) / r + b),

where r and c are Gamma(2, 1) and b uniform on (0, 1), all three drawn from the hash of
(word, k). Two texts have the same sample k with the probability of their generalised
Jaccard similarity, the sum of smaller over the sum of larger weights.
"""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidelake.llm.resampling import ranked

SAMPLES = 64
BLANK = r"\x20\x09-\x0D"
TRIM = " \t\n\x0b\f\r"
# Gamma quantiles are looked up with 12 bits of the hash; b takes 32 of them.
_BITS = 12
# ln a lies in (-64, 64); 2^-30 is the finest difference that is told apart.
_ORIGIN, _FINE, _MARK_BITS = 64.0, float(1 << 30), 16
ROWS_PER_BUCKET, MAX_BUCKETS = 128, 65_536


@lru_cache(maxsize=1)
def gamma_quantiles() -> list[float]:
    """Gamma(2, 1) at the midpoints of 2^12 equal shares: solutions of 1 - (1 + x) e^-x = u."""
    out, x = [], 0.01
    for i in range(1 << _BITS):
        u = (i + 0.5) / (1 << _BITS)
        for _ in range(100):
            step = (1 - (1 + x) * math.exp(-x) - u) / (x * math.exp(-x))
            x = max(x - step, x / 2)
            if abs(step) < 1e-13 * x:
                break
        out.append(x)
    return out


def terms(text: Column, named: str) -> list[tuple[str, Column]]:
    """Columns to be added one after the other; the last, ``named``, is an array of
    (word hash, ln count), one entry per different word."""
    words, first, n = f"_w_{named}", f"_f_{named}", F.size(f"_w_{named}")
    solid = F.btrim(text, F.lit(TRIM))
    hashes, starts = F.col(words), F.col(first)
    follow = F.when(F.size(starts) > 0, F.concat(
        F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n)))
    none = F.array().cast("array<bigint>")
    return [
        (words, F.when(solid == "", none).otherwise(F.sort_array(
            F.transform(F.split(solid, f"[{BLANK}]+"), lambda w: F.xxhash64(w))))),
        (first, F.when(n == 0, F.array().cast("array<int>")).otherwise(F.filter(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
            lambda i: (i == 0) | (hashes[i] != hashes[F.greatest(i - 1, F.lit(0))])))),
        (named, F.when(F.size(starts) > 0, F.zip_with(starts, follow, lambda a, b: F.struct(
            hashes[a].alias("word"), F.log((b - a).cast("double")).alias("weight"))))),
    ]


def _sample(k: int) -> Column:
    """Order-preserving bigint: ln a in the upper bits, the mark of (word, t) in the lower 16.
    ``_quantiles`` holds the Gamma quantiles and then their logarithms."""
    u = F.xxhash64("word", F.lit(k))
    low = (1 << _BITS) - 1
    r = F.get("_quantiles", u.bitwiseAND(low).cast("int"))
    log_c = F.get(
        "_quantiles", F.shiftrightunsigned(u, _BITS).bitwiseAND(low).bitwiseOR(1 << _BITS).cast("int"))
    b = F.shiftrightunsigned(u, 32).cast("double") / float(1 << 32)
    t = F.floor(F.col("weight") / r + b)
    log_a = log_c - r * (t - b + 1)
    mark = (F.col("word").bitwiseAND(0xFFFFFF) + t * 40_503).bitwiseAND((1 << _MARK_BITS) - 1)
    order = ((log_a + _ORIGIN) * _FINE).cast("bigint")
    return F.shiftleft(order, _MARK_BITS).bitwiseOR(mark)


def signatures(rows: DataFrame, keys: list[str], array: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` plus ``sig``, the marks of all samples as text, four hexadecimal digits each;
    empty for rows without words. ``keys`` must tell rows apart. The minima are combined
    where the rows are, before anything is shuffled."""
    values = gamma_quantiles() + [math.log(x) for x in gamma_quantiles()]
    table = rows.sparkSession.createDataFrame([(values,)], "q array<double>").scalar()
    flat = rows.select(*keys, F.inline_outer(array)).withColumn("_quantiles", table)
    least = flat.groupBy(*keys).agg(*[F.min(_sample(k)).alias(f"_s{k}") for k in range(samples)])
    marks = [
        F.lpad(F.hex(F.col(f"_s{k}").bitwiseAND((1 << _MARK_BITS) - 1)), 4, "0") for k in range(samples)
    ]
    return least.select(*keys, F.coalesce(F.lower(F.concat(*marks)), F.lit("")).alias("sig"))


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two signatures; two empty ones are alike (1), an empty one
    and another are not (0)."""

    def mark(c: str, k: Column) -> Column:
        return F.substring(F.col(c), k * 4 + 1, F.lit(4))

    same = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda k: mark(a, k) == mark(b, k))
    return (
        F.when(F.col(a) == F.col(b), F.lit(1.0))
        .when((F.col(a) == "") | (F.col(b) == ""), F.lit(0.0))
        .otherwise(F.size(same) / float(samples))
    )


def _position() -> Column:
    """Where a row stands in the order of documents: by falling key, then by a hash of the text;
    rows without a key come last. NOT turns the order of integers round, whatever they are."""
    return F.struct(
        F.col("_key").isNull().cast("int").alias("last"),
        F.coalesce(F.bitwise_not(F.col("_key").cast("bigint")), F.lit(0)).alias("turned"),
        F.xxhash64("_text").alias("hash"))


def bucket_starts(slim: DataFrame) -> list[Row]:
    """Positions of the first rows of buckets of ``ROWS_PER_BUCKET`` rows (more, where
    ``MAX_BUCKETS`` would not do), counted exactly over positions alone. A position that many
    rows share may start several buckets."""
    at = ["last", "turned", "hash"]
    places = slim.select(_position().alias("p")).select("p.*")
    numbered = ranked(places, [F.asc(c) for c in at], "n")
    size = max(ROWS_PER_BUCKET, -(-numbered.count() // MAX_BUCKETS))
    return numbered.filter((F.col("n") - 1) % size == 0).orderBy("n").select(*at).collect()


def _not_above(starts: Column, number: int, place: Column, strictly: bool = False) -> Column:
    """How many of the sorted ``starts`` are at or before ``place`` (before, if ``strictly``)."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(number.bit_length()))])

    def ahead(at: Column, step: Column) -> Column:
        start = F.get(starts, at + step - 1)
        return F.when(start < place if strictly else start <= place, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), ahead)


def in_buckets(slim: DataFrame) -> DataFrame:
    """(bucket, guest, _key, _text): ``slim``'s rows in buckets of neighbours, and for each bucket
    one guest, the row that follows its last one (the very first row follows the very last)."""
    spark = slim.sparkSession
    starts = bucket_starts(slim)
    kind = "last int, turned bigint, hash bigint"
    table = spark.createDataFrame([(starts,)], f"s array<struct<{kind}>>").scalar()
    placed = slim.withColumn("_p", _position()).withColumn("_s", table)
    last = F.greatest(_not_above(F.col("_s"), len(starts), F.col("_p")) - 1, F.lit(0))
    placed = placed.withColumn("_last", last).withColumn("_starts", F.get("_s", "_last") == F.col("_p"))
    # rows whose position starts several buckets are dealt among these
    first = _not_above(F.col("_s"), len(starts), F.col("_p"), strictly=True)
    dealt = first + F.pmod(F.monotonically_increasing_id(), F.col("_last") - first + 1).cast("int")
    own = placed.select(
        F.when(F.col("_starts"), dealt).otherwise(F.col("_last")).alias("bucket"),
        F.lit(False).alias("guest"), "_key", "_text")
    firsts = placed.filter("_starts").groupBy("_p").agg(F.min("_text").alias("_text"), F.min("_key").alias("_key"))
    before = spark.createDataFrame(
        [(s, (i - 1) % len(starts)) for i, s in enumerate(starts)], f"_p struct<{kind}>, bucket int")
    guests = firsts.join(F.broadcast(before), "_p").select("bucket", F.lit(True).alias("guest"), "_key", "_text")
    return own.unionByName(guests)


def fingerprints(docs: DataFrame, samples: int = SAMPLES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    for every row of ``docs``.

    The edited text is the text with its last ``n_chars // 3`` code points replaced by as
    many first ones (or all) of the next document; documents follow each other by falling
    key (an integer), the first one follows the last, rows with equal keys by a hash of their
    text, and rows without a key come last. NULL text counts as empty. ``near_*`` estimate the generalised Jaccard
    similarity of words with their counts, with a standard error of at most 1/16.

    The texts are shuffled once, by buckets of neighbours, which have nearly equal numbers of
    rows whatever the keys are; each bucket also gets the row that follows its last one. All
    else happens inside buckets.
    """
    slim = docs.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    order = Window.partitionBy("bucket").orderBy(
        "guest", F.col("_key").desc_nulls_last(), F.xxhash64("_text"), "_text")
    paired = in_buckets(slim).withColumn("rn", F.row_number().over(order)).withColumn("_next", F.lead("_text").over(order))
    n = F.length("_text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("_text"), F.lit(1), n - cut),
        F.substring(F.coalesce("_next", F.lit("")), F.lit(1), cut))
    both = paired.withColumn("_edited", edited).select(
        "bucket", "rn", "guest", "_key", n.cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("v"), F.col("_text").alias("t")),
            F.struct(F.lit(1).alias("v"), F.col("_edited").alias("t")))).alias("_x"),
    ).select("*", F.col("_x.v").alias("v"), F.col("_x.t").alias("t")).drop("_x")
    for name, value in terms(F.col("t"), "terms"):
        both = both.withColumn(name, value)
    keys = ["bucket", "rn", "v", "guest", "_key", "n_chars", "edited_sha256"]
    signed = signatures(both, keys, "terms", samples)
    turn = Window.partitionBy("bucket").orderBy("rn", "v")
    found = (
        signed.withColumn("_edited", F.lead("sig", 1).over(turn)).withColumn("_after", F.lead("sig", 2).over(turn))
    )
    return found.filter((F.col("v") == 0) & ~F.col("guest")).select(
        F.col("_key").alias(key), "n_chars", "edited_sha256", F.col("sig").alias("fingerprint"),
        F.col("_edited").alias("edited_fingerprint"),
        likeness("sig", "_edited", samples).alias("near_edited"),
        likeness("sig", "_after", samples).alias("near_next"),
    )
