"""Quality classifier (method: histogram gradient-boosted trees over document statistics)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.arrow import slices, text_buffers

# Classes of bytes whose shares are features.
_BYTE_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789", "blank": b" \t\r\x0b\f", "sentence": b".,;:", "shout": b"!?",
    "marks": b"#*$%&^~_=+", "frames": b"|<>[]{}()\\/@", "quotes": b"'\"`-",
}
STATISTICS = (
    "log_bytes", "log_words", "log_lines", *(f"share_{n}" for n in _BYTE_CLASSES), "share_wide",
    "mean_word", "longest_word", "distinct_words", "mean_line", "distinct_lines",
    "words_per_mark", "tail_repeats",
)


def statistics(raw: bytes) -> list[float]:
    """Numbers that describe one text, all 0 for an empty one. The whole text is read."""
    if not raw:
        return [0.0] * len(STATISTICS)
    size = len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    marks = int(seen[_CLASS["marks"]].sum() + seen[_CLASS["frames"]].sum())
    half = len(words) // 2
    ends = set(words[half:])
    return [
        np.log1p(size), np.log1p(len(words)), np.log1p(len(lines)),
        *(seen[c].sum() / size for c in _CLASS.values()), seen[128:].sum() / size,
        sum(map(len, words)) / n, np.log1p(max(map(len, words), default=0)),
        len(set(words)) / n, np.log1p(size / len(lines)), len(set(lines)) / len(lines),
        np.log1p(marks) - np.log1p(len(words)),
        len(ends & set(words[:half])) / max(1, len(ends)),
    ]


_CLASS = {n: np.frombuffer(b, np.uint8) for n, b in _BYTE_CLASSES.items()}


def statistics_matrix(column: pa.Array) -> np.ndarray:
    data, offsets = text_buffers(column)
    raw = data.tobytes()
    rows = [statistics(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return np.array(rows, np.float64).reshape(len(rows), len(STATISTICS))


@dataclass
class Forest:
    """Boosted complete binary trees, flattened: node i of a tree has children 2i + 1, 2i + 2."""

    base: float
    feature: np.ndarray     # trees x inner nodes
    threshold: np.ndarray   # trees x inner nodes; larger values go right
    leaf: np.ndarray        # trees x leaves

    def score(self, x: np.ndarray, rows: int = 8192) -> np.ndarray:
        """Probability of label 1 for each row; all trees are descended at once."""
        out = np.empty(len(x))
        trees = np.arange(len(self.feature))
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for at in range(0, len(x), rows):
            part = x[at:at + rows]
            node = np.zeros((len(part), len(trees)), np.int64)
            line = np.arange(len(part))[:, None]
            for _ in range(depth):
                right = part[line, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            margin = self.base + self.leaf[trees, node - inner].sum(axis=1)
            out[at:at + rows] = 1 / (1 + np.exp(-margin))
        return out


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
    bins: int = 64, least_rows: int = 10, ridge: float = 1.0,
) -> Forest:
    """Gradient boosting of the logistic loss on binned features. Without rows, or with one
    label only, the forest is the smoothed share of label 1. Equal rows give equal forests."""
    n, width = x.shape
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    inner = 2**depth - 1
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    if n == 0 or y.min() == y.max():
        return Forest(base, feature, threshold, leaf)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            slot = (node - first) * bins
            best = np.full(nodes, 1e-9)
            for f in range(width):
                at = slot + binned[f]
                g, h, c = (
                    np.bincount(at, w, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                    for w in (gradient, curve, None)
                )
                G, H, C = g[:, -1:], h[:, -1:], c[:, -1:]
                gain = g**2 / (h + ridge) + (G - g)**2 / (H - h + ridge) - G**2 / (H + ridge)
                gain[(c < least_rows) | (C - c < least_rows)] = 0
                gain[:, len(edges[f]):] = 0
                cut = gain.argmax(axis=1)
                value = gain[np.arange(nodes), cut]
                for k in np.flatnonzero(value > best):
                    best[k] = value[k]
                    feature[t, first + k], threshold[t, first + k] = f, edges[f][cut[k]]
            right = x[np.arange(n), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        end = node - inner
        g, h = (np.bincount(end, w, inner + 1) for w in (gradient, curve))
        leaf[t] = -rate * g / (h + ridge)
        margin += leaf[t, end]
    return Forest(base, feature, threshold, leaf)


def training_part(key: str):
    """Rows that may be learnt from, and the held-out rest: CRC-32 of the key as text, mod 5."""
    rest = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5
    return rest != 0


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, key: str = "doc_id",
    text: str = "text", label: str = "quality", **options,
) -> Forest:
    """A forest from the labelled documents outside the held-out part.

    At most ``sample_rows`` of them are used, so what reaches the driver is bounded (20,000 rows
    of 23 numbers are 4 MB): keys are thinned by a hash over the whole label table where there
    are more, and of the different (key, text) left, those with the least hashes are taken; a
    key or text repeated any number of times counts once. Labels other than 0 and 1, NULL
    labels and NULL keys are left out; labels without a document too. A key labelled repeatedly
    counts with its smallest label.
    """
    usable = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & training_part(key))
        .groupBy(F.col(key).alias("_key")).agg(F.min(label).cast("int").alias("_label"))
    )
    n = usable.count()
    if n > sample_rows:
        share = int(sample_rows / n * 1_000_000)
        usable = usable.filter(F.pmod(F.xxhash64("_key", F.lit("sample")), F.lit(1_000_000)) < share)
    chosen = docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(
        F.broadcast(usable), F.col("_id") == F.col("_key")      # different keys, about sample_rows
    ).select("_key", "_label", "_text", F.xxhash64("_text").alias("_hash"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            x = statistics_matrix(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(1), batch.column(3),
                 pa.array(list(x), pa.list_(pa.float64()))], names=["_key", "_label", "_hash", "x"])

    rows = (
        chosen.mapInArrow(measure, "_key string, _label int, _hash bigint, x array<double>")
        .groupBy("_key", "_hash").agg(F.first("_label").alias("_label"), F.first("x").alias("x"))
        .orderBy(F.xxhash64("_key", "_hash"), "_key", "_hash").limit(sample_rows)
        .select("_key", "_label", "x").collect()
    )
    rows.sort(key=lambda r: (r[0], r[2]))
    x = np.array([r[2] for r in rows], np.float64).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r[1] for r in rows], np.float64), **options)


def score(docs: DataFrame, forest: Forest, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` plus ``name``, the probability of label 1 from the whole text; NULL texts are
    scored as empty ones. A column of that name is replaced. One narrow pass; the forest
    (some 30 KB) travels with the task."""
    kept = [f for f in docs.schema if f.name != name]
    names = [f.name for f in kept]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            out = forest.score(statistics_matrix(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.select(*[f"`{n}`" for n in names]).mapInArrow(run, f"{schema}, `{name}` double")
