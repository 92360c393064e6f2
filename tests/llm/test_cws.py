from __future__ import annotations

import hashlib
import math
import re
import statistics
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tidelake.llm import cws
from tidelake.llm.cws import SAMPLES, fingerprints, gamma_quantiles, in_buckets


def weights(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text))


def jaccard(a, b):
    a, b = weights(a), weights(b)
    words = set(a) | set(b)
    if not words:
        return 1.0
    return sum(min(a[w], b[w]) for w in words) / sum(max(a[w], b[w]) for w in words)


def edited(text, following):
    m = len(text) // 3
    return text[:len(text) - m] + following[:m]


def check(rows, docs):
    """docs in any order; rows follow each other by falling keys, equal keys by a hash of the
    text, rows without a key last."""
    docs = sorted(docs, key=lambda d: place(d[0], d[1] or ""), reverse=True)
    want, true = Counter(), {}
    for (d, t), (_, n) in zip(docs, docs[1:] + docs[:1]):
        t, n = t or "", n or ""
        sha = hashlib.sha256(edited(t, n).encode()).hexdigest()
        want[d, len(t), sha] += 1
        true[d, sha] = (jaccard(t, edited(t, n)), jaccard(t, n))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    return [(r, *true[r.doc_id, r.edited_sha256]) for r in rows]


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = sorted(((r.doc_id, r.text) for r in df.collect()), reverse=True)
    texts = dict(docs)
    found = check(fingerprints(df).collect(), docs)
    near = [r.near_edited - j for r, j, _ in found]
    far = [r.near_next - j for r, _, j in found]
    assert abs(statistics.mean(near)) < 0.03 and statistics.pstdev(near) < 0.09
    assert abs(statistics.mean(far)) < 0.02 and statistics.pstdev(far) < 0.06
    by_text = {}
    for r, *_ in found:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_edge_rows(spark, make_docs):
    docs = [(9, "nine words are in this text, or so it seems"), (7, None), (7, "seven"), (7, "seven"), (5, ""),
            (3, "É ü " * 30_000), (2, " \n "), (None, "no key at all")]
    df = make_docs(docs).withColumns({"bucket": F.lit("mine"), "guest": F.lit(1), "v": F.lit(2)})
    rows = fingerprints(df).collect()
    check(rows, docs)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {""}
    assert all(r.near_edited == 1 for r in rows if r.n_chars == 0)
    assert fingerprints(df.limit(0)).collect() == []


def test_one_row_and_no_keys(make_docs):
    one = fingerprints(make_docs([(4, "a b c d e f")])).first()
    check([one], [(4, "a b c d e f")])
    assert one.near_next == 1
    rows = fingerprints(make_docs([(None, "a b c"), (None, "d e f")])).collect()
    check(rows, [(None, "a b c"), (None, "d e f")])


def test_neighbours_across_buckets(spark):
    # clustered keys, more rows than a bucket takes
    keys = [*range(1500), *(10**12 + k for k in range(1500)), -(10**15)]
    docs = sorted(((k, f"text of {k} with a tail of its own {k % 7}") for k in keys), reverse=True)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    check(fingerprints(df).collect(), docs)


@pytest.mark.parametrize("case", ["extreme keys", "one far key", "a third without keys", "one key", "equal rows"])
def test_no_bucket_is_crowded(spark, case):
    n, size = 3000, cws.ROWS_PER_BUCKET
    text = [f"text {i} with a tail of its own" for i in range(n)]
    keys = {
        "extreme keys": [-(1 << 63), (1 << 63) - 1, *range(n - 2)], "one far key": [10**12, *range(n - 1)],
        "a third without keys": [None if i % 3 == 0 else i for i in range(n)], "one key": [7] * n,
        "equal rows": [7 if i % 2 else None for i in range(n)],
    }[case]
    if case == "equal rows":
        text = ["all the same"] * n
    slim = spark.createDataFrame(list(zip(keys, text)), "_key long, _text string").repartition(6)
    placed = in_buckets(slim)
    sizes = {(r.bucket, r.guest): r["count"] for r in placed.groupBy("bucket", "guest").count().collect()}
    buckets = -(-n // size)
    assert {b for b, _ in sizes} == set(range(buckets))
    assert all(c == 1 for (_, guest), c in sizes.items() if guest)
    assert sum(c for (_, guest), c in sizes.items() if not guest) == n
    assert max(sizes.values()) <= (1.3 * size if case == "equal rows" else size)
    if case != "equal rows":
        # the guests close the circle
        rows = placed.selectExpr("bucket", "guest", "_key", "_text").collect()
        first = {r.bucket: max((x for x in rows if x.bucket == r.bucket and not x.guest), key=lambda x: place(x._key, x._text)) for r in rows if r.guest}
        assert all(first[(r.bucket + 1) % buckets]._text == r._text for r in rows if r.guest)


def place(key, text):
    """What falls from row to row."""
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return (key is not None, key or 0, -(h - (1 << 64) if h >> 63 else h))


def test_quantiles_are_those_of_the_gamma_distribution():
    q = gamma_quantiles()
    for i in (0, 100, 2048, len(q) - 1):
        assert math.isclose(1 - (1 + q[i]) * math.exp(-q[i]), (i + 0.5) / len(q), rel_tol=1e-6)
    assert abs(sum(q) / len(q) - 2) < 0.01 and q == sorted(q) and SAMPLES % 2 == 0
