from __future__ import annotations

import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tidelake.llm.components import components
from tidelake.llm.simhash import near_duplicates, near_pairs, without_near_duplicates
from tests.conftest import plan_of


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i:i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """fps: list of (doc_id, fingerprint)."""
    root = {d: d for d, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, f) in enumerate(fps):
        for e, g in fps[:i]:
            if (f ^ g).bit_count() <= 2:
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: find(d) for d, _ in fps}


def test_pairs_match_brute_force(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    values = set(centres)
    for c in centres:
        for _ in range(25):
            v = c
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = sorted((r.a, r.b) for r in near_pairs(df).collect())
    flat = sorted(map(signed, values))
    want = sorted(
        (a, b) for i, a in enumerate(flat) for b in flat[i + 1:]
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    )
    assert got == want and len(want) > 100


def test_cells_are_not_broadcast(spark):
    # for their size Spark takes that of the values, each of which has some 50 cells
    plan = plan_of(near_pairs(spark.range(1000).select(F.xxhash64("id").alias("fp"))))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 140)]
    edges += [(500, 500), (7, 3), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in near_duplicates(docs).collect()}
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    want = brute_components(fps)
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{f:016x}" for d, f in fps}
    assert {d: r.component_id for d, r in got.items()} == want
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_edge_rows(spark, make_docs):
    long = "word " * 70_000 + "end"
    docs = make_docs([(9, None), (4, ""), (5, " \n"), (7, "One two"), (8, "one TWO"), (1, long),
                      (2, long), (2, long), (3, "É x y z"), (6, "é x y z")])
    docs = docs.withColumn("fp", F.lit("mine")).withColumn("component_id", F.lit(-1))
    rows = near_duplicates(docs).collect()
    assert len(rows) == 10
    ids = {r.doc_id: r.component_id for r in rows}
    assert ids == {9: 4, 4: 4, 5: 4, 7: 7, 8: 7, 1: 1, 2: 1, 3: 3, 6: 6}
    assert {r.fingerprint for r in rows if r.doc_id in (4, 5, 9)} == {"0" * 16}
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([4, 7, 1, 3, 6])
    assert near_duplicates(docs.limit(0)).collect() == []


def test_repeated_smallest_row_stays_once(make_docs):
    kept = without_near_duplicates(make_docs([(1, "a b c d"), (1, "a b c d"), (2, "a b c d")]))
    assert [r.doc_id for r in kept.collect()] == [1]


@pytest.mark.parametrize("words", [1, 2, 3, 4])
def test_short_texts(make_docs, words):
    text = " ".join("abcd"[:words])
    assert near_duplicates(make_docs([text])).first().fingerprint == f"{brute_fingerprint(text):016x}"


def test_rows_that_share_a_key_are_kept_by_their_texts(make_docs):
    def kept(rows):
        return Counter((r.doc_id, r.text) for r in without_near_duplicates(make_docs(rows)).collect())

    a, b, c = "a b c d", "w x y z", "k l m n o p"
    assert kept([(1, a), (1, b)]) == Counter([(1, a), (1, b)])
    got = kept([(0, a), (1, a), (1, b)])
    assert got == Counter([(0, a), (1, b)])
    assert kept([(None, a), (None, b), (None, b), (2, c), (None, c), (None, None)]) == Counter(
        [(None, a), (None, b), (2, c), (None, None)])
