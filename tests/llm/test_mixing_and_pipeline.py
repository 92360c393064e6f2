from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelake.llm.mixing import mix, mixed, source_targets


def brute_mix(docs, weights=(3, 1, 2), share=1.5, passes=2):
    """docs: (key, source, size), different rows. The queue, one item at a time."""
    sources = sorted({s for _, s, _ in docs}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    items, upto = [], Counter()
    turn = lambda d: (hashlib.md5(("" if d[0] is None else str(d[0])).encode()).hexdigest(), d[2])
    for s in sources:
        for _ in range(passes):
            for d in sorted((d for d in docs if d[1] == s and d[2]), key=turn):
                upto[s] += d[2]
                items.append((upto[s] / weight[s], s is None, s or "", d))
    taken, sent = Counter(), 0
    for *_, d in sorted(items, key=lambda i: i[:3]):
        sent += d[2]
        if sent > int(sum(x[2] for x in docs) * share):
            break
        taken[d] += d[2]
    return taken


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, passes=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = sum(sizes.values()) * share, {}, set(names)
    while open_:
        each = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if each * weight[s] > sizes[s] * passes}
        if not full:
            return target | {s: each * weight[s] for s in open_}
        for s in full:
            target[s] = sizes[s] * passes
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 5, None: 80}, {"x": 7}, {None: 3, "z": 0},
    {f"s{k}": (k * k) % 37 for k in range(25)},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df, (3, 1, 2), 1.5, 2).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_matches_the_queue(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn(
        "source", F.when(F.col("source") != "src3", F.col("source")))
    docs = [(r.doc_id, r.source, len((r.text or "").encode().split())) for r in df.collect()]
    want = brute_mix(docs)
    rows = mix(df).collect()
    assert {(r.doc_id, r.size): r.taken for r in rows} == {(k, n): want[k, s, n] for k, s, n in docs}
    per_source, target, largest = Counter(), {}, Counter()
    source = {k: s for k, s, _ in docs}
    for r in rows:
        s = source[r.doc_id]
        per_source[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(per_source[s] - target[s]) <= 2 * max(largest.values()) for s in target)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix(df.repartition(3)).collect()))


def test_mix_of_edge_rows(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c d e"), (4, "x " * 90_000)], source=None)
    docs = docs.withColumns({"size": F.lit("mine"), "block": F.lit(1), "target": F.lit("mine")})
    rows = mix(docs).collect()
    assert len(rows) == 6 and sum(r.taken for r in rows) <= 1.5 * sum(r.size for r in rows)
    assert Counter(r.size for r in rows) == Counter([0, 0, 2, 2, 3, 90_000])
    out = mixed(docs)
    assert out.columns == docs.columns
    assert {r.text for r in out.collect()} <= {"a b", "c d e", "x " * 90_000}
    assert mix(docs.limit(0)).collect() == [] and mixed(docs.limit(0)).collect() == []
    silent = make_docs([None, " "])
    assert [(r.size, r.target, r.taken) for r in mix(silent).collect()] == [(0, 0.0, 0)] * 2


def test_one_source_may_hold_most_rows(spark):
    rows = [(k, " ".join("w" * 1 for _ in range(k % 9)), "big" if k % 10 else f"s{k % 3}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = brute_mix([(k, s, len(t.split())) for k, t, s in rows])
    assert {r.doc_id: r.taken for r in mix(df).collect()} == {
        k: want[k, s, len(t.split())] for k, t, s in rows}


def test_rows_that_share_a_key_have_their_own_copies(make_docs):
    rows = [(k, f"t{i} " * (i + 1)) for i, k in enumerate([7, 7, 7, None, None, None, None, 8])]
    docs = make_docs([*rows, (9, "same same"), (9, "same same"), (9, "same same")])
    want = sorted((r.size, r.taken) for r in mix(docs, share=0.7).collect() if r.taken)
    got = Counter(r.text for r in mixed(docs, share=0.7).collect())
    sizes = Counter()
    for text, n in got.items():
        sizes[len(text.split())] += n * len(text.split())
    taken = Counter()
    for size, n in want:
        taken[size] += n
    assert sizes == taken
    assert sum(sizes.values()) <= 0.7 * sum(r.size for r in mix(docs, share=0.7).collect())


# -------------------------------------------------------------------------- pipeline

def test_stages_hand_over_what_they_keep(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("extra", F.lit(1))
    for name in ("_stats", "_times", "_key", "_copies", "_score", "score", "_mark", "_at", "_copy", "_row", "_words",
                 "_g", "_failed", "_own", "_par", "_kept", "kept", "_bucket", "_metadata", "_text", "g", "fp"):
        docs = docs.withColumn(name, F.lit(-5))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "quality_rules", "simhash_near_dedup", "source_mixing", "best_fit_packing"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "best_fit_packing":
            assert docs.columns == before.columns and docs.filter("_score != -5 OR kept != -5 OR _stats != -5").isEmpty()
            assert docs.select("doc_id").subtract(before.select("doc_id")).isEmpty()
        seen.append([r.doc_id for r in docs.select("doc_id").collect()])
    good, ruled, single, mixture, packed = seen
    assert sum(labels[d] == 0 for d in good if d in labels) <= 0.1 * sum(v == 0 for v in labels.values())
    assert {d for d, v in labels.items() if v == 1} <= set(good)
    assert len(single) == len(set(single)) < len(ruled)
    assert max(Counter(mixture).values()) == 2 and set(packed) == set(mixture)
    spans = defaultdict(list)
    for r in docs.collect():
        spans[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in v) <= 2048 for v in spans.values())


def test_stages_on_empty_and_null_rows(spark, make_docs, tmp_path):
    os.symlink("/root/testdata/sf0.001/labels.parquet", tmp_path / "labels.parquet")
    for n, docs in enumerate((make_docs([None, "", "a b"], source=None), make_docs(["x"]).limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{n}")
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
