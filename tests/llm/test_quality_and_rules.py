from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import quality
from tidelake.llm.outliers import CORE, FLOORS, SCALE, STEPS, estimates, passing, quality_rules
from tidelake.llm.quality import STATISTICS, Forest, fit, score, statistics, train

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_statistics_and_base_rules_of_whole_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = quality_rules(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_statistics(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and (not r.kept or not failed)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    assert all(kept for good, kept in judged if good)
    assert sum(not kept for good, kept in judged if not good) > 0.9 * sum(not good for good, _ in judged)


def brute_estimate(x):
    """The same steps in numpy, for one group (thousandths)."""
    x, d = x.astype(float), x.shape[1]
    fine = lambda v: np.floor(np.log1p(v) * 32).astype(int)
    centre = np.percentile(x, 50, axis=0) / SCALE
    spread = np.maximum(np.percentile(np.round(np.abs(x - centre * SCALE)), 50, axis=0) * 1.4826 / SCALE, FLOORS)
    inverse = np.diag(1 / spread**2)
    for _ in range(STEPS):
        gap = x / SCALE - centre
        q = fine(np.einsum("ni,ij,nj->n", gap, inverse, gap))
        core = x[q <= np.percentile(q, 100 * CORE)] / SCALE
        centre = core.mean(axis=0)
        inverse = np.linalg.inv(np.cov(core.T, bias=True) + np.diag(np.array(FLOORS) ** 2))
    gap = x / SCALE - centre
    middle = np.percentile(fine(np.einsum("ni,ij,nj->n", gap, inverse, gap)), 50)
    return centre, inverse, max(1.0, np.expm1((middle + 1) / 32) / 4.351), d


def test_estimates_match_brute_force(spark):
    rng = np.random.default_rng(4)
    groups = {"a": 400, "b": 150}
    rows = []
    for g, n in groups.items():
        mix = rng.normal(size=(5, 5))
        x = np.round((rng.normal(size=(n, 5)) @ mix + 5) * SCALE).astype(int)
        x[: n // 5] += 30_000
        rows += [(g, *map(int, r)) for r in x]
    df = spark.createDataFrame(rows, "g string, x_0 long, x_1 long, x_2 long, x_3 long, x_4 long")
    for r in estimates(df.repartition(7)).collect():
        centre, inverse, scale, d = brute_estimate(np.array([q[1:] for q in rows if q[0] == r.g]))
        root = np.array([[r[f"m_{i}{j}"] if j <= i else 0.0 for j in range(d)] for i in range(d)])
        assert np.allclose([r[f"c_{i}"] for i in range(d)], centre, atol=1e-6)
        assert np.allclose(root.T @ root, inverse, rtol=1e-5, atol=1e-8)
        assert r.scale == pytest.approx(scale)


def test_rules_on_edge_rows(spark, make_docs):
    usual = [f"word{i} and some other plain words number {i} " * 3 + " ".join(f"w{i}x{k}" for k in range(60))
             for i in range(150)]
    junk = "### *** $$$ %%% &&& " * 3 + " ".join(f"#{k}*$%&|<> " for k in range(200))
    docs = make_docs([*usual, None, "", " \n\t", "short text", junk, "a b c " * 5000], source=None)
    docs = docs.withColumns({"n_words": F.lit("mine"), "kept": F.lit("mine")})
    rows = {r.doc_id: r for r in quality_rules(docs.withColumn("lang", F.lit(None).cast("string"))).collect()}
    assert len(rows) == 156
    assert all(rows[i].base_failed and not rows[i].kept for i in (150, 151, 152, 153, 155))
    assert rows[154].n_symbols > 1000 and not rows[154].kept
    kept = passing(docs)
    assert kept.columns == docs.columns
    assert 154 not in {r.doc_id for r in kept.collect()}
    assert quality_rules(docs.limit(0)).collect() == [] and passing(docs.limit(0)).collect() == []
    nothing = make_docs(["too short", None])
    assert passing(nothing).collect() == []


def test_rules_agree_between_runs_and_partitionings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    first = sorted(map(tuple, quality_rules(docs).collect()), key=repr)
    again = sorted(map(tuple, quality_rules(docs.repartition(5)).collect()), key=repr)
    assert first == again


# ------------------------------------------------------------------------ classifier

def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    forest = train(docs, labels)
    truth = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    rows = [(r.score, truth[r.doc_id]) for r in score(docs, forest).collect() if r.doc_id in truth]
    good, bad = ([s for s, y in rows if y == k] for k in (1, 0))
    assert len(bad) > 50
    wins = np.searchsorted(np.sort(bad), good).sum()
    assert wins / (len(good) * len(bad)) > 0.99
    assert sum(s >= 0.3 for s in good) > 0.99 * len(good)


def test_what_reaches_the_driver_is_bounded(spark, make_docs, monkeypatch):
    """Rows, not labels, are bounded: one id with many texts, and one text many times."""
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append((x, y)))
    docs = make_docs([(7, f"text number {i}") for i in range(3000)] + [(7, "the same")] * 3000 + [(i, f"w {i}") for i in range(20, 60)])
    labels = spark.createDataFrame([(7, 1, 0), *((i, i % 2, 0) for i in range(20, 60))], "doc_id long, quality int, toxic int")
    train(docs, labels, sample_rows=100)
    train(docs, labels, sample_rows=100_000)
    assert len(seen[0][0]) == len(seen[0][1]) == 100
    able = [i for i in range(20, 60) if zlib.crc32(str(i).encode()) % 5]
    assert len(seen[1][0]) == (3001 if zlib.crc32(b"7") % 5 else 0) + len(able)


def test_traversal_matches_a_walk():
    rng = np.random.default_rng(0)
    x, forest = rng.normal(size=(500, 6)), None
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    forest = fit(x, y, trees=20, depth=3)

    def walk(row):
        total = forest.base
        for t in range(len(forest.feature)):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + 1 + (row[forest.feature[t, node]] > forest.threshold[t, node])
            total += forest.leaf[t, node - forest.feature.shape[1]]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(x, rows=64), [walk(r) for r in x])
    assert ((forest.score(x) > 0.5) == y).mean() > 0.9


def test_fit_without_anything_to_learn():
    none = fit(np.zeros((0, len(STATISTICS))), np.zeros(0))
    assert none.score(np.zeros((2, len(STATISTICS)))).tolist() == [0.5, 0.5]
    one = fit(np.ones((5, 3)), np.ones(5))
    assert isinstance(one, Forest) and one.score(np.zeros((1, 3)))[0] > 0.5


def test_scores_of_edge_rows(spark, make_docs):
    docs = make_docs([None, "", "text", "text", "y" * 300_000]).withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame(
        [(0, 1, 0), (1, None, 0), (2, 0, 0), (2, 0, 0), (3, 7, 0), (None, 1, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int")
    forest = train(docs, labels)
    rows = {r.doc_id: r.score for r in score(docs, forest).collect()}
    assert len(rows) == 5 and all(0 <= s <= 1 for s in rows.values())
    assert rows[0] == rows[1] and rows[2] == rows[3]
    assert score(docs.limit(0), forest).collect() == []
    assert train(docs.limit(0), labels.limit(0)).base == 0
    assert statistics(b"") == [0.0] * len(STATISTICS)
