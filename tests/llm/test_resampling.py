from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from tidelake.llm.queries import op11_importance_resampling
from tidelake.llm.resampling import Hasher, _reach, bucket_counts, draw, importance_resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute(docs, targets, percent=5, least=20):
    """{doc_id: (n_features, weight, score, rank)} of rows with different ids."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)[1]))
    for text in targets:
        t.update(map(bucket, features(text)[1]))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in s}
    out, able = {}, []
    for key, text in docs:
        words, runs = features(text)
        weight = sum(gain[bucket(f)] for f in runs)
        h = int(hashlib.sha256(f"42:{key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[key] = [len(runs), weight, score, None]
        if len(words) >= least:
            able.append((-score, key))
    for rank, (_, key) in enumerate(sorted(able)[:percent * len(able) // 100], 1):
        out[key][3] = rank
    return {k: tuple(v) for k, v in out.items()}


def some_text(rng, n, words):
    return "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "--", ""]) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def got(df):
    return {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in df.collect()}


def test_buckets_of_runs():
    rng = random.Random(3)
    words = ["a", "Bc", "éè", "x" * 63, "y" * 64, "Z" * 700, "07", "日本"]
    texts = [some_text(rng, rng.randint(0, 30), words) for _ in range(60)] + ["", None, "one", "one two", " ..! "]
    sizes, found = Hasher().runs(pa.array(texts))
    assert sizes.tolist() == [len(features(t)[0]) for t in texts]
    for n, (buckets, runs) in enumerate(found, 1):
        own = [[bucket(f) for f in features(t)[1] if f.count(" ") == n - 1] for t in texts]
        assert runs.tolist() == [len(o) for o in own]
        assert buckets.tolist() == [b for o in own for b in o]


def test_equals_brute_force(spark):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in "abcdeéß" for b in "XYz019"]
    docs = [(i, some_text(rng, rng.randint(0, 80), words)) for i in rng.sample(range(-500, 5000), 300)]
    docs += [(9001, None), (9002, ""), (9003, docs[0][1]), (9004, "w " * 30_000)]
    targets = [some_text(rng, 50, words[:15]) for _ in range(10)]
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    for percent in (5, 40):
        found = got(importance_resample(frame(spark, docs).repartition(5), target, percent))
        assert found == brute(docs, targets, percent)


def test_ties_repeats_and_null_keys(spark):
    text = " ".join("abcdefghijklmnopqrstuvwxyz")
    # one key repeated, so one score for all: exactly the wanted number is drawn
    rows = importance_resample(frame(spark, [(7, text)] * 90 + [(None, text)] * 10), frame(spark, [(0, "a")]), 30).collect()
    assert sorted(r.rank for r in rows if r["rank"] is not None) == list(range(1, 31))
    assert len(rows) == 100 and {r.doc_id for r in rows} == {7, None}
    # all scores equal: smaller keys first, extreme ones too, NULL last
    keys = [5, -(1 << 63), (1 << 63) - 1, 0, None, None]
    scored = spark.createDataFrame([(k, 1) for k in keys], "_key long, score long")
    for wanted, want in ((0, set()), (1, {-(1 << 63)}), (2, {-(1 << 63), 0}), (4, set(keys[:4])), (5, set(keys)), (6, set(keys))):
        taken, n = draw(scored, wanted)
        assert {r[0] for r in scored.filter(taken).collect()} == want and n >= wanted


@pytest.mark.parametrize("values", [[1, 1, 1], [-10**12, 0, 5, 5, 10**15]])
def test_threshold(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for wanted in {1, 2, len(values) // 2, len(values)} - {0}:
        assert _reach(rows, rows["v"], wanted) == sorted(values, reverse=True)[wanted - 1]
    assert _reach(rows, rows["v"], len(values) + 1) is None


def test_empty_tables_and_clashing_names(spark):
    none, docs = frame(spark, []), [(i, f"w{i} " * 25) for i in range(40)]
    target = frame(spark, [(0, "w1 w1 w1")])
    assert importance_resample(none, target).collect() == []
    assert bucket_counts(none).sum() == 0
    assert got(importance_resample(frame(spark, docs), none)) == brute(docs, [])
    odd = frame(spark, docs)
    for name in ("_key", "_text", "_words", "score", "rank", "weight", "_file", "_row", "_metadata", "b", "n"):
        odd = odd.selectExpr("*", f"'x' AS {name}")
    assert got(importance_resample(odd, target)) == brute(docs, ["w1 w1 w1"])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    targets = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    df = op11_importance_resampling(spark, sf)
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got(df) == brute(docs, targets)
