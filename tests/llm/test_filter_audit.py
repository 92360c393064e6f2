from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidelake.llm.filter_audit import FILTERS, filter_audit, masks, own_mask, possible_repeats

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failing(rows):
    """Set of failed filters of each (doc_id, text, lang) row."""
    least = {}
    for key, text, _ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    out = []
    for key, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": text in least and (key is None or least[text] < key),
        }
        out.append({f for f, bad in fails.items() if bad})
    return out


def brute(rows, good=(), toxic=()):
    failed, parts = failing(rows), defaultdict(list)
    for (key, _, lang), f in zip(rows, failed):
        parts[lang or ""].append((key, f))
    out, removed_at = {}, Counter()
    for part, members in parts.items():
        for order in map("".join, permutations(FILTERS)):
            left = members
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                removed_at[part, letter] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(letter in f for _, f in members) - len(gone),
                    sum(f == {letter} for _, f in members),
                    sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone), None]
    for (part, order, step), row in out.items():
        row[-1] = removed_at[part, order[step - 1]]
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COLUMNS) for r in df.collect()}


def frames(spark, rows, labels=()):
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string"),
            spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int"))


def some_rows(rng, n):
    texts = [
        lambda: " ".join(f"w{rng.randrange(10_000)}" for _ in range(rng.choice([5, 99, 100, 101, 150]))),
        lambda: "\t".join(f"w{rng.randrange(rng.choice([60, 150, 400]))}" for _ in range(130)),
        lambda: "ABC éé " * rng.randrange(1, 40),
        lambda: f"x {rng.choice('#$%&*|!')} y",
    ]
    fixed = [None, "", " ", "same text", "Same text", "same  text"]
    return [(i, rng.choice(fixed) if rng.random() < 0.4 else rng.choice(texts)(), rng.choice(["en", "de", None]))
            for i in rng.sample(range(10 * n), n)]


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = some_rows(rng, 250)
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k, _, _ in rows if rng.random() < 0.6]
    labels += [(99_999, 1, 1), (None, 1, 1)]
    docs, marks = frames(spark, rows, labels)
    good, toxic = ({r[0] for r in labels if r[i] == 1} for i in (1, 2))
    assert got(filter_audit(docs.repartition(4), marks)) == brute(rows, good, toxic)


def test_null_and_repeated_keys(spark):
    rows = [(None, "a", "en"), (None, "a", "en"), (None, "b", "en"), (5, "b", "de"), (5, "b", "de"), (6, "b", "de"),
            (7, "c", "en"), (7, "d", "en"), (-(1 << 63), "d", "en"), ((1 << 63) - 1, "d", None)]
    docs, marks = frames(spark, rows, [(5, 1, 0), (5, 0, 1), (7, 1, None)])
    assert got(filter_audit(docs, marks)) == brute(rows, {5, 7}, {5})


def test_boundaries():
    words = [f"w{i}" for i in range(100)]
    assert own_mask(" ".join(words).encode()) == 0 and own_mask(" ".join(words[:99]).encode()) == 1
    assert own_mask(" ".join(words[:80] + ["w0"] * 20).encode()) == 0
    assert own_mask(" ".join(words[:79] + ["w0"] * 21).encode()) == 2
    base = " ".join(words)
    assert own_mask((base + "é" * 20).encode()) == own_mask((base + "A" * 43).encode()) == 0
    assert own_mask((base + "A" * 44).encode()) == 4 and own_mask((base + " &").encode()) == 8
    assert own_mask(b"") == 1 and own_mask(b"w " * 2_000_000) == 2


@pytest.mark.parametrize("max_bits", [1 << 30, 1 << 9])
def test_no_repeat_is_cleared(spark, max_bits):
    """With few bits hardly any text is cleared, and the answers stay the same."""
    hashes = spark.range(4000).select(F.xxhash64(F.when(F.col("id") < 3000, F.col("id")).otherwise(F.col("id") % 50)).alias("h"))
    rows = hashes.withColumn("maybe", possible_repeats(hashes, max_bits)("h"))
    found = rows.groupBy("h").agg(F.count("*").alias("n"), F.max("maybe").alias("maybe")).collect()
    assert all(r.maybe for r in found if r.n > 1)
    cleared = sum(not r.maybe for r in found if r.n == 1)
    assert cleared > 2900 if max_bits > 1 << 20 else cleared < 2900


def test_small_filter_gives_the_same_masks(spark):
    rows = some_rows(random.Random(4), 120)
    docs, _ = frames(spark, rows)
    want = Counter((k, (lang or ""), sum(1 << FILTERS.index(c) for c in f)) for (k, _, lang), f in zip(rows, failing(rows)))
    found = Counter({(r._key, r._part, r._mask): r.n for r in masks(docs, max_bits=1 << 9).collect()})
    assert found == want


def test_empty_tables_and_clashing_names(spark):
    docs, marks = frames(spark, [])
    assert filter_audit(docs, marks).collect() == []
    rows = [(1, "a", "en"), (2, "a", "en")]
    docs, marks = frames(spark, rows)
    for name in ("_key", "_text", "_part", "_hash", "_mask", "_maybe", "n", "quality", "toxic", "part", "mask", "_label"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
        if name not in marks.columns:
            marks = marks.selectExpr("*", f"'x' AS {name}")
    assert got(filter_audit(docs, marks)) == brute(rows)
