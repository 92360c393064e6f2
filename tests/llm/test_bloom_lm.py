from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidelake.llm import bloom_lm
from tidelake.llm.bloom_lm import BIGRAM, UNIGRAM, bigram_keys, build, fold, ngram_counts, score_texts, unigram_keys
from tidelake.session import materialize


def tokens(text):
    return [*(text or "").encode().lower().split(), b" "]


def brute(texts, learnt):
    c = Counter(t for text in learnt for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return n, [(len(tokens(t)), sum(c[w] > 0 for w in tokens(t)),
                sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for t in texts]


def test_base_matches_brute_force_and_model_beats_it_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    held = {d for d in rows if zlib.crc32(str(d).encode()) % 5 == 1}
    n, want = brute(rows.values(), [t for d, t in rows.items() if d not in held])
    got = {r.doc_id: r for r in score_texts(docs, fold("doc_id") != 1, max_frequent=3000).collect()}
    gains = []
    for d, (size, known, base) in zip(rows, want):
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        if d in held:
            gains.append((r.score - base) / size)
    assert np.mean(gains) > 0 and min(gains) > -0.3


def test_filter_returns_no_count_too_small(spark, make_docs):
    texts = ["the cat sat on the mat " * k + f"only{k}" for k in range(1, 60)]
    counts = materialize(ngram_counts(make_docs(texts)), "ngrams")
    words = Counter(t for text in texts for t in tokens(text))
    pairs = Counter(p for text in texts for p in zip([b"  ", *tokens(text)], tokens(text)))
    import xxhash
    hashed = lambda ws: np.array([xxhash.xxh64_intdigest(w) for w in ws], np.uint64)
    single = {r.h: r.n for r in counts.filter(f"kind = {UNIGRAM}").collect()}
    assert single == {int(k): n for k, n in zip(unigram_keys(hashed(words)).view(np.int64), words.values())}
    both = {r.h: r.n for r in counts.filter(f"kind = {BIGRAM}").collect()}
    keys = bigram_keys(hashed([a for a, _ in pairs]), hashed([b for _, b in pairs])).view(np.int64)
    assert both == {int(k): n for k, n in zip(keys, pairs.values()) if n >= 2}
    model = build(counts)
    for kind, table in ((UNIGRAM, single), (BIGRAM, both)):
        k = np.array(list(table), np.int64)
        n = np.array([table[x] for x in k.tolist()])
        told = model.quantised(k.view(np.uint64), kind)
        assert (told >= n / math.sqrt(2)).all() and np.mean(told <= n * math.sqrt(2)) > 0.9
    absent = np.random.default_rng(0).integers(0, 2**64, 20_000, np.uint64)
    assert (model.quantised(absent, BIGRAM) > 0).mean() < 0.1


def test_a_full_filter_keeps_its_size(make_docs):
    texts = [" ".join(f"w{(i * 7 + k) % 900}" for k in range(300)) for i in range(60)]
    counts = materialize(ngram_counts(make_docs(texts)), "ngrams")
    model = build(counts, max_bits=1 << 14, max_frequent=10)
    assert model.bits.size * 8 <= 1 << 14 and len(model.frequent) <= 10
    assert model.cut[BIGRAM] > 2 and model.tokens == 60 * 301


def test_edge_rows(spark, make_docs):
    docs = [(1, None), (2, ""), (3, "A b\tc"), (3, "A b\tc"), (None, "É é a"), (4, "long " * 200_000)]
    df = make_docs(docs).withColumns({"score": F.lit("mine"), "n": F.lit(1)})
    rows = score_texts(df).collect()
    n, want = brute([t for _, t in docs], [t for _, t in docs])
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == Counter(
        (d, s, k, n, round(b, 4)) for (d, _), (s, k, b) in zip(docs, want))
    assert all(r.score < 0 for r in rows)
    assert score_texts(df.limit(0)).collect() == []
    untrained = score_texts(df, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in untrained} == {(0, 0)}


def test_filter_grows_with_the_entries_and_keeps_all_counts(make_docs, monkeypatch):
    monkeypatch.setattr(bloom_lm, "SEGMENT_BITS", 1 << 8)      # more segments than SEGMENTS
    monkeypatch.setattr(bloom_lm, "PIECE_BITS", 1 << 16)       # broadcast in several pieces
    texts = [" ".join(f"w{(i * 7 + k) % 9000}" for k in range(300)) for i in range(600)]
    docs = make_docs(texts)
    counts = materialize(ngram_counts(docs), "ngrams")
    model = build(counts)
    assert model.cut == {UNIGRAM: 1, BIGRAM: 2}
    assert model.segments > bloom_lm.SEGMENTS and model.segment_bits <= 1 << 8
    for kind, least in ((UNIGRAM, 1), (BIGRAM, 2)):
        rows = counts.filter(f"kind = {kind}").collect()
        told = model.quantised(np.array([r.h for r in rows], np.int64).view(np.uint64), kind)
        assert all(t >= r.n / math.sqrt(2) for t, r in zip(told, rows))
    assert model.segments * model.segment_bits >= 4 * bloom_lm.PIECE_BITS
    # scoring by pieces tells what the filter as a whole tells
    got = {r.doc_id: r.score for r in score_texts(docs).collect()}
    for i in (0, 1, 599):
        total = 0.0
        for a, b in zip([b" ", *tokens(texts[i])], tokens(texts[i])):
            start = b"  " if a == b" " else a
            h = [np.array([xxhash.xxh64_intdigest(x)], np.uint64) for x in (start, a, b)]
            before, both, word = (model.quantised(unigram_keys(h[1]), UNIGRAM)[0],
                                  model.quantised(bigram_keys(h[0], h[2]), BIGRAM)[0],
                                  model.quantised(unigram_keys(h[2]), UNIGRAM)[0])
            follows = min(both, before) / before if before else 0
            total += math.log10(0.1 * follows + 0.9 * model.floor(word))
        assert got[i] == pytest.approx(total, rel=1e-9)
