from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from tidelake.llm import transducers
from tidelake.llm.packing import pack_documents, plan
from tidelake.llm.tokens import count_tokens
from tidelake.llm.transducers import Transducers

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", " ", "  ", "\n", "\t", "'s", "'re", "'ll", "'", "l", "1", "23", "é", "ß", "中", "文", "!", "!!",
    "<|endoftext|>", "<|endo", "Th", "tion", "\x1c", "\x85", "🙂", "٣", "ⅷ", "²", "́", "'S", "'m", "'ve", "'d",
    "’s", "\r\n", "\x0b", "　", "\x00", "the", " and",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def machine():
    return Transducers(PATH)


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]).astype(np.int64)


def agree(machine, library, texts):
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    counts = machine.counts(*flat(texts))
    ids, owners = machine.encode(*flat(texts))
    for i, w in enumerate(want):
        assert counts[i] == len(w) and ids[owners[i]:owners[i + 1]].tolist() == w, texts[i][:80]


def test_random_texts(machine, library):
    rng = random.Random(1)
    agree(machine, library, ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(4000)])


def test_real_texts(machine, library, spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    agree(machine, library, [r.text or "" for r in rows])


def test_long_and_degenerate_texts(machine, library):
    agree(machine, library, [
        "", "x" * 10_000 + " b" * 20, " " * 9_000, "\n" * 5_000 + "a", "a b " * 400_000,
        "<|endoftext|>" * 3, "あ" * 8_000, ""])


def test_full_tables_are_built_anew(library):
    small = Transducers(PATH, max_states=50)
    rng = random.Random(2)
    agree(small, library, ["".join(rng.choices(PARTS, k=30)) for _ in range(300)])


def test_equal_pieces_are_walked_once(library, monkeypatch):
    fresh, walked = Transducers(PATH), []
    walk = fresh.walk
    monkeypatch.setattr(fresh, "walk", lambda data, *rest: walked.append(len(data)) or walk(data, *rest))
    texts = [f"{k % 100} of the same words, é中<|endoftext|>\n" * 60 for k in range(2500)]
    ids, owners = fresh.encode(*flat(texts))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts[:100]]
    for i in range(len(texts)):
        assert ids[owners[i]:owners[i + 1]].tolist() == want[i % 100]
    assert owners[-1] == len(ids)
    assert sum(walked) < 10_000 < sum(map(len, texts)) / 100


@pytest.mark.parametrize("steps", [1, 2, 3])
def test_maps_of_short_chunks_are_composed(machine, library, monkeypatch, steps):
    # in so short chunks the exit state depends on the entry state, often over several chunks
    monkeypatch.setattr(transducers, "STEPS", steps)
    monkeypatch.setattr(transducers, "SETTLE", 1, raising=False)
    rng = random.Random(steps)
    quotes = ["'", "l", "r", "e", "s", " ", "a", "!", "1", "中", "<|endoftext|>"]
    agree(machine, library, ["".join(rng.choices(quotes, k=rng.randint(0, 40))) for _ in range(1500)])


def test_counts_of_edge_rows(make_docs):
    docs = make_docs([None, "", "Hello world", "Hello world", (2, "x" * 3000)])
    docs = docs.withColumns({"n_tokens": F.lit("mine"), "extra": F.lit(7)})
    out = count_tokens(docs, PATH, limit=1)
    assert set(out.columns) == {"doc_id", "lang", "source", "n_chars", "extra", "n_bytes", "n_tokens", "over_limit"}
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens > 0, r.over_limit, r.extra) for r in out.collect())
    assert got == Counter([(0, 0, False, False, 7), (1, 0, False, False, 7), (2, 11, True, True, 7),
                           (3, 11, True, True, 7), (2, 3000, True, True, 7)])
    assert count_tokens(docs.limit(0), PATH).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_fills_bins_without_overlap(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    histogram = {rng.randint(1, capacity): rng.randint(1, 300) for _ in range(60)}
    used, ranks = defaultdict(list), defaultdict(list)
    for r in plan(histogram, capacity):
        for i in range(r.items):
            used[r.first_bin + i // r.per_bin].append((r.offset + i % r.per_bin * r.length, r.length))
            ranks[r.length].append(r.first_rank + i)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    # as good as placing one piece after the other into the fullest bin that takes it
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [k for k, room in enumerate(rooms) if room >= length]
            if fits:
                rooms[min(fits, key=lambda k: rooms[k])] -= length
            else:
                rooms.append(capacity - length)
    assert len(used) == len(rooms)


def test_plan_does_not_grow_with_the_rows():
    few, many = ({n: 7 * k for n in range(1, 400)} for k in (1, 10**9))
    assert len(plan(many, 512)) < 10 * len(plan(few, 512)) + 1000


def pieces_of(library, text, capacity):
    ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
    cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def check_packed(rows, docs, library, capacity):
    want = Counter((d, *p) for d, t in docs for p in pieces_of(library, t, capacity))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_of_edge_rows(make_docs, library):
    docs = [(1, None), (2, ""), (3, "one two three " * 200), (3, "one two three " * 200), (4, "z"), (None, "no key")]
    df = make_docs(docs).withColumns({"length": F.lit("mine"), "offset": F.lit(1)})
    rows = pack_documents(df, PATH, 64).collect()
    check_packed(rows, docs, library, 64)
    assert pack_documents(df.limit(0), PATH, 64).collect() == []


def test_packing_of_a_table(spark, library):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack_documents(df, PATH, 2048).collect()
    used = check_packed(rows, [(r.doc_id, r.text) for r in df.collect()], library, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) * 1.05 + 1
