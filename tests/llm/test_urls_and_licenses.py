from __future__ import annotations

import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelake.llm import licenses
from tidelake.llm.licenses import BASE, rules, scan, scan_licenses, words_of
from tidelake.llm.url_rules import RULES, Index, judge_urls, token_frequencies

HOSTS = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in HOSTS
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    hit = [r for r in RULES if not r.reported and re.search(r.pattern, f"{host}\t{path}", re.S)]
    best = min(hit, key=lambda r: (-r.rank, r.name), default=None)
    return host, path, None, best.verdict if best else "allow"


def test_pages_match_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    urls = {r.page_id: r.url for r in pages.select("page_id", "url").collect()}
    rows = judge_urls(pages).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows} == {
        k: brute_url(u) for k, u in urls.items()}
    assert len(rows) == len(urls)


def test_edge_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "http://ORG", "http://a.org/", "http://Example.ORG/en/17?x=://y.com/de/",
        "http://notexample.org/es/", "http://a.b.example.org/es/", "HTTPS://x.com/fr/1#://", "x://y://z.org/",
        "http://casino-win.example.net/en/1", "http://my-casino.net/", "http://occasion.net/", "http://é.org/ñ",
        "http://x.net/login", "http://x.net/login.php?a=b", "http://x.net/mylogin", "http://a.edu/login",
        "http://org:80/", "http://x.net/\n/cart/", "http://x.net" + "/a" * 50_000,
    ]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls + urls)], "page_id long, url string, host int")
    rows = judge_urls(df).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows) == Counter(
        (i, *brute_url(u)) for i, u in enumerate(urls + urls))
    assert judge_urls(df.limit(0)).collect() == []


def test_rules_are_filed_under_their_rarest_token(spark):
    parts = spark.createDataFrame(
        [("spam.example.org", "/es/")] + [("farm.example.org", "/es/")] * 3 + [("x.org", "/")] * 9, "host string, path string")
    frequency = token_frequencies(parts, RULES)
    assert (frequency["spam"], frequency["farm"], frequency["org"], frequency["casino"]) == (1, 3, 13, 0)
    index = Index(RULES, frequency)
    filed = {index.rules[i].name: t for t, found in index.by_token.items() for i in found}
    assert filed["host:spam-farm"] == "spam" and filed["example.org/es/"] == "es"
    assert set(filed) == {r.name for r in RULES}


# -------------------------------------------------------------------------- licenses

def brute_places(text):
    raw = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw)
    found = [(i, label) for phrase, label in BASE.items() for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    return words, sorted(found)


def check_rows(rows, texts):
    for r in rows:
        words, found = brute_places(texts[r.doc_id])
        base = {label for _, label in found}
        assert (r.n_words, r.n_base) == (len(words), len(found))
        assert (r.first_word, r.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted(base))
        labels = set(r.labels.split(",")) - {""}
        assert base <= labels and labels == base | {f.label for f in r.found}
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def test_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = scan_licenses(docs).collect()
    assert len(rows) == len(texts) and sum(r.n_base > 0 for r in rows) > 5
    check_rows(rows, texts)


def test_edge_texts(make_docs):
    texts = [None, "", "!!", "GNU General-Public\nLICENSE", "mit licenses", "cc by cc by", "MIT License " * 20_000,
             "É mit license ñ", "apache\x7flicense"]
    docs = make_docs(texts).withColumns({"labels": F.lit(3), "mine": F.lit(1)})
    rows = scan_licenses(docs).collect()
    assert len(rows) == len(texts) and all(r.mine == 1 for r in rows)
    check_rows(rows, dict(enumerate(texts)))
    assert scan_licenses(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text, want", [
    ("Licensed under the Apache License, Version 2.0.", ["apache"]),
    ("GNU Lesser General Public License v2.1 or the MIT License", ["lgpl", "mit"]),
    ("the GNU Affero General Public License", ["agpl"]),
    ("SPDX-License-Identifier: MPL-2.0", ["mpl"]),
    ("Licensed under CC BY-NC 4.0", ["cc-by-nc"]),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", ["bsd"]),
    ("he went with mit and apache to see the ruby", []),
    ("All rights reserved.", ["all-rights-reserved"]),
])
def test_labels_after_suppression(text, want):
    assert [f.label for f in scan(words_of(text.encode()))] == want


def test_gate_never_hides_a_rule():
    table = rules()
    assert len(table) > 200 and [r.priority for r in table] == sorted((r.priority for r in table), reverse=True)
    text = b"licensed under the terms of the gnu general public license version 3"
    without = [r.label for r in table if r.pattern.search(text) and r.keyword not in text.split()]
    assert without == []


def sequential(found):
    """Suppression as it is defined: one detection after the other against all that are kept."""
    kept = []
    for f in found:
        if not any(k.first <= f.first and f.last <= k.last for k in kept):
            kept = [k for k in kept if not (f.first <= k.first and k.last <= f.last and k.priority <= f.priority)]
            kept.append(f)
    return kept


def test_suppression_equals_the_sequential_one():
    rng = random.Random(12)
    for _ in range(400):
        found = []
        for i in range(rng.randint(0, 60)):
            a = rng.randrange(30)
            found.append(licenses.Found(f"l{i}", a, a + rng.randrange(8), rng.choice([50, 60, 100]), 1.0))
        found.sort(key=lambda f: -f.priority)
        assert sorted(licenses.unsuppressed(found)) == sorted(sequential(found))


def test_many_repeats_take_linear_time():
    start = time.monotonic()
    words = licenses.words_of(b"licensed under the apache license version 2 0, x " * 100_000)
    assert len(licenses.scan(words)) == 100_000 and len(licenses.places(words)) == 100_000
    assert time.monotonic() - start < 30
