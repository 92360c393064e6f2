"""License scans (method: ordered signature rules).

A text is reduced to its words. Every rule is a regular expression over the words joined by
single spaces, and names the keywords of which one must occur before it is run. Detections
compete by priority: one that lies within the words of another of higher priority is dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelake.llm.arrow import replaced, slices, text_buffers

# Phrases whose places are counted, and their labels (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# label: names as regular expressions over words, the keyword of each, and versions. A name
# that is an everyday word needs "license" after it, see FORMS.
FAMILIES: dict[str, tuple[dict[str, str], tuple[str, ...]]] = {
    "agpl": ({"gnu affero general public": "affero", "affero general public": "affero", "agpl": "agpl"}, ("1 0", "3", "3 0")),
    "lgpl": ({"gnu (?:lesser|library) general public": "gnu", "(?:lesser|library) general public": "public", "lgpl": "lgpl"}, ("2", "2 0", "2 1", "3", "3 0")),
    "gpl": ({"gnu general public": "gnu", "gnu gpl": "gpl", "gpl": "gpl"}, ("1", "2", "2 0", "3", "3 0")),
    "gfdl": ({"gnu free documentation": "gnu", "gfdl": "gfdl"}, ("1 1", "1 2", "1 3")),
    "apache": ({"apache(?: software)?": "apache"}, ("1 0", "1 1", "2", "2 0")),
    "mit": ({"mit(?: expat)?": "mit", "expat": "expat"}, ()),
    "bsd": ({"(?:(?:2|3|4|two|three|four) clause )?bsd": "bsd", "bsd (?:2|3|4|two|three|four) clause": "bsd", "berkeley software distribution": "berkeley"}, ()),
    "mpl": ({"mozilla public": "mozilla", "mpl": "mpl"}, ("1 0", "1 1", "2", "2 0")),
    "epl": ({"eclipse public": "eclipse", "epl": "epl"}, ("1 0", "2 0")),
    "cddl": ({"common development and distribution": "distribution", "cddl": "cddl"}, ("1 0", "1 1")),
    "cpl": ({"common public": "common"}, ("1 0",)),
    "eupl": ({"european union public": "european", "eupl": "eupl"}, ("1 0", "1 1", "1 2")),
    "osl": ({"open software": "software"}, ("1 0", "2 0", "2 1", "3 0")),
    "afl": ({"academic free": "academic"}, ("1 1", "1 2", "2 0", "2 1", "3 0")),
    "artistic": ({"(?:clarified )?artistic": "artistic"}, ("1 0", "2 0")),
    "boost": ({"boost software": "boost"}, ("1 0",)),
    "isc": ({"isc": "isc"}, ()),
    "zlib": ({"zlib(?: libpng)?": "zlib"}, ()),
    "ncsa": ({"university of illinois ncsa open source": "ncsa", "ncsa": "ncsa"}, ()),
    "python": ({"python software foundation": "python", "psf": "psf"}, ("2",)),
    "php": ({"php": "php"}, ("3 0", "3 01")),
    "ruby": ({"ruby": "ruby"}, ()),
    "openssl": ({"openssl": "openssl"}, ()),
    "postgresql": ({"postgresql": "postgresql"}, ()),
    "unicode": ({"unicode": "unicode"}, ()),
    "ofl": ({"sil open font": "sil", "ofl": "ofl"}, ("1 0", "1 1")),
    "odbl": ({"open database": "database", "odbl": "odbl"}, ("1 0",)),
    "odc-by": ({"open data commons attribution": "commons"}, ("1 0",)),
    "ms-pl": ({"microsoft public": "microsoft", "ms pl": "pl"}, ()),
    "ms-rl": ({"microsoft reciprocal": "microsoft"}, ()),
    "wtfpl": ({"do what the fuck you want to public": "fuck", "wtfpl": "wtfpl"}, ("2",)),
    "unlicense": ({"unlicense": "unlicense"}, ()),
    "cecill": ({"cecill(?: [bc])?": "cecill"}, ("1 0", "2 0", "2 1")),
    "qpl": ({"q public": "q"}, ("1 0",)),
    "ibm": ({"ibm public": "ibm"}, ("1 0",)),
    "watcom": ({"sybase open watcom public": "watcom"}, ("1 0",)),
    "apsl": ({"apple public source": "apple"}, ("1 0", "1 1", "1 2", "2 0")),
    "blueoak": ({"blue oak model": "oak"}, ("1 0 0",)),
    "mulan": ({"mulan permissive software": "mulan", "mulan psl": "mulan"}, ("1", "2")),
    "cc-by": ({"creative commons attribution": "commons", "cc by": "cc"}, ("1 0", "2 0", "2 5", "3 0", "4 0")),
    "cc-by-sa": ({"creative commons attribution share ?alike": "commons", "cc by sa": "cc"}, ("1 0", "2 0", "2 5", "3 0", "4 0")),
    "cc-by-nc": ({"creative commons attribution non ?commercial": "commons", "cc by nc": "cc"}, ("1 0", "2 0", "2 5", "3 0", "4 0")),
    "cc-by-nd": ({"creative commons attribution no ?deriv(?:ative|atives|s)": "commons", "cc by nd": "cc"}, ("1 0", "2 0", "2 5", "3 0", "4 0")),
    "cc-by-nc-sa": ({"creative commons attribution non ?commercial share ?alike": "commons", "cc by nc sa": "cc"}, ("1 0", "2 0", "2 5", "3 0", "4 0")),
    "cc-by-nc-nd": ({"creative commons attribution non ?commercial no ?deriv(?:ative|atives|s)": "commons", "cc by nc nd": "cc"}, ("1 0", "2 0", "2 5", "3 0", "4 0")),
    "cc0": ({"creative commons zero": "commons", "cc0": "cc0"}, ("1 0",)),
}

# How a name is met: words before it, words after it, whether a version may or must follow,
# priority, and confidence.
_GRANT = (
    "(?:licensed|released|distributed|published|available|provided|covered) (?:under|by) "
    "(?:the )?(?:terms of )?(?:the )?"
)
FORMS = (
    ("spdx license identifier ", "", "may", 90, 1.0),
    (_GRANT, "(?: licen[cs]e)?", "may", 80, 0.95),
    ("", " licen[cs]e", "must", 70, 0.9),
    ("", " licen[cs]e", "no", 60, 0.8),
    ("", "", "must", 50, 0.6),
)

# Texts of licenses that do not name themselves.
TEXTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "purpose"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors", "implied"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy", "hereby"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed", "verbatim"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "redistribute"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("all-rights-reserved", "all rights reserved", "reserved"),
    ("apache", "you may not use this file except in compliance with the license", "compliance"),
)


class Rule(NamedTuple):
    label: str
    pattern: re.Pattern
    keyword: bytes
    priority: int
    confidence: float


class Found(NamedTuple):
    label: str
    first: int      # first word
    last: int       # last word
    priority: int
    confidence: float


def rules() -> list[Rule]:
    """All rules, highest priority first; longer names before shorter ones."""
    out = []

    def add(label, pattern, keyword, priority, confidence):
        out.append(Rule(label, re.compile(rf"(?<![^ ]){pattern}(?![^ ])".encode()),
                        keyword.encode(), priority, confidence))

    for label, pattern, keyword in TEXTS:
        add(label, pattern, keyword, 100, 1.0)
    for label, (names, versions) in FAMILIES.items():
        number = "|".join(sorted(versions, key=len, reverse=True))
        version = f" (?:(?:version |v ?)?(?:{number}))"
        for name, keyword in names.items():
            for before, after, follows, priority, confidence in FORMS:
                if follows == "must" and not versions:
                    continue
                end = {"no": "", "must": version, "may": f"(?:{version})?" if versions else ""}[follows]
                add(label, f"{before}(?:{name}){after}{end}", keyword, priority, confidence)
    return sorted(out, key=lambda r: (-r.priority, -len(r.pattern.pattern)))


@lru_cache(maxsize=1)
def _compiled() -> tuple[dict[bytes, list[int]], list[Rule]]:
    table, gate = rules(), defaultdict(list)
    for i, rule in enumerate(table):
        gate[rule.keyword].append(i)
    return dict(gate), table


# Everything but ASCII letters and digits, and bytes of other characters, separates words.
_SEPARATED = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_BASE = {
    label: (re.compile(rf"(?<![^ ]){phrase}(?![^ ])".encode()), phrase.split(" ")[0].encode())
    for phrase, label in BASE.items()
}
_BASE_WORDS = frozenset(k for _, k in _BASE.values())


def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().translate(_SEPARATED).split()


def _word_number(text: bytes):
    """A function from places in words joined by blanks to numbers of words."""
    blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    return lambda places: np.searchsorted(blanks, np.array(places, np.int64), side="left").tolist()


def unsuppressed(found: list[Found]) -> list[Found]:
    """``found``, highest priority first, without detections that lie within another one of
    higher priority, or of the same and of more words, or of the same words and found before.

    One priority after the other: what is kept so far is looked up by its first words and the
    furthest last word up to there, and of the rest a sweep keeps what reaches further.
    """
    kept: list[Found] = []
    for _, level in groupby(found, key=lambda f: f.priority):
        kept.sort(key=lambda f: f.first)
        firsts, reach = [f.first for f in kept], list(accumulate((f.last for f in kept), max))
        furthest = -1
        for f in sorted(level, key=lambda f: (f.first, -f.last)):      # stable: ties as found
            at = bisect_right(firsts, f.first)
            if f.last > furthest and not (at and reach[at - 1] >= f.last):
                kept.append(f)
                furthest = f.last
    return kept


def scan(words: list[bytes]) -> list[Found]:
    """Detections left after suppression, in order of place."""
    gate, table = _compiled()
    hit = gate.keys() & set(words)
    if not hit:
        return []
    text = b" ".join(words)
    number, found = _word_number(text), []
    for i in sorted(i for k in hit for i in gate[k]):
        rule = table[i]
        spans = [m.span() for m in rule.pattern.finditer(text)]
        for first, end in zip(number([a for a, _ in spans]), number([b for _, b in spans])):
            found.append(Found(rule.label, first, end, rule.priority, rule.confidence))
    return sorted(unsuppressed(found), key=lambda f: (f.first, f.last, f.label))


def places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase."""
    if _BASE_WORDS.isdisjoint(words):
        return []
    text = b" ".join(words)
    number = _word_number(text)
    return sorted(
        (first, label) for label, (pattern, _) in _BASE.items()
        for first in number([m.start() for m in pattern.finditer(text)])
    )


_FOUND = "array<struct<label:string,first_word:bigint,last_word:bigint,priority:int,confidence:double>>"


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, plus n_words, n_base, first_word, last_word, base_labels,
    labels, score and ``found`` (the detections with their words).

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z
    lower-cased, numbered from 0. Base labels stay whatever suppression does; ``score`` is
    the confidence of the surest detection (0.5 for a base phrase alone, 0 for none). NULL
    text counts as empty: no words, empty labels, NULL first and last word. Columns of
    ``docs`` named like new ones are replaced. One narrow pass over whole texts.
    """
    new = {
        "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
        "base_labels": "string", "labels": "string", "score": "double", "found": _FOUND,
    }
    kept = [f for f in docs.schema if f.name != text and f.name not in new]
    kind = pa.list_(pa.struct([
        ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("priority", pa.int32()), ("confidence", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            data, offsets = text_buffers(batch.column(text))
            raw = data.tobytes()
            out: dict[str, list] = {n: [] for n in new}
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                words = words_of(raw[a:b])
                base, found = places(words), scan(words)
                plain = {label for _, label in base}
                out["n_words"].append(len(words))
                out["n_base"].append(len(base))
                out["first_word"].append(base[0][0] if base else None)
                out["last_word"].append(base[-1][0] if base else None)
                out["base_labels"].append(",".join(sorted(plain)))
                out["labels"].append(",".join(sorted(plain | {f.label for f in found})))
                out["score"].append(max([0.5 if base else 0.0, *(f.confidence for f in found)]))
                out["found"].append([
                    {"label": f.label, "first_word": f.first, "last_word": f.last,
                     "priority": f.priority, "confidence": f.confidence} for f in found])
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), kind]
            yield replaced(batch, [text], {
                n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in new.items()])
    return docs.select(*[f"`{f.name}`" for f in kept], f"`{text}`").mapInArrow(run, schema)
