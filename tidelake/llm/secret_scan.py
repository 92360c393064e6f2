"""Secret scans (method: sliding-window Shannon entropy per character class).

Three fixed patterns find keys by their form. Beyond them, every long run of token characters
is a candidate: a window slides over its stretches of each character class, keeps the number
of each character and the sum of n log2 n as one enters and one leaves, and marks where the
entropy reaches the threshold of the class. Candidates on the allow list are left out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelake.llm.arrow import replaced, slices, text_buffers

# The fixed patterns, their kinds in order, and the least length of what counts (fixed values).
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
ASSIGN_GATE = re.compile(rb"passw|secret|token|api_?key")    # in lower-cased text
KINDS = ("assign", "access", "hex")


class CharacterClass(NamedTuple):
    kind: str
    members: bytes
    window: int         # characters
    threshold: float    # bits a character
    needs: tuple[bytes, ...]    # a marked stretch holds a member of each


_DIGITS, _SMALL, _LARGE = b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A window of random characters has, on average, some 3.3 bits of hexadecimal digits, 4.0 of
# letters and digits, and 4.3 of base 64; words run together stay near 3.3 and have no digits.
CLASSES = (
    CharacterClass("entropy_hex", _DIGITS + b"ABCDEFabcdef", 20, 2.9, (_DIGITS, b"ABCDEFabcdef")),
    CharacterClass("entropy_alnum", _DIGITS + _SMALL + _LARGE, 20, 3.65, (_DIGITS, _SMALL + _LARGE)),
    CharacterClass("entropy_base64", _DIGITS + _SMALL + _LARGE + b"+/_-=", 24, 3.95, (_DIGITS, _SMALL, _LARGE)),
)
ORDER = {k: i for i, k in enumerate((*KINDS, *(c.kind for c in CLASSES)))}
LEAST_RUN = 20
TOKEN = _DIGITS + _SMALL + _LARGE + b"+/_.=-"
# Runs that look random but tell nothing: they stay out, unless a fixed pattern has them.
ALLOWED = (
    re.compile(rb"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}", re.IGNORECASE),      # a UUID
    re.compile(rb"sha(?:1|256|384|512)[-=][A-Za-z0-9+/=]+"),                         # a published digest
    re.compile(rb".*(?:example|sample|placeholder|changeme|dummy|redacted|your[-_]).*", re.IGNORECASE),
    re.compile(rb"(?:[A-Za-z0-9_-]+\.)+(?:com|org|net|io|html?|php|png|jpe?g|js|css)(?:/.*)?", re.IGNORECASE),
    re.compile(rb"(?:[A-Za-z]{0,19}[+/_.=-])*[A-Za-z]{0,19}"),                       # paths and names of words
    re.compile(rb"[0-9+/_.=-]+"),                                                    # dates, sums, rulers
)
SEQUENCES = (_DIGITS * 2, _SMALL * 2, b"0123456789abcdef" * 2, _SMALL + _DIGITS, _LARGE + _SMALL + _DIGITS + b"+/")
SEQUENCE = 10       # so many characters in a row from one of these are no secret


class Span(NamedTuple):
    kind: str
    start: int
    end: int


_IS_TOKEN = np.zeros(256, bool)
_IS_TOKEN[list(TOKEN)] = True
_MEMBERS = {c.kind: re.compile(b"[" + re.escape(c.members) + b"]+") for c in CLASSES}
_WHOLE = [p.fullmatch for p in ALLOWED]


def fixed_spans(raw: bytes, runs: list[tuple[int, int]]) -> list[Span]:
    """Spans of the fixed patterns, in bytes. Keys and hexadecimal stretches long enough to
    count lie in one of the ``runs`` of at least ``LEAST_RUN`` token characters."""
    out = []
    if ASSIGN_GATE.search(raw.lower()):
        out += [Span("assign", *m.span()) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    for a, b in runs:
        out += [Span("access", *m.span()) for m in ACCESS.finditer(raw, a, b) if m.end() - m.start() >= LEAST_ACCESS]
        out += [Span("hex", *m.span()) for m in HEX.finditer(raw, a, b) if m.end() - m.start() >= LEAST_HEX]
    return out


def allowed(run: bytes) -> bool:
    """Whether a candidate is on the allow list."""
    return any(match(run) for match in _WHOLE)


def _sequence(piece: bytes) -> bool:
    """Whether a stretch holds ``SEQUENCE`` characters in a row of the alphabet or digits, either
    way round. Parts are looked up at every fifth place, so a stretch is read twice at most."""
    half = SEQUENCE // 2
    for at in range(0, len(piece) - half + 1, half):
        part = piece[at:at + half].lower()
        for whole in SEQUENCES:
            whole = whole.lower()
            if part in whole or part[::-1] in whole:
                near = piece[max(0, at - half):at + 2 * half].lower()
                if any(near[i:i + SEQUENCE] in whole or near[i:i + SEQUENCE][::-1] in whole
                       for i in range(len(near) - SEQUENCE + 1)):
                    return True
    return False


def entropy_stretches(piece: bytes, window: int, threshold: float) -> list[tuple[int, int]]:
    """Joined windows of ``piece`` whose entropy, log2 w - (sum of n log2 n) / w over the
    numbers n of its characters, reaches ``threshold``. One step of the window is two updates."""
    if len(piece) < window:
        return []
    cost = [n * math.log2(n) if n else 0.0 for n in range(window + 1)]
    rise = [cost[n + 1] - cost[n] for n in range(window)]
    most = (math.log2(window) - threshold) * window + 1e-9      # the largest sum that is random enough
    counts, total = [0] * 256, 0.0
    for c in piece[:window]:
        total += rise[counts[c]]
        counts[c] += 1
    out = [[0, window]] if total <= most else []
    for i, (gone, new) in enumerate(zip(piece, piece[window:]), 1):
        counts[gone] -= 1
        total += rise[counts[new]] - rise[counts[gone]] if gone != new else 0.0
        counts[new] += 1
        if total <= most:
            if out and i <= out[-1][1]:
                out[-1][1] = i + window
            else:
                out.append([i, i + window])
    return [(a, b) for a, b in out]


def entropy_spans(raw: bytes, runs: list[tuple[int, int]], fixed: list[Span]) -> list[Span]:
    """Further spans, in bytes: random stretches of candidates that are not on the allow list
    and lie in no fixed span. Of stretches of several classes one within another goes."""
    out = []
    held = sorted((s.start, s.end) for s in fixed)
    starts = [a for a, _ in held]
    reach, furthest = [], 0
    for _, b in held:
        furthest = max(furthest, b)
        reach.append(furthest)
    for a, b in runs:
        run = raw[a:b]
        if allowed(run):
            continue
        own: list[Span] = []
        for c in CLASSES:
            for m in _MEMBERS[c.kind].finditer(run):
                for x, y in entropy_stretches(m[0], c.window, c.threshold):
                    piece = m[0][x:y]
                    if all(any(n in piece for n in map(bytes, zip(need))) for need in c.needs) and not _sequence(piece):
                        own.append(Span(c.kind, a + m.start() + x, a + m.start() + y))
        # longest first: what lies in one that is kept goes
        furthest = -1
        for s in sorted(own, key=lambda s: (s.start, -s.end, ORDER[s.kind])):
            i = np.searchsorted(starts, s.start, side="right") - 1
            if s.end > furthest and not (i >= 0 and reach[i] >= s.end):
                out.append(s)
            furthest = max(furthest, s.end)
    return out


def _points(raw: bytes, spans: list[Span]) -> list[Span]:
    """Spans in code points, in order of place and kind."""
    spans = sorted(spans, key=lambda s: (s.start, ORDER[s.kind], s.end))
    if raw.isascii() or not spans:
        return spans
    before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [Span(s.kind, int(before[s.start]), int(before[s.end])) for s in spans]


def token_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of ``LEAST_RUN`` token characters or more; none crosses texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    token = _IS_TOKEN[data]
    change = np.zeros(len(data) + 1, bool)
    change[1:-1] = token[1:] != token[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    long = (np.diff(edges) >= LEAST_RUN) & token[edges[:-1]]
    return edges[:-1][long], edges[1:][long]


def scan(raw: bytes, runs: list[tuple[int, int]]) -> tuple[list[Span], list[Span]]:
    """Fixed spans and all spans of one text, in code points."""
    fixed = fixed_spans(raw, runs)
    more = entropy_spans(raw, runs, fixed) if runs else []
    return _points(raw, fixed), _points(raw, fixed + more)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, plus n_assign, n_access, n_hex, base_sha256 (of the fixed
    spans, written kind:start:end), spans (all, written so) and ``secrets`` (all, as structs).

    Places are code points, ends exclusive, spans in order of start and kind. NULL text counts
    as empty: no spans. Equal spans of several kinds are all listed. Columns of ``docs`` named
    like new ones are replaced. One narrow pass over whole texts; a text is read a fixed number
    of times, whatever it holds.
    """
    new = {
        "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string",
        "spans": "string", "secrets": _SPANS,
    }
    kept = [f for f in docs.schema if f.name != text and f.name not in new]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            data, offsets = text_buffers(batch.column(text))
            raw = data.tobytes()
            starts, ends = token_runs(data, offsets)
            mine = np.searchsorted(starts, offsets)
            out: dict[str, list] = {n: [] for n in new}
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                at = slice(mine[i], mine[i + 1])
                fixed, spans = scan(raw[a:b], list(zip((starts[at] - a).tolist(), (ends[at] - a).tolist())))
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s.kind == k for s in fixed))
                out["base_sha256"].append(hashlib.sha256(_joined(fixed).encode()).hexdigest())
                out["spans"].append(_joined(spans))
                out["secrets"].append([s._asdict() for s in spans])
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [kind]
            yield replaced(batch, [text], {n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in new.items()])
    return docs.select(*[f"`{f.name}`" for f in kept], f"`{text}`").mapInArrow(run, schema)
