"""URL filters (method: pattern rules indexed by their rarest literal token).

Each rule is a regular expression with the literal tokens that every URL it fits must hold. A
rule is filed under the one of them that the fewest URLs of the corpus have. The tokens of a
URL fetch the rules filed under them, and only those expressions are run.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = r"[0-9a-z]+"


class Rule(NamedTuple):
    name: str           # as reported
    verdict: str        # allow or block
    pattern: str        # over host + "\t" + path; RE2 and Python agree on it
    tokens: tuple[str, ...]
    rank: int           # the highest rank that fits wins
    reported: bool      # whether the name goes into the rule column


def host_rule(text: str, verdict: str) -> Rule:
    """Rule "host/path": fits the host, its subdomains, and paths that begin with the path.
    A longer text wins, and any such rule wins over patterns."""
    host, slash, path = text.partition("/")
    pattern = rf"^(.*\.)?{re.escape(host)}\t{re.escape(slash + path)}"
    # the last word of the path may go on in the URL ("en/1" fits "en/17"), so it is no token
    whole = re.findall(TOKEN, host) + re.findall(TOKEN + r"(?=[^0-9a-z])", path.lower())
    return Rule(text, verdict, pattern, tuple(whole), 1_000_000 + len(text), True)


def host_words(*words: str, verdict: str = "block", rank: int = 10) -> list[Rule]:
    """Rules for hosts with a label made up of these words, joined by hyphens, alone or
    among others: casino fits casino.example.org and my-casino-win.example.org."""
    out = []
    for w in words:
        label = re.escape(w).replace(r"\-", "-")
        out.append(Rule(f"host:{w}", verdict, rf"^(.*[.-])?{label}([.-].*)?\t", tuple(w.split("-")), rank, False))
    return out


def path_words(*words: str, verdict: str = "block", rank: int = 5) -> list[Rule]:
    """Rules for paths with such a segment, up to its extension."""
    out = []
    for w in words:
        part = re.escape(w).replace(r"\-", "-")
        out.append(Rule(f"path:{w}", verdict, rf"\t(.*/)?{part}(/|\.[a-z]+$|$)", tuple(w.split("-")), rank, False))
    return out


#: The rules of the registered query: host rules first, then patterns for kinds of hosts and
#: pages that carry no prose.
RULES = [
    host_rule("org/", "allow"), host_rule("example.org/es/", "block"),
    host_rule("example.org/en/1", "block"), host_rule("com/fr/", "allow"),
    host_rule("com/de/", "block"),
    *host_words("spam", "spam-farm", "link-farm", "adult", "adult-x", "xxx", "porn", "sex", "escort",
                "casino", "casino-win", "poker", "slots", "betting", "lottery", "pills", "cheap-pills",
                "viagra", "cialis", "pharmacy-online", "replica", "payday-loan", "warez", "torrent",
                "ads", "ads-track", "adserver", "doubleclick", "banner", "click-track", "tracker", "telemetry",
                "phishing", "malware"),
    *path_words("login", "signin", "signup", "logout", "register", "cart", "checkout", "wp-admin", "wp-login",
                "xmlrpc", "cgi-bin", "autodiscover"),
    *host_words("edu", "gov", verdict="allow", rank=20),
]


def url_parts(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column; both empty without ``://`` or for NULL."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, capitals, capitals.lower()), path


def token_frequencies(parts: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """In how many rows of ``parts`` (host, path) each token of ``rules`` occurs. What reaches
    the driver is one number per such token, however many URLs there are."""
    wanted = sorted({t for r in rules for t in r.tokens})
    tokens = F.array_distinct(F.regexp_extract_all(
        F.lower(F.concat_ws("\t", "host", "path")), F.lit(f"({TOKEN})"), 1))
    # the rules' own tokens are a fixed, short list
    counted = parts.select(F.explode(F.array_intersect(tokens, F.array(*[F.lit(t) for t in wanted]))).alias("t"))
    return {t: 0 for t in wanted} | {r["t"]: r["count"] for r in counted.groupBy("t").count().collect()}


class Index:
    """Rules by their rarest literal token; those without one are always run."""

    def __init__(self, rules: list[Rule], frequency: dict[str, int]):
        self.rules = sorted(rules, key=lambda r: (-r.rank, r.name))
        self.by_token: dict[str, list[int]] = defaultdict(list)
        for i, rule in enumerate(self.rules):
            rarest = min(rule.tokens, key=lambda t: (frequency.get(t, 0), t), default="")
            self.by_token[rarest].append(i)
        self._token = re.compile(TOKEN)
        self._patterns = [re.compile(r.pattern, re.S) for r in self.rules]

    def __reduce__(self):
        return _index, (self.rules, dict(self.by_token))

    def best(self, host: str, path: str) -> Rule | None:
        text = f"{host}\t{path}"
        found = {t for t in self._token.findall(text.lower())}
        candidates = {i for t in (*found, "") for i in self.by_token.get(t, ())}
        return next((self.rules[i] for i in sorted(candidates) if self._patterns[i].search(text)), None)


def _index(rules: list[Rule], by_token: dict[str, list[int]]) -> Index:
    index = Index(rules, {})
    index.by_token = defaultdict(list, by_token)
    return index


def judge_urls(pages: DataFrame, rules: list[Rule] = RULES, key: str = "page_id", url: str = "url",
               otherwise: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict, matched) for every row of ``pages``.

    ``rule`` is the host rule that decided, else NULL; ``matched`` names whatever rule did;
    without any the verdict is ``otherwise``. NULL URLs and those without ``://`` have an
    empty host and path and meet no rule. Repeated rows are judged each. Two narrow passes
    over the URL column (token frequencies, then verdicts), nothing is shuffled but one
    count per rule token.
    """
    host, path = url_parts(url)
    parts = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    index = Index(rules, token_frequencies(parts, rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [index.best(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([
                *batch.columns,
                pa.array([r.name if r and r.reported else None for r in best], pa.string()),
                pa.array([r.verdict if r else otherwise for r in best], pa.string()),
                pa.array([r.name if r else None for r in best], pa.string()),
            ], names=[key, "host", "path", "rule", "verdict", "matched"])

    kind = pages.schema[key].dataType.simpleString()
    return parts.mapInArrow(
        run, f"`{key}` {kind}, host string, path string, rule string, verdict string, matched string")


def rules_sql(rules: list[Rule] = RULES) -> str:
    """The same rules as a list of SQL values (name, verdict, pattern, rank, reported)."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    return ",\n".join(
        f"({quoted(r.name)}, {quoted(r.verdict)}, {quoted(r.pattern)}, {r.rank}, {str(r.reported).lower()})"
        for r in rules)
