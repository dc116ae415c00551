"""URL filter: host rules first, then a weighted vocabulary found by Aho-Corasick.

A term counts where neither neighbour is an ASCII letter or digit. One strict term rejects; so do
``min_soft`` distinct soft ones. Repeats of one soft term count once. Nulls and urls without ``://``
have an empty host and path; a null url has no terms and is allowed. Duplicated rows are judged alike,
an empty table gives an empty result, and input columns that clash with output names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The default vocabulary and the host rules of the query.
STRICT_TERMS = ["adult", "casino", "hentai", "phishing", "porn", "spam", "viagra", "warez", "xxx"]
SOFT_TERMS = ["ads", "bet", "bets", "betting", "cheap", "crack", "escort", "free", "gamble", "jackpot", "keygen", "loans", "nude", "pharmacy", "pills", "poker", "sex", "slots", "torrent", "track", "win"]
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")] + [T.StructField("strict_hits", T.ArrayType(T.StringType())), T.StructField("soft_hits", T.ArrayType(T.StringType()))])
_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    host, tail = (rest[: min(ends)], rest[min(ends) :]) if ends else (rest, "")
    return host.translate(_TO_LOWER), tail.partition("#")[0].partition("?")[0]


def match_rule(host: str, path: str, rules: list[tuple[str, str]]) -> tuple[str | None, str | None]:
    """The verdict and text of the longest rule whose host is the url's or a parent of it and whose path starts the url's."""
    best: tuple[str | None, str | None] = (None, None)
    for verdict, rule in rules:
        own, slash, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + start) and len(rule) > len(best[1] or ""):
            best = verdict, rule
    return best


def build_automaton(strict: list[str], soft: list[str]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            machine.add_word(term, (kind, term))
    machine.make_automaton()
    return machine


def find_terms(machine, url: str) -> tuple[list[str], list[str]]:
    """The distinct strict and soft terms of a url, sorted."""
    text, hits = url.translate(_TO_LOWER), {"strict": set(), "soft": set()}
    inner = lambda i: 0 <= i < len(text) and text[i].isascii() and text[i].isalnum()
    for end, (kind, term) in machine.iter(text) if len(machine) else ():
        if not inner(end + 1) and not inner(end - len(term)):
            hits[kind].add(term)
    return sorted(hits["strict"]), sorted(hits["soft"])


def filter_urls(pages: DataFrame, strict=STRICT_TERMS, soft=SOFT_TERMS, rules=RULES, min_soft: int = 2, url: str = "url") -> DataFrame:
    """Add host, path, rule, verdict, strict_hits and soft_hits to each row; one narrow pass, no shuffle."""
    kept = pages.select(*[c for c in pages.columns if c not in SCHEMA.names or c == url])
    keep = [c for c in kept.columns if c not in SCHEMA.names]
    schema = T.StructType([kept.schema[c] for c in keep] + SCHEMA.fields)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = build_automaton(strict, soft)
        for batch in batches:
            out = []
            for text in batch.column(url).to_pylist():
                host, path = split_url(text)
                verdict, rule = match_rule(host, path, rules)
                hard, mild = find_terms(machine, text or "")
                verdict = verdict or ("block" if hard or len(mild) >= min_soft else "allow")
                out.append((host, path, rule, verdict, hard, mild))
            made = list(zip(*out)) if out else [()] * 6
            kinds = [pa.string()] * 4 + [pa.list_(pa.string())] * 2
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(list(v), k) for v, k in zip(made, kinds)], names=[*keep, *SCHEMA.names])

    return kept.mapInArrow(judge, schema)
