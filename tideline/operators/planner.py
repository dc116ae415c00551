"""Scan planning: which data types and which key prefix a filter can need, as extra conjuncts and reader specs.

The conjuncts repeat what the filter implies, so they change no result. They are plain comparisons, which reach
partition pruning and the file scan where a disjunction with regular expressions can't.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .filters import Filter, predicate

TYPES = ["string", "list", "hash", "set", "zset", "stream"]
# Other spellings of types, and the type that an action of a snapshot writes.
SPELLINGS = {"string": "string", "strings": "string", "list": "list", "lists": "list", "hash": "hash", "hashes": "hash", "set": "set", "sets": "set", "zset": "zset", "zsets": "zset", "stream": "stream", "streams": "stream"}
ACTION_TYPES = {"set": "string", "rpush": "list", "lpush": "list", "hmset": "hash", "hset": "hash", "sadd": "set", "zadd": "zset", "xadd": "stream"}
INTERNAL_PREFIX = "_internal:slotkey:4migrate:"


@dataclass(frozen=True)
class ReaderSpec:
    types: tuple[str, ...]
    pattern: str


def needed_types(f: Filter | None) -> set[str]:
    """Types that some group can accept; a group whose types and actions tell nothing needs all."""
    if f is None or not f.groups:
        return set(TYPES)
    out: set[str] = set()
    for g in f.groups:
        named = {SPELLINGS[t] for t in g.types if t in SPELLINGS}
        if not named and g.actions:
            derived = [ACTION_TYPES.get(a) for a in g.actions]
            named = set() if None in derived else set(derived)
        out |= named or set(TYPES)
    return out


def needed_prefix(f: Filter | None) -> str:
    """The beginning common to all keys that the groups accept; '' when any may be accepted."""
    if f is None or not f.groups or any(not g.keys or any(k.kind == "regex" for k in g.keys) for g in f.groups):
        return ""
    return os.path.commonprefix([k.text for g in f.groups for k in g.keys])


def pruned_predicate(f: Filter | None, key: Column, data_type: Column, action: Column, snapshot: bool = True) -> Column:
    """The filter with its implied conjuncts. In a log, rows of unknown or empty type pass any type list, so only the prefix is implied there."""
    out = predicate(f, key, data_type, action)
    if prefix := needed_prefix(f):
        out = key.startswith(prefix) & out
    types = needed_types(f)
    if snapshot and types != set(TYPES):
        out = data_type.isin(sorted(types)) & out
    return out


def pattern_of(prefix: str) -> str:
    prefix = prefix.strip()
    return prefix if "*" in prefix else prefix + "*"


def reader_specs(f: Filter | None, mode: str = "type", types: list[str] = (), prefixes: list[str] = ()) -> tuple[list[ReaderSpec], list[str]]:
    """What each reader of a snapshot would scan: explicit types and prefixes, else those derived. ``type`` has a reader a type."""
    warnings, mode = [], (mode or "single").strip().lower()
    if mode not in ("single", "type"):
        warnings.append(f"reader mode {mode!r} is taken as single")
        mode = "single"
    named = {SPELLINGS[t.strip().lower()] for t in types if t.strip().lower() in SPELLINGS}
    wanted = [t for t in TYPES if t in (named or needed_types(f))]
    patterns = [pattern_of(p) for p in prefixes if p.strip() and p.strip().lower() != "auto"] or [pattern_of(needed_prefix(f))]
    masks = [(t,) for t in wanted] if mode == "type" else [tuple(wanted)]
    return [ReaderSpec(m, p) for m in masks for p in patterns], warnings


def scan_predicate(specs: list[ReaderSpec], key: Column, data_type: Column) -> Column:
    """Keys that any reader would see, each once; keys of a running migration are internal."""
    from functools import reduce
    from operator import or_

    types = sorted({t for s in specs for t in s.types})
    like = lambda p: key.startswith(p[:-1]) if p.endswith("*") and "*" not in p[:-1] else key.rlike("^" + ".*".join(_quoted(x) for x in p.split("*")) + "$")
    patterns = sorted({s.pattern for s in specs})
    seen = F.lit(True) if "*" in patterns else reduce(or_, [like(p) for p in patterns])
    return data_type.isin(types) & seen & ~key.startswith(INTERNAL_PREFIX)


def _quoted(text: str) -> str:
    import re

    return re.escape(text)
