"""The filter language: groups of key, type and action conditions, compiled into one predicate.

A row passes when no exclude matches its key, and there are no groups or one group's conditions all hold. A value
ending in * with nothing special before it is a prefix; a value with a special character is a regular expression,
searched anywhere; any other is exact. Invalid parts are skipped with a warning, and a filter left empty passes all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.commands import ascii_lower

SPECIAL = set(".+?^$()[]{}|\\*")
#: What linear-time expression engines reject but the JVM's accepts: lookaround, atomic groups, back references, possessive quantifiers.
BACKTRACKING = re.compile(r"\(\?(?:[=!>]|<[=!])|\\[1-9]|\\k<|[*+?}]\+")
#: A brace that begins a repetition; any other is a plain character in the filter language, but not in the JVM's.
REPETITION = re.compile(r"\{\d+(?:,\d*)?\}")
NAMED_CLASS = re.compile(r"\[:(\^?)(\w+):\]")
FLAGS = re.compile(r"\(\?([imsU]*)(?:-([imsU]+))?([:)])")
BLANKS = r"\t\n\f\r "
_TO_JVM = {"word": r"\w", "ascii": r"\p{ASCII}", "xdigit": r"\p{XDigit}"}


def translated(text: str) -> tuple[str, str]:
    """The expression as the JVM writes it, and as Python does, whose parser tests it.

    In the filter language a line ends at \\n alone, $ is the end of the text unless (?m) is on, \\s has no vertical tab, letter case
    folds beyond ASCII, and (?U) only changes which of several matches is found.
    """
    jvm, plain, at, inside = ["(?d)"], [], 0, False
    lines = [False]  # whether (?m) is on, in each open group

    def put(n: int, j: str, p: str | None = None):
        nonlocal at
        jvm.append(j), plain.append(j if p is None else p)
        at += n

    while at < len(text):
        c, two = text[at], text[at : at + 2]
        if two == r"\Q":
            end = text.find(r"\E", at)
            literal = text[at + 2 : end if end >= 0 else len(text)]
            put((end + 2 if end >= 0 else len(text)) - at, re.escape(literal))
        elif two in (r"\s", r"\S"):
            inner = f"[{'^' if two == r'\S' else ''}{BLANKS}]"
            put(2, inner, "w" if inside else None)
        elif two == r"\z":
            put(2, r"\z", r"\Z")
        elif m := re.compile(r"\\[pP](?:\{\^?\w+\}|\w)").match(text, at):
            put(m.end() - at, re.sub(r"\\p\{\^", r"\\P{", m[0]), "w")
        elif c == "\\":
            put(2, two)
        elif inside:
            if m := NAMED_CLASS.match(text, at):
                name = _TO_JVM.get(m[2]) or rf"\p{{{m[2].capitalize()}}}"
                put(m.end() - at, (f"[^{name}]" if m[1] else name), "w")
            elif c == "]" and at > opened:
                inside = False
                put(1, c)
            else:
                put(1, "\\" + c if c in "[&]" else c)
        elif c == "[":
            inside, start = True, 2 if text[at + 1 : at + 2] == "^" else 1
            opened = at + start  # a ] just here is a plain one
            put(start, text[at : at + start])
        elif m := FLAGS.match(text, at):
            on = "m" in m[1] or (lines[-1] and "m" not in (m[2] or ""))
            if m[3] == ":":
                lines.append(on)
            else:
                lines[-1] = on
            own, off = m[1].replace("U", "").replace("i", "iu"), (m[2] or "").replace("U", "").replace("i", "iu")
            put(m.end() - at, f"(?{own}{'-' + off if off else ''}{m[3]}" if own or off or m[3] == ":" else "", "(?:" if m[3] == ":" else "")
        elif text.startswith("(?P<", at):
            lines.append(lines[-1])
            put(4, "(?<", "(?P<")
        elif c == "(":
            lines.append(lines[-1])
            put(1, c)
        elif c == ")":
            lines[:] = lines[:-1] or [False]
            put(1, c)
        elif c == "$":
            put(1, "$" if lines[-1] else r"\z", "$")
        elif c == "{" and not REPETITION.match(text, at):
            put(1, r"\{")
        else:
            put(1, c)
    return "".join(jvm), "".join(plain)


def check_pattern(text: str) -> None:
    """ValueError for what a linear-time engine can't run, or can't parse."""
    bare = re.sub(r"\\Q.*?(?:\\E|$)", "w", text, flags=re.DOTALL)
    if BACKTRACKING.search(bare):
        raise ValueError("needs backtracking")
    if re.search(r"(?<!\\)\(\?(?![imsU:-]|P<)", bare):
        raise ValueError("unknown flag")
    try:
        re.compile(translated(text)[1])
    except re.error as e:
        raise ValueError(str(e)) from e


@dataclass(frozen=True)
class KeyMatch:
    kind: str  # exact, prefix or regex
    text: str

    def column(self, key: Column) -> Column:
        if self.kind == "regex":
            return key.cast("string").rlike(translated(self.text)[0])
        return key == F.lit(self.text) if self.kind == "exact" else key.startswith(self.text)


@dataclass
class Group:
    keys: list[KeyMatch] = field(default_factory=list)
    types: list[str] = field(default_factory=list)
    actions: list[str] = field(default_factory=list)


@dataclass
class Filter:
    groups: list[Group] = field(default_factory=list)
    excludes: list[KeyMatch] = field(default_factory=list)


def parse_key(text: str) -> KeyMatch:
    """Raises ValueError for an expression that can't be used."""
    text = text.strip()
    if text.endswith("*") and not SPECIAL & set(text[:-1]):
        return KeyMatch("prefix", text[:-1])
    if not SPECIAL & set(text):
        return KeyMatch("exact", text)
    check_pattern(text)
    return KeyMatch("regex", text)


def parse_keys(text: str, warnings: list[str]) -> list[KeyMatch]:
    """Comma-separated patterns, cheap kinds before expressions."""
    out = []
    for part in filter(None, map(str.strip, text.split(","))):
        try:
            out.append(parse_key(part))
        except ValueError as e:
            warnings.append(f"key pattern {part!r} is skipped: {e}")
    return sorted(out, key=lambda m: m.kind == "regex")


def parse_group(spec: str, warnings: list[str]) -> Group | None:
    """One group, or None when no condition of it is valid."""
    group, any_valid = Group(), False
    for part in filter(None, map(str.strip, spec.split(";"))):
        name, found, value = part.partition("=")
        name = name.strip().lower()
        if not found:
            warnings.append(f"no '=' in {part!r}")
        elif name == "key":
            keys = parse_keys(value, warnings)
            group.keys += keys
            any_valid |= bool(keys)
        elif name in ("type", "action"):
            values = [v.lower() for v in map(str.strip, value.split(",")) if v]
            getattr(group, name + "s").extend(values)
            any_valid |= bool(values)
            if not values:
                warnings.append(f"no values for {name}")
        else:
            warnings.append(f"unknown field {name!r}")
    if not any_valid:
        warnings.append(f"no valid condition in {spec!r}")
    return group if any_valid else None


def build(groups: list[str], excludes: list[str]) -> tuple[Filter | None, list[str]]:
    """The filter (None passes all) and the warnings."""
    warnings: list[str] = []
    made = Filter([g for g in (parse_group(s, warnings) for s in groups) if g], [k for s in excludes for k in parse_keys(s, warnings)])
    made.excludes.sort(key=lambda m: m.kind == "regex")
    return (made if made.groups or made.excludes else None), warnings


def _among(value: Column, allowed: list[str], also: list[str]) -> Column:
    """An empty value always passes."""
    return ascii_lower(F.coalesce(value, F.lit(""))).isin(["", *allowed, *also])


def predicate(f: Filter | None, key: Column, data_type: Column, action: Column) -> Column:
    """What the filter means, without hints for pruning."""
    if f is None:
        return F.lit(True)
    present = F.coalesce(key, F.lit("").cast("string"))
    parts = []
    if f.groups:
        one = []
        for g in f.groups:
            conditions = []
            if g.keys:
                conditions.append(reduce(or_, [k.column(present) for k in g.keys]))
            if g.types:
                conditions.append(_among(data_type, g.types, ["unknown"]))
            if g.actions:
                conditions.append(_among(action, g.actions, []))
            one.append(reduce(and_, conditions))
        parts.append(reduce(or_, one))
    if f.excludes:
        parts.append(~reduce(or_, [k.column(present) for k in f.excludes]))
    return reduce(and_, parts)
