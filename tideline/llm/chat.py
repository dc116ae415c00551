"""Chat formatting: roles of a raw transcript by a hidden Markov model, then canonical turns.

States are a role's first line and its further lines. A line's features are the speaker marker at its start, whether
an empty line precedes it, its length class and whether it asks. The model is counted, with add-one smoothing, on a
bounded sample of labelled conversations; Viterbi finds the likeliest states, and each run of a first line with its
further ones becomes a turn without its marker.

Null and empty transcripts have no turns. Blank lines belong to no turn unless text of the same turn follows. Equal
transcripts give equal turns; an empty table gives an empty result; columns other than key and text pass through
unless they clash with the output's. Without training rows every transition and feature is equally likely, and
markers alone, which name their role, decide. Roles that are null or not among ROLES are written as the user's; null
turns come first. Turn marks inside a text are written apart (``<\\|im_``), so that no text can open a turn.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLES = ["system", "user", "assistant", "tool"]
STATES = 2 * len(ROLES)
# The names that mark a speaker, by role.
SPEAKERS = {"system": ["system", "instructions"], "user": ["user", "human", "you", "prompter", "question", "q", "instruction"], "assistant": ["assistant", "ai", "bot", "model", "answer", "a", "response", "gpt"], "tool": ["tool", "function", "observation"]}
NAMES = {name: role for role, names in SPEAKERS.items() for name in names}
MARKER = re.compile(r"\s*(?:<\|\s*(%s)\s*\|>|(?:#{1,4}\s*|\*\*|\[)?(%s)(?:\*\*|\])?\s*:(?:\*\*)?)\s*" % (("|".join(sorted(NAMES, key=len, reverse=True)),) * 2), re.IGNORECASE)


@dataclass
class Model:
    """Log-probabilities over the states: role * 2, plus 1 for further lines."""

    start: np.ndarray = field(default_factory=lambda: np.array([0.0, -20.0] * len(ROLES)))
    move: np.ndarray = field(default_factory=lambda: np.array([[0.0 if t % 2 == 0 or t // 2 == s // 2 else -20.0 for t in range(STATES)] for s in range(STATES)]))
    emit: dict[str, np.ndarray] = field(default_factory=dict)


def marker(line: str) -> tuple[str, str]:
    """The role that a line's marker names ('' if none), and the line without it."""
    m = MARKER.match(line)
    return (NAMES[(m[1] or m[2]).lower()], line[m.end() :]) if m else ("", line)


def features(lines: list[str]) -> list[tuple[int, list[str]]]:
    """(line number, features) of each line that isn't blank."""
    out, blank = [], True
    for i, line in enumerate(lines):
        if line.strip():
            role, rest = marker(line)
            size = min(3, int(math.log2(1 + len(rest.strip()) / 40)))
            gap = "first" if i == 0 else "gap" if blank else "none"
            # marker and gap are one feature: where markers are used, a plain line after no gap begins no turn
            out.append((i, [f"marker {role} {gap}", f"size {size}", f"asks {rest.rstrip().endswith('?')}"]))
            blank = False
        else:
            blank = True
    return out


def emission(model: Model, found: list[str]) -> np.ndarray:
    score = np.zeros(STATES)
    for f in found:
        if f in model.emit:
            score = score + model.emit[f]
    role = found[0].split(" ")[1]
    if role:  # a marker names its role; only a likelier reading as plain text can win
        score = score + np.array([0.0 if r == role and s == 0 else -6.0 for r in ROLES for s in (0, 1)])
    return score


def viterbi(model: Model, rows: list[list[str]]) -> list[int]:
    """The likeliest states; ties take the earlier state."""
    if not rows:
        return []
    best, back = model.start + emission(model, rows[0]), []
    for found in rows[1:]:
        ways = best[:, None] + model.move
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0) + emission(model, found)
    state = int(best.argmax())
    out = [state]
    for step in reversed(back):
        state = int(step[state])
        out.append(state)
    return out[::-1]


def parse(text: str | None, model: Model) -> list[tuple[str, str]]:
    """(role, text) of each turn."""
    lines = (text or "").split("\n")
    rows = features(lines)
    turns: list[tuple[str, int, int]] = []
    for (i, _), state in zip(rows, viterbi(model, [f for _, f in rows])):
        if state % 2 == 0 or not turns:
            turns.append((ROLES[state // 2], i, i))
        else:
            turns[-1] = (*turns[-1][:2], i)
    return [(role, "\n".join([marker(lines[a])[1], *lines[a + 1 : b + 1]]).strip()) for role, a, b in turns]


def canonical(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|im_start|>{role}\n{text.replace('<|im_', '<\\|im_')}<|im_end|>\n" for role, text in turns)


# ---- transcripts from conversations -------------------------------------------------------------------------

STYLES = [
    lambda role, text: {"system": "System: ", "user": "User: ", "assistant": "Assistant: ", "tool": "Tool: "}[role] + text,
    lambda role, text: {"system": "### System:\n", "user": "### Human:\n", "assistant": "### Response:\n", "tool": "### Function:\n"}[role] + text,
    lambda role, text: f"<|{role}|>\n{text}",
    lambda role, text: {"system": "Instructions: ", "user": "Q: ", "assistant": "A: ", "tool": "Observation: "}[role] + text,
    lambda role, text: text,
]


def transcript(turns: list[tuple[str, str]], style: int) -> tuple[str, list[int]]:
    """A raw transcript of known turns and the state of each of its lines (-1: blank). The last style has no markers, only gaps."""
    lines, states = [], []
    for role, text in turns:
        role = role if role in ROLES else "user"
        own = STYLES[style % len(STYLES)](role, text or "").split("\n")
        first = True
        for line in own:
            lines.append(line)
            states.append((2 * ROLES.index(role) + (not first)) if line.strip() else -1)
            first = first and not line.strip()
        if style % 2 == 0:
            lines.append("")
            states.append(-1)
    return "\n".join(lines), states


def conversations_of(table: DataFrame, key: str = "conv_id") -> DataFrame:
    """key, turns of each conversation, in order. A conversation is one row whatever its length."""
    return table.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def style_of(value) -> int:
    import zlib

    return zlib.crc32(str(value).encode()) % len(STYLES)


def render(table: DataFrame, key: str = "conv_id") -> DataFrame:
    """key, n_turns and a raw transcript, in a style fixed by the key."""
    turns = conversations_of(table, key)
    schema = T.StructType([turns.schema[key], T.StructField("n_turns", T.LongType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [[(t["role"], t["text"]) for t in row] for row in batch.column("turns").to_pylist()]
            text = [transcript(m, style_of(k))[0] for m, k in zip(made, batch.column(key).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([len(m) for m in made], pa.int64()), pa.array(text, pa.string())], names=schema.names)

    return turns.mapInArrow(run, schema)


def fit(table: DataFrame, limit: int = 4_000, key: str = "conv_id") -> Model:
    """Count the model on the conversations of about ``limit`` keys at most, each in every style."""
    n = max(1, table.select(key).distinct().count())
    chosen = table.where(F.pmod(F.xxhash64(F.col(key), F.lit("fit")), F.lit(1_000_003)) < int(1_000_003 * min(1.0, limit / n)) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for row in batch.column("turns").to_pylist():
                for style in range(len(STYLES)):
                    text, states = transcript([(t["role"], t["text"]) for t in row], style)
                    before = None
                    for i, found in features(text.split("\n")):
                        s = states[i]
                        seen[("start", "", s) if before is None else ("move", str(before), s)] += 1
                        for f in found:
                            seen[("emit", f, s)] += 1
                        before = s
        rows = list(seen.items())
        yield pa.RecordBatch.from_pydict({"kind": pa.array([k[0] for k, _ in rows], pa.string()), "given": pa.array([k[1] for k, _ in rows], pa.string()), "state": pa.array([k[2] for k, _ in rows], pa.int32()), "n": pa.array([v for _, v in rows], pa.int64())})

    counts = conversations_of(chosen, key).mapInArrow(count, "kind string, given string, state int, n long").groupBy("kind", "given", "state").agg(F.sum("n").alias("n")).collect()  # some 150 rows
    model = Model()
    start, move, emit = np.ones(STATES), np.ones((STATES, STATES)), {}
    for r in counts:
        if r["kind"] == "start":
            start[r["state"]] += r["n"]
        elif r["kind"] == "move":
            move[int(r["given"]), r["state"]] += r["n"]
        else:
            emit.setdefault(r["given"], np.ones(STATES))[r["state"]] += r["n"]
    if counts:
        model.start, model.move = np.log(start / start.sum()), np.log(move / move.sum(axis=1, keepdims=True))
        for group in {f.split(" ")[0] for f in emit}:
            total = sum(v for f, v in emit.items() if f.split(" ")[0] == group)
            model.emit.update({f: np.log(v / total) for f, v in emit.items() if f.split(" ")[0] == group})
    return model


TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


def format_chats(transcripts: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The input columns but text, with turns (role, text) and the canonical rendering. One narrow pass."""
    keep = [c for c in transcripts.columns if c not in (text, "turns", "rendered")]
    schema = T.StructType([*(transcripts.schema[c] for c in keep), T.StructField("turns", TURNS), T.StructField("rendered", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [parse(t, model) for t in batch.column(text).to_pylist()]
            turns = pa.array([[{"role": r, "text": t} for r, t in m] for m in made], pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), turns, pa.array([canonical(m) for m in made], pa.string())], names=schema.names)

    return transcripts.select(*keep, text).mapInArrow(run, schema)
