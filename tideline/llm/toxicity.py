"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values.

Fitting, on a bounded sample of labelled rows:
1. tokens are words and their beginnings of 4 to 6 letters (marked ``*``); a token's log-odds between the
   classes uses a Dirichlet prior in proportion to its overall frequency, and stays in the model only when
   its z-score and its log-odds are high. Other words score a negative drift;
2. every segment of a document that can't be extended or shortened without loss is found in linear time;
3. the maxima of clean documents give lambda and K by maximum likelihood: the best segment of n clean words stays
   below S with probability exp(-K n exp(-lambda S)), and documents without a segment count as below the least weight.
   So a segment of score S among n words has E = K n exp(-lambda S). A document's evidence is the sum of -ln E over its
   significant segments (E < max_e), or that of its best one;
4. a logistic curve over that evidence gives the score.

Null, empty and wordless texts have no segment and get the score of the least evidence. Whole texts are
scanned; equal texts get equal scores; repeated rows give repeated results; an empty table gives an empty result.
A label's key that several texts share stands for the smallest of them. With no labelled rows of both
classes the model has no tokens, and every score is the share of toxic labels (0.5 without any).
Only key and text are read from the documents, so other columns can't clash.
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

WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)


@dataclass
class Model:
    """What scoring needs; its tokens come from the bounded sample."""

    weights: dict[str, float] = field(default_factory=dict)
    drift: float = -0.5
    rate: float = 1.0
    log_k: float = 0.0
    max_e: float = 0.05
    slope: float = 0.0
    bias: float = 0.0


def tokens_of(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def word_scores(words: list[str], model: Model, cache: dict[str, float]) -> list[tuple[int, float]]:
    """Positions and scores of the words that score above zero."""
    out = []
    for i, w in enumerate(words):
        s = cache.get(w)
        if s is None:
            if len(cache) > 500_000:
                cache.clear()
            s = cache[w] = max((model.weights.get(t, 0.0) for t in tokens_of(w)), default=0.0)
        if s > 0:
            out.append((i, s))
    return out


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score), left to right, in time linear in the hits.

    Each hit starts a segment; it joins the nearest earlier one whose left sum is below its own, when that one's
    right sum isn't above its own, and everything between them (the rule of Ruzzo and Tompa). Stretches between
    hits all score the drift, so they only enter as gaps.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, place of the nearest with a lower sum before
    total, seen = 0.0, 0
    for i, s in hits:
        total += drift * (i - seen)
        first, left, total, seen = i, total, total + s, i + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]  # those between have sums before of this one's or more
            if j < 0 or stack[j][3] >= total:
                stack.append((first, i, left, total, j))
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, right - left) for a, b, left, right, _ in stack]


def evidence(found: list[tuple[int, int, float]], n: int, model: Model) -> tuple[float, list[tuple[int, int, float]]]:
    """Sum of -ln E over the significant segments, or of the best one when none is; and the significant ones."""
    if not found:
        return min(0.0, -(model.log_k + math.log(max(n, 1)))), []
    strength = [model.rate * s - model.log_k - math.log(max(n, 1)) for _, _, s in found]
    strong = [x for x in strength if x > -math.log(model.max_e)]
    return (sum(strong) if strong else max(strength)), [f for f, x in zip(found, strength) if x > -math.log(model.max_e)]


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int, key: str, label: str) -> DataFrame:
    """text, y of at most about ``limit`` labelled keys, chosen by a hash of the key."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    n = max(1, known.count())
    chosen = known.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_003)) < int(1_000_003 * min(1.0, limit / n)) + 1)
    return docs.select(key, "text").join(F.broadcast(chosen), key).groupBy(key, "y").agg(F.min("text").alias("text")).select("text", "y")  # bounded by limit


def fit(docs: DataFrame, labels: DataFrame, limit: int = 20_000, min_z: float = 4.0, min_odds: float = 2.0, prior: float = 0.1, key: str = "doc_id", label: str = "toxic") -> Model:
    """Learn a model; limit bounds the labelled rows."""
    from .common import forget, stored

    sample = stored(labelled_sample(docs, labels, limit, key, label).dropDuplicates(["text", "y"]), "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                found = set(words_of(text))
                seen[y > 0].update({t for w in found for t in tokens_of(w)})
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.string()), "y0": pa.array([seen[0][t] for t in terms], pa.int64()), "y1": pa.array([seen[1][t] for t in terms], pa.int64())})

    counts = stored(sample.mapInArrow(count, "term string, y0 long, y1 long").groupBy("term").agg(F.sum("y0").alias("y0"), F.sum("y1").alias("y1")), "toxic-terms")
    n0, n1 = (x or 0 for x in counts.agg(F.sum("y0"), F.sum("y1")).first())
    rows = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).first()
    share = (rows["y"] or 0) / rows["n"] if rows["n"] else 0.5
    model = Model(bias=math.log(max(share, 1e-6) / max(1 - share, 1e-6)) if 0 < share < 1 else (40.0 if share >= 1 else -40.0))
    if n0 and n1:
        a = F.lit(prior) * (F.col("y0") + F.col("y1"))  # pseudo-counts: this share of a token's own frequency
        odds = lambda y, n: F.log((y + a) / (F.lit(n + prior * (n0 + n1)) - y - a))
        delta = odds(F.col("y1"), n1) - odds(F.col("y0"), n0)
        z = delta / F.sqrt(1 / (F.col("y1") + a) + 1 / (F.col("y0") + a))
        kept = counts.where("y1 >= 3").select("term", delta.alias("d"), z.alias("z")).where((F.col("z") >= min_z) & (F.col("d") >= min_odds))
        model.weights = {r["term"]: float(r["d"]) for r in kept.collect()}
    if model.weights:
        model.drift = -0.25 * float(np.median(list(model.weights.values())))
        clean = sample.where("y = 0").mapInArrow(lambda batches: _maxima(batches, model), "n long, top double").where("n > 0").collect()
        model.rate, model.log_k = extreme_values([r["n"] for r in clean], [r["top"] for r in clean], min(model.weights.values()), max(model.weights.values()))
        judged = sample.mapInArrow(lambda batches: _evidence(batches, model), "y int, value double").collect()
        model.slope, model.bias = logistic([r["value"] for r in judged], [r["y"] for r in judged])
    forget(counts)
    forget(sample)
    return model


def _maxima(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Words and best segment of each text."""
    cache: dict[str, float] = {}
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            rows.append((len(words), max((s for _, _, s in segments(word_scores(words, model, cache), model.drift)), default=0.0)))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.float64())], names=["n", "top"])


def _evidence(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    cache: dict[str, float] = {}
    for batch in batches:
        words = [words_of(text) for text in batch.column("text").to_pylist()]
        values = [evidence(segments(word_scores(w, model, cache), model.drift), len(w), model)[0] for w in words]
        yield pa.RecordBatch.from_arrays([batch.column("y").cast(pa.int32()), pa.array(values, pa.float64())], names=["y", "value"])


def extreme_values(n: list[int], top: list[float], least: float, most: float) -> tuple[float, float]:
    """(lambda, ln K) of the Gumbel law of maxima ``top`` among ``n`` words, by maximum likelihood. A top of 0 is known only to lie below ``least``.

    For a given lambda the best K is the number of maxima seen over the sum of n exp(-lambda s), which leaves a concave
    function of lambda alone. One maximum of ``most`` among the mean number of words is added, so that text without any keeps a finite scale.
    """
    size = np.array([*n, max(1.0, float(np.mean(n)) if n else 1.0)])
    best = np.array([*top, most])
    seen = best > 0
    at, m, total = np.where(seen, best, least), int(seen.sum()), float(best[seen].sum())

    def slope(lam: float) -> float:
        weight = size * np.exp(-lam * (at - at.min()))
        return m / lam + m * float(np.dot(weight, at) / weight.sum()) - total

    lo, hi = 1e-6, 50.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if slope(mid) > 0 else (lo, mid)
    return lo, math.log(m) - float(np.log(np.dot(size, np.exp(-lo * (at - at.min()))))) + lo * float(at.min())


def logistic(x: list[float], y: list[int]) -> tuple[float, float]:
    """Slope and bias over tanh(x / 20), by Newton steps with a light ridge, which keeps separable classes finite."""
    squash, y = np.tanh(np.array(x) / 20), np.array(y, dtype=float)
    slope, bias = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * squash + bias, -40, 40)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([np.dot(p - y, squash) + 1e-3 * slope, np.sum(p - y) + 1e-3 * bias])
        h = np.array([[np.dot(w, squash**2) + 1e-3, np.dot(w, squash)], [np.dot(w, squash), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        slope, bias = slope - float(np.clip(step[0], -5, 5)), bias - float(np.clip(step[1], -5, 5))
    return slope, bias


def score_text(text: str | None, model: Model, cache: dict[str, float]) -> tuple[float, list[tuple[int, int, float]], int]:
    words = words_of(text)
    value, strong = evidence(segments(word_scores(words, model, cache), model.drift), len(words), model)
    return sigmoid(model.slope * math.tanh(value / 20) + model.bias), strong, len(words)


SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("score", T.DoubleType())]))


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """Per row: key, score, n_words and the significant passages as word spans. One narrow pass, no shuffle."""
    schema = T.StructType([docs.schema[key], T.StructField("score", T.DoubleType()), T.StructField("n_words", T.LongType()), T.StructField("passages", SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for batch in batches:
            made = [score_text(t, model, cache) for t in batch.column("text").to_pylist()]
            spans = pa.array([[{"first": a, "last": b, "score": s} for a, b, s in m[1]] for m in made], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([m[0] for m in made], pa.float64()), pa.array([m[2] for m in made], pa.int64()), spans], names=schema.names)

    return docs.select(key, "text").mapInArrow(run, schema)
