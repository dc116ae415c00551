"""Quality rules: base statistics and a learned decision list, all in Spark expressions.

Words are ``[^\\x20\\x09-\\x0D]+``. Statistics never leave the row: repeated 8-word windows are found by sorting
the windows' 64-bit hashes inside it, so nothing is shuffled. The list is learned by sequential covering from a
bounded, hash-chosen sample of labelled rows: a rule grows by the condition of the highest information gain on
one part of it and is pruned on the other. It comes out as one ordered CASE expression.

Null and empty texts have no words: all statistics are 0 and the base check fails. Duplicate rows are judged
alike, an empty table gives an empty result, and only key and text are read from the documents. Labels that
are null are ignored; without labels of both kinds the list is empty and all that pass the base check stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, split_words

WINDOW = 8
MIN_WORDS = 20
FEATURES = ["n_words", "mean_word", "symbol_rate", "upper_rate", "mark_rate", "digit_rate", "repeat_rate", "dup_line_rate", "same_word_rate"]


def repeated_places(pairs: str) -> Column:
    """Places in a column of (hash, place) pairs, sorted, whose hash equals a neighbour's.

    It is given names of columns, not expressions: inside a lambda an expression would be evaluated for every element.
    """
    alike = lambda k: F.get(F.col(pairs), k)["h"]
    twice = lambda p, k: (F.coalesce(alike(k - 1) == p["h"], F.lit(False))) | (F.coalesce(alike(k + 1) == p["h"], F.lit(False)))
    marked = F.transform(pairs, lambda p, k: F.when(twice(p, k), p["i"]))
    return F.array_sort(F.array_compact(marked))


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", whole_rows: bool = False) -> DataFrame:
    """One row a document: (with whole_rows, the input row as struct ``source_row``,) n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the learner's features."""
    left = lambda pattern: F.length(F.regexp_replace("t", pattern, ""))  # noqa: E731  what a pattern leaves
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    carried = [key, "source_row"] if whole_rows else [key]
    base = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("t"), *([F.struct(*docs.columns).alias("source_row")] if whole_rows else []))
    base = base.select(
        *carried, split_words(F.col("t")).alias("w"), lines.alias("lines"),
        left(SPACES).alias("word_chars"), left(r"[^#*$%&|<>]+").alias("n_symbols"),
        left(r"[^\p{Lu}]+").alias("n_upper"), left(r"[^!?]+").alias("n_marks"), left(r"[^0-9]+").alias("n_digits"),
    )
    n = F.size("w")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice("w", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    base = base.select("*", n.alias("n_words"), (n - F.size(F.array_distinct("w"))).alias("n_same_words"), windows.alias("h"), F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines")).drop("w", "lines")
    # only texts with a repeated window go on; each step is a column of its own, so that lambdas read values
    base = base.withColumn("pairs", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("h")
    base = base.withColumn("places", repeated_places("pairs")).drop("pairs")
    places = F.col("places")
    # each window start covers the words up to the next start, 8 at most
    covered = F.aggregate(F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x)
    base = base.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("places")
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    columns = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
        rate("word_chars", "n_words").alias("mean_word"), rate("n_symbols", "n_words").alias("symbol_rate"), rate("n_upper", "word_chars").alias("upper_rate"),
        rate("n_marks", "n_words").alias("mark_rate"), rate("n_digits", "word_chars").alias("digit_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"), rate("n_dup_lines", "n_lines").alias("dup_line_rate"), rate("n_same_words", "n_words").alias("same_word_rate"),
    ]
    # a generator, since a later filter would be pushed through a projection, and the steps above inlined into one another
    return base.select(*carried, F.inline_outer(F.array(F.struct(*columns))))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def holds(self, row: dict) -> bool:
        return (row[self.feature] > self.threshold) is self.above

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def thresholds(values: list[float], most: int = 32) -> list[float]:
    """Midpoints between neighbouring distinct values, at most ``most``, evenly spread over the ranks."""
    distinct = sorted(set(values))
    middle = [(a + b) / 2 for a, b in zip(distinct, distinct[1:])]
    return middle if len(middle) <= most else [middle[(i * (len(middle) - 1)) // (most - 1)] for i in range(most)]


def grow(rows: list[dict], bad: list[bool], features: list[str], max_conditions: int) -> Rule:
    """Add the condition of the highest information gain until no good row is covered or nothing gains."""
    rule: Rule = ()
    inside = list(range(len(rows)))
    while len(rule) < max_conditions:
        p0 = sum(bad[i] for i in inside)
        if not p0 or p0 == len(inside):
            break
        before, best = math.log2(p0 / len(inside)), (1e-9, None)
        for f in features:
            ordered = sorted((rows[i][f], bad[i]) for i in inside)
            cuts, at, p, n = thresholds([v for v, _ in ordered]), 0, 0, 0
            for cut in cuts:
                while at < len(ordered) and ordered[at][0] <= cut:
                    p, n, at = p + ordered[at][1], n + 1, at + 1
                for above, pp, nn in ((False, p, n), (True, p0 - p, len(inside) - n)):
                    if pp and (gain := pp * (math.log2(pp / nn) - before)) > best[0]:
                        best = (gain, Condition(f, above, cut))
        if best[1] is None:
            break
        rule = (*rule, best[1])
        inside = [i for i in inside if best[1].holds(rows[i])]
    return rule


def prune(rule: Rule, rows: list[dict], bad: list[bool]) -> Rule:
    """The beginning of the rule with the best (p - n) / (p + n) on held-back rows; the shortest of equals."""

    def worth(r: Rule) -> float:
        hit = [b for x, b in zip(rows, bad) if covers(r, x)]
        return (2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth, default=())


def learn(rows: list[dict], features: list[str] = FEATURES, min_precision: float = 0.9, min_cover: int = 5, max_rules: int = 12, max_conditions: int = 4) -> list[Rule]:
    """Ordered rules for label 0. Every third row is held back for pruning; a rule stays if its precision over both parts is high."""
    out: list[Rule] = []
    left = rows
    while len(out) < max_rules:
        bad = [r["y"] == 0 for r in left]
        if sum(bad) < min_cover:
            break
        grown = grow([r for i, r in enumerate(left) if i % 3], [b for i, b in enumerate(bad) if i % 3], features, max_conditions)
        rule = prune(grown, left[::3], bad[::3]) if grown else ()
        hit = [b for r, b in zip(left, bad) if covers(rule, r)]
        if not rule or sum(hit) < max(min_cover, min_precision * len(hit)):
            break
        out.append(rule)
        left = [r for r in left if not covers(rule, r)]
    return out


def fit(docs: DataFrame, labels: DataFrame, limit: int = 10_000, key: str = "doc_id", label: str = "quality") -> list[Rule]:
    """Learn the list from about ``limit`` labelled rows at most; only their statistics reach the driver."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).cast("int").alias("y"))
    n = max(1, known.count())
    chosen = known.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_003)) < int(1_000_003 * min(1.0, limit / n)) + 1)
    # bounded by limit; of several texts that share a key, the smallest stands for it
    sample = docs.select(key, "text").join(F.broadcast(chosen), key).groupBy(key).agg(F.min("text").alias("text"))
    rows = statistics(sample, key).where(f"n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= 30 * n_words").join(F.broadcast(chosen), key)
    found = [r.asDict() for r in rows.select(key, "y", *FEATURES).collect()]
    return learn(sorted(found, key=lambda r: (hash_order(r[key]), r["y"])))


def hash_order(value) -> int:
    """A fixed shuffle of integer or text keys."""
    import zlib

    return zlib.crc32(str(value).encode())


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional: the number (from 1) of the first rule that fires, else null."""
    out = None
    for k, rule in enumerate(rules, 1):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(k)) if out is None else out.when(test, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, rules: list[Rule], key: str = "doc_id", whole_rows: bool = False) -> DataFrame:
    """statistics() with base_failed, rule (the number of the rule that rejects, else null) and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return statistics(docs, key, whole_rows=whole_rows).withColumn("base_failed", failed).withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, rules: list[Rule], key: str = "doc_id") -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(docs, rules, key, whole_rows=True).where("kept").select("source_row.*")
