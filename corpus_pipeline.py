"""The corpus pipeline: documents pass the stages in order, each written and read again by the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontaminate, linededup, packing, rules, simhash
from tideline.llm.common import concluded, forget, load


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base check or the learned decision list rejects go."""
    return rules.keep_good(docs, rules.fit(docs, load(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier one equals or nearly equals go, and documents that lose all their text with them."""
    kept = linededup.dedup_lines(docs).where("n_lines_removed = 0 OR trim(text) <> ''")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose 5-word shingles are similar, the one with the smallest id stays."""
    return simhash.keep_first(docs, shingle=5, budget=20, similarity=0.8)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The layout of the kept documents in length buckets and token-budget batches."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", copies), ("benchmark decontamination", benchmark), ("packing", pack)]

#: The decision list is learned, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is stored before the next reads it, and nothing else of it is left."""
    docs = before = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = concluded(lambda: stage(spark, before, sf_dir), name.replace(" ", "-"))  # noqa: B023
        if name != STAGES[0][0]:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
