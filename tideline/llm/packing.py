"""Sequence packing: optimal length buckets, then token-budget batches inside each bucket.

Texts are read once, for their lengths; only the lengths' histogram (a row a distinct length, so of n tokens in all fewer than
sqrt(2 n) rows) reaches the driver, where dynamic programming picks the bucket boundaries with the least padding. Every document gets a
place: nothing is truncated, and a document longer than the budget makes a batch of its own. Null and empty
texts have length 0 and fall in the first bucket, whose sequences still occupy one slot. Equal lengths share a
bucket; repeated rows each get a slot, and so do rows without a key; an empty table gives an empty result; clashing
input columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

def optimal_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper boundaries of at most ``buckets`` intervals with the least total padding.

    cost(i, j) pads the lengths i..j-1 to the last of them. It is a Monge cost, so each of the rows of the
    table is filled by divide and conquer: O(buckets * n log n). Ties take the earliest split.
    """
    n = len(lengths)
    if not n:
        return []
    size, count = np.asarray(lengths, dtype=np.float64), np.concatenate([[0.0], np.cumsum(counts, dtype=np.float64)])
    total = np.concatenate([[0.0], np.cumsum(size * np.asarray(counts, dtype=np.float64))])

    def cost(i, j: int):
        return size[j - 1] * (count[j] - count[i]) - (total[j] - total[i])

    best = np.array([0.0] + [cost(0, j) for j in range(1, n + 1)])
    splits = []
    for _ in range(min(buckets, n) - 1):
        row, frm, work = best.copy(), np.zeros(n + 1, dtype=np.int64), [(1, n, 0, n - 1)]
        while work:
            lo, hi, left, right = work.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(left, min(mid - 1, right) + 1)
            value = best[i] + cost(i, mid)
            at = int(np.argmin(value))
            row[mid], frm[mid] = value[at], i[at]
            work += [(lo, mid - 1, left, int(i[at])), (mid + 1, hi, int(i[at]), right)]
        splits.append(frm)
        best = row
    out, j = [], n
    for frm in reversed(splits):
        out.append(int(lengths[j - 1]))
        j = int(frm[j])
        if j == 0:
            break
    if j:
        out.append(int(lengths[j - 1]))
    return sorted(out)


def sizes(docs: DataFrame, text: str, key: str, count=None) -> DataFrame:
    """key, n_tokens and row (a number inside the task, which tells repeated rows apart). count: maps an Arrow array of texts to one of token counts; runs of non-blank characters by default."""
    count = count or (lambda texts: pc.count_substring_regex(texts, r"[^\x20\x09-\x0D]+"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.fill_null(count(batch.column(1)).cast(pa.int64()), 0), pa.array(range(at, at + batch.num_rows), pa.int64())], names=["key", "n_tokens", "row"])
            at += batch.num_rows

    return docs.select(F.col(key).alias("key"), text).mapInArrow(run, T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("row", T.LongType())]))


def length_buckets(sized: DataFrame, buckets: int, length: str = "n_tokens") -> tuple[list[int], int]:
    """The optimal boundaries over the whole table, and its row count."""
    seen = sized.groupBy(F.col(length).alias("len")).agg(F.count(F.lit(1)).alias("n")).collect()
    seen.sort(key=lambda r: r["len"])
    return optimal_boundaries([r["len"] for r in seen], [r["n"] for r in seen], buckets), sum(r["n"] for r in seen)


def pack(docs: DataFrame, buckets: int = 16, token_budget: int = 16384, text: str = "text", key: str = "doc_id", count=None) -> DataFrame:
    """Per row: n_tokens, bucket_id, bucket_len, batch_id (within its bucket), slot (within its batch), batch_size.

    count: see sizes(). The slots of a bucket are numbered without bringing it together: about sqrt(rows) hashed
    shares are numbered apart and offset by the counts of earlier shares.
    """
    sized = stored(sizes(docs, text, key, count), "sizes")
    bounds, rows = length_buckets(sized, buckets)
    shares = max(1, math.isqrt(rows))
    bounds = bounds or [0]
    edges = F.array(*[F.lit(b).cast("long") for b in bounds])
    at = F.size(F.filter(edges, lambda b: b < F.col("n_tokens")))
    placed = sized.select("key", "n_tokens", "row", at.alias("bucket_id"), F.pmod(F.xxhash64("key", "row"), F.lit(shares)).alias("share")).withColumn("bucket_len", F.element_at(edges, F.col("bucket_id") + 1))
    earlier = Window.partitionBy("bucket_id").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("bucket_id", "share").agg(F.count(F.lit(1)).alias("n")).select("bucket_id", "share", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = placed.withColumn("rank", F.row_number().over(Window.partitionBy("bucket_id", "share").orderBy("key", "n_tokens", "row")))
    capacity = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.col("bucket_len"), F.lit(1))))
    slot = F.col("before") + F.col("rank") - 1
    return (
        numbered.join(offsets.hint("merge"), ["bucket_id", "share"])
        .select(F.col("key").alias(key), "n_tokens", "bucket_id", "bucket_len", F.floor(slot / capacity).alias("batch_id"), (slot % capacity).alias("slot"), capacity.alias("batch_size"))
    )
