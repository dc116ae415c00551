"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are 64-bit majorities over the hashes of word shingles. Two that differ in at most ``budget`` bits agree in
one of budget + 1 blocks of bits, so each distinct fingerprint is filed once a block, turned so that the block comes first:
the fingerprints of one block value are a subtrie, which is joined with itself. A pair of nodes carries the bits
in which it differs so far, and is dropped beyond the budget. A crowded subtrie is cut at its next bits, and its
pieces meet in pairs whose bits there differ in few enough places. A task returns a spanning forest of its links, never all
pairs, so a dense group costs a row a fingerprint. Components come from star contraction over stored tables.

Null and empty texts have fingerprint 0 and link like any other; texts shorter than a shingle make one shingle.
Equal texts share a fingerprint and are joined once. A null key gets its component like any other and names none. An
empty table gives an empty result. Only key and text are read.

With a ``similarity``, fingerprints only propose: pairs within the budget link if the Jaccard similarity of their distinct
shingles (by 64-bit hashes) reaches it. A budget as wide as that prunes few branches, so the tries are of
fingerprints that share two minima of their shingles under one of BANDS pairs of hash functions; at a similarity of
0.8 a pair shares none with a chance of 0.36 ** BANDS. Texts of equal shingles are one node, null and empty ones too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import concluded, document, forget, join_texts, small, stored, tasks_for, without

SEED = 42
#: Fingerprints of a subtrie beyond which it is cut, node pairs traversed at a time, and rows of a task's chunk of subtries.
SUBTRIE, FRONTIER, CHUNK = 16_384, 400_000, 1 << 18
#: Most bits at which a crowded subtrie is cut, of which so many may differ in a pair.
CUT = 12
#: With a similarity: pairs compared as one block, and pairs for each node up to which a subtrie returns all of its.
LEAF, SPARSE = 1 << 18, 4
#: Pairs of minima.
BANDS = 12


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Unsigned 64-bit hashes of the shingles, in blocks. bytes.lower and bytes.split know only A-Z and ASCII blanks, as wanted."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(e + 1 for e in ends)]
    digest, ends = xxhash.xxh64_intdigest, ends[min(shingle, len(words)) - 1 :]
    for k in range(0, n, 65_536):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + 65_536], ends[k : k + 65_536])], dtype="<u8")


def majority(blocks: Iterator[np.ndarray]) -> int:
    """The bits that more than half of the hashes have; 0 without any."""
    n, set_bits = 0, np.zeros(64, dtype=np.int64)
    for hashes in blocks:
        n += len(hashes)
        set_bits += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """key and fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(text)], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(made)], names=[key, "fp"])

    return docs.select(key, text).mapInArrow(run, T.StructType([docs.schema[key], T.StructField("fp", T.LongType())]))


def traverse(x: np.ndarray, roots: np.ndarray, budget: int, top: int = 63, leaf: int = 8) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of x (uint64) that differ in at most ``budget`` bits, for node pairs given as rows of ranges (alo, ahi, blo, bhi).

    A range is sorted; a node paired with itself has equal ranges, any other's first range comes before its second.
    Bits above ``top`` don't differ inside a root. Node pairs of up to ``leaf`` pairs are compared at once.
    """
    ones: dict[int, np.ndarray] = {}

    def ones_before(bit: int):
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((x >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        return ones[bit]

    roots = np.concatenate([np.asarray(roots, dtype=np.int64).reshape(-1, 4), np.zeros((len(roots), 1), dtype=np.int64)], axis=1)
    work = [(top, roots)]
    while work:
        bit, nodes = work.pop()
        if len(nodes) > FRONTIER:
            work += [(bit, nodes[k : k + FRONTIER]) for k in range(0, len(nodes), FRONTIER)]
            continue
        alo, ahi, blo, bhi, used = nodes.T
        few = ((ahi - alo) * (bhi - blo) <= leaf) | (bit < 0)
        if few.any():
            for i, j in compared(x, nodes[few]):
                near = (np.bitwise_count(x[i] ^ x[j]) <= budget) & (i < j)
                if near.any():
                    yield i[near], j[near]
            nodes = nodes[~few]
        if not len(nodes):
            continue
        alo, ahi, blo, bhi, used = nodes.T
        before = ones_before(bit)
        amid, bmid = ahi - (before[ahi] - before[alo]), bhi - (before[bhi] - before[blo])
        children = [np.stack(c, axis=1) for c in ((alo, amid, blo, bmid, used), (amid, ahi, bmid, bhi, used), (alo, amid, bmid, bhi, used + 1), (amid, ahi, blo, bmid, used + 1))]
        children[3] = children[3][alo != blo]  # of a node paired with itself, the two halves meet once
        nodes = np.concatenate(children)
        nodes = nodes[(nodes[:, 0] < nodes[:, 1]) & (nodes[:, 2] < nodes[:, 3]) & (nodes[:, 4] <= budget)]
        if len(nodes):
            work.append((bit - 1, nodes))


def compared(x: np.ndarray, nodes: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs of node pairs, about ``most`` at a time."""
    wide = nodes[:, 3] - nodes[:, 2]
    n = (nodes[:, 1] - nodes[:, 0]) * wide
    part = np.cumsum(n) // most
    for a, b in _runs([part]):
        rows, w, m = nodes[a:b], wide[a:b], n[a:b]
        row = np.repeat(np.arange(b - a), m)
        k = np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m)
        yield rows[row, 0] + k // w[row], rows[row, 2] + k % w[row]


def _runs(keys: list[np.ndarray]) -> list[tuple[int, int]]:
    """Ranges of rows with equal keys."""
    if not len(keys[0]):
        return []
    first = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])).tolist()
    return list(zip(first, [*first[1:], len(keys[0])]))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int, int]]]]:
    """Tables of whole groups of rows sorted by cell, lo, hi, side; and (begin, middle, end) of each group that has pairs. The middle is the end where lo is hi."""

    def groups(table: pa.Table, runs):
        lo, hi, side = (table.column(c).to_numpy() for c in ("lo", "hi", "side"))
        for a, b in runs:
            m = b if lo[a] == hi[a] else a + int(np.searchsorted(side[a:b], True))
            if b - a > 1 and (m == b) == (lo[a] == hi[a]) and m > a:
                yield a, m, b

    held: list[pa.RecordBatch] = []
    n, limit = 0, CHUNK
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < limit:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        *runs, (rest, _) = _runs([table.column(c).to_numpy() for c in ("cell", "lo", "hi")])
        if runs:
            yield table.slice(0, rest), list(groups(table, runs))
        held = table.slice(rest).to_batches()
        n -= rest
        limit = max(CHUNK, 2 * n)  # a group that isn't whole yet isn't looked at again for every batch
    if n:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, list(groups(table, _runs([table.column(c).to_numpy() for c in ("cell", "lo", "hi")])))


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index of each one's component. Links are merged as they come and forgotten."""
    label = np.arange(n)
    for i, j in links:
        while True:
            x, y = label[i], label[j]
            apart = x != y
            if not apart.any():
                break
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
    return label


def masks(depth: int, budget: int) -> list[int]:
    """Numbers of ``depth`` bits with at most ``budget`` ones."""
    return [m for m in range(1 << depth) if m.bit_count() <= budget]


def met(rows: DataFrame, pairs: Column, columns: list[str]) -> DataFrame:
    """Rows with the pairs (lo, hi, side) of pieces in which they meet others of their cell, brought together and sorted. pairs: null for cells that aren't crowded."""
    alone = F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(False).alias("side")))
    made = stored(rows.select("cell", *columns, F.inline(F.coalesce(pairs, alone))), "cells")
    tasks = tasks_for(made.count() * 8 * (len(columns) + 2) * 8)
    return made.repartition(tasks, "cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi", "side", *columns)


def crowds(rows: DataFrame) -> DataFrame:
    """cell, n of the crowded cells, of which there can be as many as rows divided by SUBTRIE."""
    return stored(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SUBTRIE), "crowded-cells")


def links(distinct: DataFrame, budget: int = 2) -> DataFrame:
    """u, v (signed longs): for each subtrie, a spanning forest of the fingerprints at most ``budget`` bits apart. distinct: fp."""
    ends = [64 * k // (budget + 1) for k in range(budget + 2)]
    turn = lambda r: F.col("fp") if r == 0 else F.shiftleft("fp", r).bitwiseOR(F.shiftrightunsigned("fp", 64 - r))
    filed = [F.struct(F.lit(k).cast("long").alias("block"), turn(a).alias("turned"), F.lit(b - a).alias("bits")) for k, (a, b) in enumerate(zip(ends, ends[1:]))]
    rows = distinct.select("fp", F.inline(F.array(*filed)))
    block = F.expr("shiftrightunsigned(turned, 64 - bits)") if budget else F.col("turned")
    rows = rows.withColumn("cell", F.xxhash64("block", block) if min(b - a for a, b in zip(ends, ends[1:])) > 56 else F.shiftleft("block", 57).bitwiseOR(block))
    crowded = rows.join(small(crowds(rows)), "cell", "left").withColumn("depth", F.least(F.lit(CUT), F.ceil(F.log2(F.col("n") / SUBTRIE)).cast("int") + 1))
    piece = F.expr("shiftrightunsigned(shiftleft(turned, bits), 64 - depth)")
    by_depth = F.array(*[F.array(*[F.lit(m).cast("long") for m in masks(d, budget)]) for d in range(1, CUT + 1)])
    other = lambda m: F.col("piece").bitwiseXOR(m)
    pairs = F.transform(F.element_at(by_depth, F.col("depth")), lambda m: F.struct(F.least("piece", other(m)).cast("int").alias("lo"), F.greatest("piece", other(m)).cast("int").alias("hi"), (F.col("piece") > other(m)).alias("side")))
    crowded = crowded.withColumn("piece", F.when(F.col("n").isNotNull(), piece))
    together = met(crowded, F.when(F.col("n").isNotNull(), pairs), ["turned", "fp"])
    top = 63 - min(b - a for a, b in zip(ends, ends[1:]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, groups in chunks(batches):
            x, own = table.column("turned").to_numpy().view(np.uint64), table.column("fp").to_numpy()
            roots = np.array([(a, m, a, m) if m == b else (a, m, m, b) for a, m, b in groups], dtype=np.int64).reshape(-1, 4)
            label = forest(len(x), traverse(x, roots, budget, top))
            moved = np.flatnonzero(label != np.arange(len(x)))
            yield pa.RecordBatch.from_arrays([pa.array(own[moved]), pa.array(own[label[moved]])], names=["u", "v"])

    return together.select("cell", "lo", "hi", "side", "turned", "fp").mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of edges u, v: star contraction, each round stored."""
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the minima are stored, so that a node with very many edges meets them in a join that can be split
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(small(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "large-star")
        down = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        contracted = large.join(small(down), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = stored(contracted, "edges")
        for table in (now, least, large, down):
            forget(table)
        now = after
        # sums of hashes tell whether a round changed anything
        state = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.countDistinct("u")).first())
        if state == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = state


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, budget: int = 2) -> DataFrame:
    """key, fp and component_id: the smallest key reachable over fingerprints at most ``budget`` bits apart."""
    prints = stored(fingerprints(docs, key, text, shingle), "fingerprints")

    def by_print():
        distinct = stored(prints.groupBy("fp").agg(F.min(key).alias("least")), "distinct-fingerprints")
        roots = components(stored(links(distinct.select("fp"), budget), "links"))
        linked = stored(distinct.join(small(roots), distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
        best = stored(linked.groupBy("root").agg(F.min("least").alias("component_id")), "components")
        return linked.join(small(best), "root").select("fp", "component_id")

    return prints.join(small(concluded(by_print, "by-fingerprint")), "fp").select(key, "fp", "component_id")


# ---- links verified by similarity ---------------------------------------------------------------------------


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return np.unique(np.concatenate([np.empty(0, "<u8"), *shingle_hashes(text, shingle)]))


def set_id(hashes: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED)


_FACTORS = np.random.default_rng(SEED).integers(0, 2**63, 2 * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(hashes: np.ndarray) -> np.ndarray:
    """A word for each band: the two minima of the hashes under its functions (odd multiples modulo 2**64)."""
    least = np.full(2 * BANDS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(hashes), 8192):
        np.minimum(least, (hashes[k : k + 8192, None] * _FACTORS).min(axis=0), out=least)
    return least[::2] * np.uint64(0x9E3779B97F4A7C15) + (least[1::2] ^ (least[1::2] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.arange(BANDS, dtype=np.uint64)


def set_prints(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """key, fp, n (distinct shingles), node (a hash of all of them) and a word for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, words = [], []
            for t in batch.column(1):
                own = shingle_set(t.as_py(), shingle)
                rows.append((majority(own[k : k + 65_536] for k in range(0, len(own), 65_536)), len(own), set_id(own)))
                words.append(bands(own).view(np.int64))
            made = np.array(rows, dtype=np.uint64).reshape(-1, 3).T.copy().view(np.int64)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * len(words) + 1, BANDS), pa.int32()), pa.array(np.concatenate(words) if words else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, made), flat], names=["key", "fp", "n", "node", "bands"])

    schema = T.StructType([T.StructField("key", docs.select(key).schema[0].dataType), *(T.StructField(c, T.LongType()) for c in ("fp", "n", "node")), T.StructField("bands", T.ArrayType(T.LongType()))])
    return docs.select(F.col(key).alias("key"), text).mapInArrow(run, schema)


def sparse_links(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]], star: Callable[[int], np.ndarray]) -> tuple[list[tuple[int, int]], bool]:
    """All pairs and False, or, beyond SPARSE for each of the n nodes, pairs that span their components and True. star: the later nodes that pair with one."""
    label, out, kept, held, dense = np.arange(n), [], [], 0, False

    def spanning(i, j):
        while len(i):
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            for p, q in zip(i[:1024].tolist(), j[:1024].tolist()):
                a, b = label[p], label[q]
                if a != b:
                    label[label == max(a, b)] = min(a, b)
                    out.append((p, q))
            i, j = i[1024:], j[1024:]

    def stars():
        """The first nodes of the first components take what they pair with: mostly, that leaves little to join."""
        for c in np.unique(label)[:16].tolist():
            found = star(c)
            spanning(np.full(len(found), c), found)

    for i, j in pairs:
        if dense:
            if not label.any():
                break
            spanning(i, j)
            continue
        kept.append((i, j))
        held += len(i)
        if held > SPARSE * n:
            dense = True
            stars()
            for x, y in kept:
                spanning(x, y)
            kept = []
    return (out, True) if dense else ([p for i, j in kept for p in zip(i.tolist(), j.tolist())], False)


def alike_links(sets: list[np.ndarray], star: Callable[[int], np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Pairs that span the components of what ``star`` pairs and is similar enough. A node is compared at once with all that aren't linked to it yet."""
    sizes = np.array([len(x) for x in sets])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    label, out, held = np.arange(len(sets)), [], np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=bool)
    for c in range(len(sets)):
        later = star(c)
        later = later[label[later] != label[c]]
        if not len(later):
            continue
        held[ids[ends[c] : ends[c + 1]]] = True
        base = ends[later[0]]
        sums = np.concatenate([[0], np.cumsum(held[ids[base : ends[later[-1] + 1]]])])
        held[ids[ends[c] : ends[c + 1]]] = False
        common = sums[ends[later + 1] - base] - sums[ends[later] - base]
        later = later[common >= similarity * (sizes[c] + sizes[later] - common) - 1e-9]
        joined, first = np.unique(label[later], return_index=True)
        out += [(c, int(x)) for x in later[first]]
        label[np.isin(label, joined) | (label == label[c])] = min(label[c], *joined.tolist()) if len(joined) else label[c]
    return out


def proposed(together: DataFrame, budget: int, similarity: float, judged: bool = False) -> DataFrame:
    """cell, lo, hi, u, v, dense: pairs of nodes to judge, for each subtrie; pairs judged already, where the rows have the shingles' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, groups in chunks(batches):
            cell, lo, hi, fp, n, node = (table.column(c).to_numpy() for c in ("cell", "lo", "hi", "fp", "n", "node"))
            hashes = table.column("hashes").combine_chunks() if judged else None
            out = []
            few = np.array([m == b and b - a <= 2 * SPARSE + 1 for a, m, b in groups], dtype=bool) & (not judged)
            roots = np.array([(a, b, a, b) for (a, _, b), f in zip(groups, few) if f], dtype=np.int64).reshape(-1, 4)
            x = fp.view(np.uint64)

            def fits(pairs):
                for i, j in pairs:
                    near = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9
                    if near.any():
                        yield i[near], j[near]

            for i, j in fits(traverse(x, roots, budget, leaf=LEAF)):
                out.append((cell[i], lo[i], hi[i], node[i], node[j], np.zeros(len(i), dtype=bool)))
            for (a, m, b), f in zip(groups, few):
                if f:
                    continue
                # by fingerprint on either side, then by node, so that the first nodes are the same wherever a group meets
                halves = [np.lexsort([node[s:e], x[s:e]]) + s for s, e in ([(a, b)] if m == b else [(a, m), (m, b)])]
                order = np.concatenate(halves)
                own, size = x[order], n[order]
                root = (0, b - a, 0, b - a) if m == b else (0, m - a, m - a, b - a)
                sets = [hashes[int(r)].values.to_numpy() for r in order] if judged else []

                def pairs():
                    for i, j in traverse(own, np.array([root]), budget, leaf=LEAF):  # noqa: B023
                        near = np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]) - 1e-9  # noqa: B023
                        if near.any():
                            yield i[near], j[near]

                def star(c):
                    later = np.arange(max(c + 1, 0 if m == b else m - a), b - a) if m == b or c < m - a else np.empty(0, dtype=np.int64)  # noqa: B023
                    fit = (np.bitwise_count(own[c] ^ own[later]) <= budget) & (np.minimum(size[c], size[later]) >= similarity * np.maximum(size[c], size[later]) - 1e-9)  # noqa: B023
                    return later[fit]

                found, dense = (alike_links(sets, star, similarity), True) if judged else sparse_links(b - a, pairs(), star)
                if found:
                    u, v = (node[order[np.array([p[c] for p in found], dtype=np.int64)]] for c in (0, 1))
                    same = lambda value, kind: np.full(len(u), value, dtype=kind)  # noqa: B023, E731
                    out.append((same(cell[a], np.int64), same(lo[a], np.int32), same(hi[a], np.int32), u, v, same(dense, bool)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["cell", "lo", "hi", "u", "v", "dense"])

    return together.mapInArrow(run, "cell long, lo int, hi int, u long, v long, dense boolean")


def shingles_of(nodes: DataFrame, distinct: DataFrame, docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """node, hashes: the distinct shingles of the nodes wanted, a stored table."""
    wanted = stored(distinct.join(small(stored(nodes, "nodes")), "node").groupBy(F.col("least").alias("key")).agg(F.collect_set("node").alias("nodes")), "texts-to-judge")
    texts = join_texts(docs.select(F.col(key).alias("key"), F.col(text).alias("t")), wanted, "key").select("nodes", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(int(np.uint64(set_id(s)).view(np.int64)), s.view(np.int64), nodes.as_py()) for nodes, t in zip(*batch.columns) for s in [shingle_set(t.as_py(), shingle)]]
            sets = [(u, s) for u, s, nodes in sets if u in nodes]  # a repeated key may have other texts
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in sets], pa.int64()), pa.array([s for _, s in sets], pa.list_(pa.int64()))], names=["node", "hashes"])

    return stored(texts.mapInArrow(run, "node long, hashes array<long>").dropDuplicates(["node"]), "shingles")


def judge(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """pairs (u, v) whose shingles are similar enough, or not: linked."""
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("hu")), "u").join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("hv")), "v")
    common = F.size(F.array_intersect("hu", "hv"))
    return both.select("u", "v", (common >= similarity * (F.size("hu") + F.size("hv") - common) - 1e-9).alias("linked"))


def similar_documents(docs: DataFrame, key: str, text: str, shingle: int, budget: int, similarity: float) -> DataFrame:
    """key and component_id: the smallest key reachable over texts at most ``budget`` bits apart and at least ``similarity`` alike."""
    prints = stored(set_prints(docs, key, text, shingle), "set-prints")

    def by_node():
        distinct = stored(prints.groupBy("node").agg(F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("key").alias("least")), "distinct-sets")
        # fewer shingles than one may lack are alike only if equal
        rows = distinct.where(F.col("n") >= similarity / (1 - similarity) - 1e-9).select("node", "fp", "n", F.explode("bands").alias("cell"))
        # a crowded cell is dealt into shares, each of which meets every other
        dealt = rows.join(small(crowds(rows).withColumnRenamed("n", "crowd")), "cell", "left").withColumn("shares", F.ceil(F.col("crowd") / SUBTRIE).cast("int"))
        dealt = dealt.withColumn("share", F.when(F.col("crowd").isNotNull(), F.pmod(F.xxhash64("node"), F.col("shares")).cast("int")))
        pairs = F.transform(F.sequence(F.lit(0), F.col("shares") - 1), lambda k: F.struct(F.least("share", k).alias("lo"), F.greatest("share", k).alias("hi"), (F.col("share") > k).alias("side")))
        together = met(dealt, F.when(F.col("crowd").isNotNull(), pairs), ["node", "fp", "n"])
        found = stored(proposed(together.select("cell", "lo", "hi", "side", "node", "fp", "n"), budget, similarity), "proposed")
        unique = stored(found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "pairs")
        sets = shingles_of(unique.select(F.explode(F.array("u", "v")).alias("node")).distinct(), distinct, docs, key, text, shingle)
        judged = stored(judge(unique, sets, similarity), "judged")
        edges = judged.where("linked").select("u", "v")
        # subtries that returned a part of their pairs may have better ones in place of those that failed: they judge by themselves
        failed = judged.where("NOT linked").select("u", "v")
        again = found.where("dense").withColumns({"u": F.least("u", "v"), "v": F.greatest("u", "v")}).join(small(stored(failed, "failed")), ["u", "v"]).select("cell", "lo", "hi").distinct()
        again = stored(again, "groups-to-judge")
        if not again.isEmpty():
            rows = stored(together.join(small(again), ["cell", "lo", "hi"]).select("cell", "lo", "hi", "side", "node", "fp", "n"), "dense-rows")
            sets = shingles_of(rows.select("node").distinct(), distinct, docs, key, text, shingle)
            full = rows.join(sets, "node").select("cell", "lo", "hi", "side", "node", "fp", "n", "hashes")
            full = full.repartition(tasks_for(rows.count() * 2048), "cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi", "side", "node")
            edges = edges.unionByName(stored(proposed(full, budget, similarity, True), "dense-links").select("u", "v"))
        roots = components(edges)
        rooted = stored(distinct.join(small(roots), "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "rooted")
        best = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
        return rooted.join(small(best), "root").select("node", "component_id")

    return prints.join(small(concluded(by_node, "by-node")), "node").select(F.col("key").alias(key), "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, budget: int = 2, similarity: float | None = None) -> DataFrame:
    """One document of each group, the one with the smallest key, with its own columns.

    Of rows that share that key, the one with the smallest hash of its text stays, and of rows that repeat both one. Rows without a key come last.
    """
    name = document(key, text)
    rows = docs.select(name.alias("name"), F.col(text).alias("text"))
    found = near_duplicates(rows, "name", "text", shingle, budget) if similarity is None else similar_documents(rows, "name", "text", shingle, budget, similarity)
    found = stored(found.select("name", "component_id"), "named-groups")
    later = found.where("name <> component_id").select("name").distinct()
    repeated = stored(found.where("name = component_id").groupBy("name").count().where("count > 1").select("name"), "repeated-rows")
    kept = without(docs, stored(later.unionByName(repeated), "later-copies"), name)
    if repeated.isEmpty():
        return kept
    once = join_texts(docs.select(F.struct(*docs.columns).alias("row"), name.alias("name")), repeated, "name").dropDuplicates(["name"]).select("row.*")
    return kept.unionByName(once)
