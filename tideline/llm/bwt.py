"""Repeated byte strings by merging shard Burrows-Wheeler transforms.

A byte goes when a string of ``width`` bytes that covers it also starts earlier (in a smaller key, or before it in the
same text). Strings never cross documents and are judged on the input.

1. routing: every string of ``width`` bytes belongs to the least-hashed gram inside it (its minimizer), so equal strings
   meet at equal minimizers. The strings of one minimizer occurrence form a snippet. Snippets whose bytes have one
   128-bit digest are one class; the first two of each class of a minimizer that occurs twice go on, and each later
   one is noted as a copy of the first. A minimizer that very many classes share has its snippets cut into a few
   neighbouring strings each, filed under the bytes that these share, and routed again;
2. shards: a task joins neighbouring snippets whose class is alone with its minimizer into longer pieces, builds the
   transform of its pieces, and sends each range its part of that. Snippets of other minimizers go to the range of their
   minimizer, which drops strings whose core (what some neighbouring ones share) is nowhere else, and builds the
   transforms of the rest, several senders' to a shard;
3. merging: the shards' transforms of a range are merged by refining their interleave. A round orders the suffixes
   by twice as many bytes, and only those that still tie are moved. Common prefixes and intervals come from
   the rounds' ranks; an interval of ``width`` common bytes with two suffixes or more is a repeated string, and all
   but its earliest one go. Nothing goes that isn't in such an interval, or a noted copy of strings that all are;
4. spans are united a document, and what is left is kept.

Null and empty texts have no bytes; texts shorter than ``width`` stay whole. A document is a key and its text: rows that
repeat both get equal results, and rows that share a key but not the text are documents of their own, ordered by a
hash of the text. A null key comes last. Keys may be of any type that sorts. An empty table gives an empty result.
Only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import concluded, document, join_texts, stored, tasks_for

GRAM = 24
#: Offsets of a minimizer in a string that share a core; records before a task hands on what it has.
OFFSETS, FLUSH = 4, 300_000
#: Bytes of a shard, and bytes of transforms that are merged at a time (whole ranges).
SHARD, MERGE = 1 << 20, 1 << 19
#: Strings of a piece, about; longer ones are cut, since a step of places() moves all pieces by one byte.
LONGEST = 1 << 12
#: Shards that a range makes of the snippets that it got as they are.
RECEIVED = 4
#: Source bytes for each range of minimizers.
RANGE_BYTES = 1 << 22
#: Longest piece of a text that is hashed at once; pieces overlap by width - 1. Shorter texts up to so many bytes are hashed together.
CHUNK, TOGETHER = 1 << 20, 1 << 16
#: Records of a minimizer in one task, and in all, beyond which its snippets are cut finer before they meet.
LOCAL_CROWD, CROWD = 64, 1000
#: Kinds of routed rows: copies of a task's first, copies of the first of all, records to merge, records to cut finer.
NEAR, FAR, MIXED, HOT = 0, 1, 2, 3
#: The offset of records to merge that are joined into pieces first.
ALONE = -1
#: Kinds of merged rows: strings that occur twice, those of them that go.
REPEATED, GONE = 0, 1
RECORD = np.dtype([("gram", "<u8"), ("one", "<u8"), ("two", "<u8"), ("doc", "<i8"), ("start", "<i8"), ("strings", "<i4"), ("offset", "<i4")])
LINK = np.dtype([("base", "<i8"), ("doc", "<i8"), ("start", "<i8"), ("strings", "<i4")])
PIECE = np.dtype([("doc", "<i8"), ("start", "<i8"), ("strings", "<i8")])
SPAN = np.dtype([("start", "<i8"), ("end", "<i8")])

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    out = np.empty(n + 1, dtype=np.uint64)
    out[0], have = 1, 1
    while have <= n:
        k = min(have, n + 1 - have)
        out[have : have + k] = out[:k] * np.uint64(pow(base, have, 1 << 64))
        have += k
    return out


class Hashes:
    """Hashes of the ranges of a byte array, by prefix sums modulo 2**64."""

    _up = _down = np.ones(1, dtype=np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Hashes._up) <= n:
            size = 1 << max(16, n.bit_length())
            Hashes._up, Hashes._down = _powers(size, _MULTIPLIER), _powers(size, pow(_MULTIPLIER, -1, 1 << 64))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * Hashes._up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * Hashes._down[start])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, from running minima inside blocks of w, forward and backward."""
    n = len(x) - w + 1
    padded = np.concatenate([x, np.full(-len(x) % w, np.iinfo(x.dtype).max, dtype=x.dtype)]).reshape(-1, w)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[w - 1 : w - 1 + n])


def digests(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit digests of ranges of bytes, as rows of two words."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]), dtype="<u8").reshape(-1, 2)


def snippets(data: bytes, width: int, doc: int) -> np.ndarray:
    """A record for each minimizer occurrence of a text: its hash, the digest of all its strings, where they start and how many they are."""
    out = [occurrences([data[base : base + CHUNK + width - 1]], [doc], base, width) for base in range(0, len(data) - width + 1, CHUNK)]
    return np.concatenate(out) if out else np.empty(0, dtype=RECORD)


def snippets_of_all(texts: Iterable[bytes], docs: list[int], width: int) -> Iterator[np.ndarray]:
    """The records of texts, short ones up to TOGETHER bytes at once."""
    short, size = [], 0
    for data, doc in zip(texts, docs):
        if len(data) > TOGETHER:
            yield snippets(data, width, doc)
        elif len(data) >= width:
            short.append((data, doc))
            size += len(data)
        if size > TOGETHER:
            yield occurrences(*zip(*short), 0, width)
            short, size = [], 0
    if short:
        yield occurrences(*zip(*short), 0, width)


def occurrences(texts: list[bytes], docs: list[int], base: int, width: int) -> np.ndarray:
    """The records of texts of at least ``width`` bytes, hashed as one array. base: where the texts begin in their documents."""
    gram, sizes = min(GRAM, width), np.array([len(t) for t in texts])
    data = b"".join(texts)
    begins = np.cumsum(sizes) - sizes
    hashes = Hashes(np.frombuffer(data, dtype=np.uint8))
    at = np.arange(len(data) - gram + 1)
    grams = hashes.of(at, at + gram)
    # the least hash by its upper 40 bits, the first of equals
    least = sliding_min((grams >> np.uint64(24) << np.uint64(24)) | at.astype(np.uint64), width - gram + 1)
    place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    # strings that lie in one text; a minimizer then does too
    counts = sizes - (width - 1)
    inside = np.ones(len(place), dtype=bool)
    for a in begins[1:].tolist():
        inside[a - width + 1 : a] = False
    string = np.flatnonzero(inside)
    place = place[string]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    n = np.diff(np.append(first, len(place)))
    owner = np.searchsorted(np.cumsum(counts), first, "right")
    start = string[first]
    made = np.empty(len(first), dtype=RECORD)
    made["gram"], made["doc"], made["start"] = grams[place[first]], np.array(docs)[owner], start - begins[owner] + base
    made["one"], made["two"] = digests(data, start, start + n + width - 1).T
    made["strings"], made["offset"] = n, place[first] - start
    return made


def classes(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records sorted by class then position, each once, and the place of each one in its class."""
    s = records[np.lexsort([records[f] for f in ("start", "doc", "two", "one", "gram")])]
    differ = lambda *names: np.concatenate([[True], np.any([s[f][1:] != s[f][:-1] for f in names], axis=0)]) if len(s) else np.empty(0, dtype=bool)
    s = s[differ("gram", "one", "two", "doc", "start")]
    first = np.flatnonzero(differ("gram", "one", "two"))
    return s, np.arange(len(s)) - np.repeat(first, np.diff(np.concatenate([first, [len(s)]]).astype(np.int64)))


def ordered(key: np.ndarray, bound: int) -> np.ndarray:
    """Stable order of keys from 0 to bound; sorted with their places in the lower bits where both fit, which is far faster."""
    bits = max(1, (len(key) - 1).bit_length())
    if bound.bit_length() + bits > 63:
        return np.argsort(key, kind="stable")
    packed = key << bits
    packed |= np.arange(len(key))
    packed.sort()
    packed &= (1 << bits) - 1
    return packed


def refined(order: np.ndarray, rank: np.ndarray, follow) -> np.ndarray:
    """Order the suffixes that tie by the rank of what follows them (``follow`` tells which suffix that is), in place; their new ranks.

    A rank is the place where the run of equals begins.
    """
    begins = rank[order]
    ties = np.zeros(len(order), dtype=bool)
    np.equal(begins[1:], begins[:-1], out=ties[1:])
    ties[:-1] |= ties[1:]
    at = np.flatnonzero(ties)
    tied = order[at]
    key = begins[at].astype(np.int64) * len(order)
    key += rank[follow(tied)]
    by = ordered(key, len(order) ** 2)
    order[at] = tied = tied[by]
    out = rank.copy()
    out[tied] = run_starts([key[by]], at)
    return out


def run_starts(keys: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    """For suffixes in order at places ``at``: the place where the run of equal keys begins."""
    new = np.ones(len(at), dtype=bool)
    np.not_equal(keys[0][1:], keys[0][:-1], out=new[1:])
    for k in keys[1:]:
        new[1:] |= k[1:] != k[:-1]
    return np.maximum.accumulate(np.where(new, at, 0).astype(np.int32))


#: Symbols that the first round takes at once.
PACKED = 4


def first_ranks(key: np.ndarray, ended: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and ranks by the first PACKED symbols. Those that reach their terminator there (``ended``) differ from all others."""
    order = ordered(key, 1 << 9 * PACKED)
    alone = np.where(ended[order], np.arange(len(order)), -1)
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = run_starts([key[order], alone], np.arange(len(order)))
    return order.astype(np.int32), rank


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of a shard whose terminators are negative and differ by their place."""
    n = len(text)
    end = np.append(text < 0, [True] * PACKED)
    symbol = np.append(np.where(text < 0, 0, text + 1), [0] * PACKED)
    key, ended = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    for j in range(PACKED):
        ended |= end[j : n + j]
        key = key << 9 | np.where(ended, 0, symbol[j : n + j])
    order, rank = first_ranks(key, ended)
    h = PACKED
    while (rank[order[1:]] == rank[order[:-1]]).any():
        rank = refined(order, rank, lambda x: x + h)  # noqa: B023  one that ties doesn't end within h
        h *= 2
    return order


def shard_transform(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transform (terminator 0, bytes + 1), the piece and the place inside it of each suffix in order. A piece's first suffix follows its own terminator."""
    sizes = np.array([len(p) + 1 for p in pieces])
    ends = np.cumsum(sizes) - 1
    text = np.empty(int(sizes.sum()), dtype=np.int64)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    place = np.arange(len(text)) - np.repeat(ends + 1 - sizes, sizes)
    inside = np.ones(len(text), dtype=bool)
    inside[ends] = False
    text[inside] = np.concatenate(pieces)
    text[ends] = np.arange(len(pieces)) - len(pieces)
    order = suffix_order(text)
    before = np.where(place[order] == 0, 0, np.where(text[order - 1] >= 0, text[order - 1] + 1, 0))
    return before.astype(np.uint8), owner[order], place[order]  # UTF-8 has no byte 255


def extensions(transforms: list[np.ndarray]) -> np.ndarray:
    """For each suffix (numbered shard after shard) the number of the suffix one symbol longer; -1 where its piece begins."""
    before, base = np.empty(sum(map(len, transforms)), dtype=np.int32), 0
    for t in transforms:
        before[base + np.argsort(t, kind="stable")] = base + np.arange(len(t))
        base += len(t)
    before[np.concatenate(transforms) == 0] = -1
    return before


def places(before: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The piece and the place in it of each suffix, by walking from the terminators (``ends``) to the front."""
    owner, place = np.empty(len(before), dtype=np.int32), np.empty(len(before), dtype=np.int32)
    at, piece, left = ends, np.arange(len(ends)), sizes
    while len(at):
        owner[at], place[at] = piece, left
        go = left > 0
        at, piece, left = before[at[go]], piece[go], left[go] - 1
    return owner, place


def terminators(transforms: list[np.ndarray]) -> np.ndarray:
    """Numbers of the suffixes that are a terminator alone: the first ones of each shard, as many as its pieces."""
    sizes = np.cumsum([0, *map(len, transforms)])
    return np.concatenate([base + np.arange(int((t == 0).sum())) for base, t in zip(sizes.tolist(), transforms)])


def merge_transforms(transforms: list[np.ndarray], width: int, before: np.ndarray | None = None, prefixes: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The interleave (suffixes, numbered shard after shard, in merged order) and the common prefix of each with the one before it, both up to ``width`` bytes. Without ``prefixes``, prefixes shorter than that are 0.

    The first round interleaves by PACKED symbols. Each other one takes an interleave by h symbols to
    one by 2h (width at last): suffixes that tie are ordered by the rank of what follows their first h symbols, where
    following is the inverse of the transforms' own extension. Suffixes that tie no more stay where they are. Terminators
    come first and all differ, so a suffix that ends within h symbols never ties.
    """
    symbols, before = np.concatenate(transforms), extensions(transforms) if before is None else before
    n = len(before)
    longer = np.flatnonzero(before >= 0)
    next_one, head = np.full(n, -1, dtype=np.int32), np.zeros(n, dtype=np.uint8)
    next_one[before[longer]] = longer
    head[before[longer]] = symbols[longer]  # a terminator's is 0
    first = min(PACKED, width)
    key, at, ended = np.zeros(n, dtype=np.int64), np.arange(n), np.zeros(n, dtype=bool)
    ways = []  # ways[j]: what follows j + 1 symbols
    for _ in range(first):
        now = head[at]
        now[ended] = 0
        ended |= now == 0
        key <<= 8
        key |= now
        at = next_one[at]
        at[ended] = -1
        ways.append(at)
    merged, rank = first_ranks(key, ended)
    key = key if prefixes else None
    rounds, h, jump = [], first, ways[-1]
    while h < width:
        rounds.append((h, rank if prefixes else None, jump))
        step = min(h, width - h)

        def follow(x):
            """What follows ``step`` symbols; those that tie don't end before."""
            left = step  # noqa: B023
            for size, _, way in reversed(rounds):
                if left >= size:
                    x, left = way[x], left - size
            return ways[left - 1][x] if left else x

        rank = refined(merged, rank, follow)
        h += step
        if h < width:
            gone = jump < 0
            jump = jump[jump]
            jump[gone] = -1
    common, whole = np.zeros(n, dtype=np.int32), rank[merged[1:]] == rank[merged[:-1]]
    common[1:][whole] = width
    if not prefixes:
        return merged, common
    x, y = merged[:-1][~whole].copy(), merged[1:][~whole].copy()
    shared = np.zeros(len(x), dtype=np.int32)
    for size, ranks, way in reversed(rounds):
        alike = ranks[x] == ranks[y]
        shared += size * alike
        x, y = np.where(alike, way[x], x), np.where(alike, way[y], y)
    differ = key[x] ^ key[y]  # the rest, within the first symbols
    alike = np.ones(len(x), dtype=bool)
    for j in range(first - 1, -1, -1):
        alike &= ((differ >> (8 * j)) & 255 == 0) & ((key[x] >> (8 * j)) & 255 != 0)
        shared += alike
    common[1:][~whole] = shared
    return merged, common


def repeated(transforms: list[np.ndarray], pieces: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, start, in order, of every string that occurs twice in the shards' pieces, and whether it also starts earlier. pieces: doc, start, strings of the shards' pieces, in order."""
    before = extensions(transforms)
    merged, common = merge_transforms(transforms, width, before, False)
    piece, place = places(before, pieces["strings"] + (width - 1), terminators(transforms))
    docs, shift, base = lined_up(pieces)
    tied = common >= width
    whole = tied.copy()
    whole[:-1] |= tied[1:]
    at = np.flatnonzero(whole)
    interval, suffix = np.cumsum(~tied[at]) - 1, merged[at]
    point = base[piece[suffix]]
    point += place[suffix]
    order = ordered(point, int(point.max(initial=0)) + 1)
    point, interval = point[order], interval[order]
    # one place may be in several pieces: only another place makes a string a repeated one
    other = np.ones(len(point), dtype=bool)
    np.not_equal(point[1:], point[:-1], out=other[1:])
    point, interval = point[other], interval[other]
    number = np.arange(len(point))
    earliest = np.zeros(len(at), dtype=np.int64)
    earliest[interval[::-1]] = number[::-1]
    twice = (np.bincount(interval, minlength=1) > 1)[interval]
    point, later = point[twice], (earliest[interval] != number)[twice]
    of = np.repeat(np.arange(len(docs)), np.diff(np.append(np.searchsorted(point, shift), len(point))))
    return docs[of], point - shift[of], later


def lined_up(pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents of pieces laid end to end: the documents, where each begins, and where each piece's first string is."""
    docs, of = np.unique(pieces["doc"], return_inverse=True)
    length = np.zeros(len(docs), dtype=np.int64)
    np.maximum.at(length, of, pieces["start"] + pieces["strings"])
    shift = np.cumsum(length) - length
    return docs, shift, shift[of] + pieces["start"]


def recurring(records: np.ndarray, bodies: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The runs of strings of snippets whose core (what all strings of some neighbouring offsets share) occurs twice: the snippet, the piece, its bytes."""
    sizes = np.array([len(b) for b in bodies])
    base = np.cumsum(sizes) - sizes
    data = np.concatenate(bodies)
    hashes = Hashes(data)
    high = records["offset"].astype(np.int64)
    row, group, reach_low, reach_high = offset_groups(records)
    core = hashes.of(*core_of(base[row] + high[row], group, width))
    key = _mix(core ^ _mix(records["gram"][row] + group.astype(np.uint64)))
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    keep = np.flatnonzero(count[back] > 1)
    row, reach_low, reach_high = row[keep], reach_low[keep], reach_high[keep]
    # neighbouring groups of one snippet make one piece
    order = np.lexsort([reach_low, row])
    row, reach_low, reach_high = row[order], reach_low[order], reach_high[order]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (reach_low[1:] != reach_high[:-1] + 1)])) if len(row) else np.empty(0, dtype=np.int64)
    last = np.concatenate([first[1:], [len(row)]]).astype(np.int64)[: len(first)] - 1
    row, begin, strings = row[first], high[row[first]] - reach_high[last], reach_high[last] - reach_low[first] + 1
    return row, _pieces(records["doc"][row], records["start"][row] + begin, strings), [data[a:b] for a, b in zip(base[row] + begin, base[row] + begin + strings + (width - 1))]


def _pieces(doc: np.ndarray, start: np.ndarray, strings: np.ndarray) -> np.ndarray:
    out = np.empty(len(doc), dtype=PIECE)
    out["doc"], out["start"], out["strings"] = doc, start, strings
    return out


def chained(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of one document's records that follow one another, as those they pair with do in their document; and where each goes (``gram``)."""
    r = records[np.lexsort([records["start"], records["two"], records["gram"]])]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r["gram"][1:] != r["gram"][:-1]) | (r["two"][1:] != r["two"][:-1]) | (r["start"][1:] != r["start"][:-1] + r["strings"][:-1])
    first = np.flatnonzero(new)
    along = r["start"] - np.repeat(r["start"][first], np.diff(np.append(first, len(r))))
    new[1:] |= along[1:] // LONGEST != along[:-1] // LONGEST
    first = np.flatnonzero(new)
    return _pieces(r["doc"][first], r["start"][first], np.add.reduceat(r["strings"].astype(np.int64), first) if len(r) else r["strings"]), r["gram"][first]


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Maximal runs covered by spans."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > reach[:-1]
    first = np.flatnonzero(new)
    out = np.empty(len(first), dtype=SPAN)
    out["start"], out["end"] = starts[first], reach[np.concatenate([first[1:], [len(starts)]]).astype(np.int64) - 1] if len(first) else reach
    return out


def _span_rows(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of doc and its packed, united spans."""
    order = np.lexsort([start, doc])
    doc, start, end = doc[order], start[order], end[order]
    change = np.ones(len(doc), dtype=bool)
    np.not_equal(doc[1:], doc[:-1], out=change[1:])
    # documents laid end to end, so that spans of two never touch
    shift = (np.cumsum(change) - 1) * (int(end.max(initial=0)) + 1)
    spans = merged_spans(start + shift, end + shift)
    owner = np.searchsorted(shift[change], spans["start"], "right") - 1
    for f in SPAN.names:
        spans[f] -= shift[change][owner]
    stops = np.searchsorted(owner, np.arange(int(change.sum())), "right") * SPAN.itemsize
    data = spans.tobytes()
    packed = [data[a:b] for a, b in zip([0, *stops.tolist()], stops.tolist())]
    yield pa.RecordBatch.from_arrays([pa.array(doc[change]), pa.array(packed, pa.binary())], names=["doc", "spans"])


def finer(data: bytes, records: np.ndarray, width: int) -> np.ndarray:
    """The records of one text cut into the strings of OFFSETS neighbouring minimizer offsets, each filed under what all of them share."""
    hashes = Hashes(np.frombuffer(data, dtype=np.uint8))
    row, group, reach_low, reach_high = offset_groups(records)
    at = records["start"][row] + records["offset"][row]
    core = hashes.of(*core_of(at, group, width))
    out = records[row].copy()
    out["start"] = at - reach_high
    out["strings"], out["offset"] = reach_high - reach_low + 1, reach_high
    out["gram"] = _mix(core ^ _mix(records["gram"][row] + group.astype(np.uint64)))
    out["one"], out["two"] = digests(data, out["start"], out["start"] + out["strings"] + (width - 1)).T
    return out


def offset_groups(records: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each record and each group of OFFSETS minimizer offsets among its strings: row, group, least and largest offset."""
    high = records["offset"].astype(np.int64)  # the first string has the minimizer furthest in
    low = high - records["strings"] + 1
    groups = high // OFFSETS - low // OFFSETS + 1
    row = np.repeat(np.arange(len(records)), groups)
    group = low[row] // OFFSETS + np.arange(len(row)) - np.repeat(np.cumsum(groups) - groups, groups)
    return row, group, np.maximum(group * OFFSETS, low[row]), np.minimum(group * OFFSETS + OFFSETS - 1, high[row])


def core_of(at: np.ndarray, group: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the bytes begin and end that all strings of a group share. at: places of the minimizers."""
    return at - group * OFFSETS, at + width - np.minimum((group + 1) * OFFSETS - 1, width - min(GRAM, width))


def _by_doc(kind: int, doc: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """Rows of kind, doc and its packed rows."""
    order = np.argsort(doc, kind="stable")
    doc, rows = doc[order], rows[order]
    cuts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, dtype=np.int64)
    stops = np.concatenate([cuts[1:], [len(doc)]]).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(cuts), kind, dtype=np.int32)), pa.array(doc[cuts]), pa.array([rows[a:b].tobytes() for a, b in zip(cuts, stops)], pa.binary())], names=["kind", "doc", "pack"])


def _copies(kind: int, s: np.ndarray, rank: np.ndarray) -> pa.RecordBatch:
    """Links of the third and later records of each class to the first, under its document."""
    late = np.flatnonzero(rank > 1)
    base = s[late - rank[late]]
    links = np.empty(len(late), dtype=LINK)
    links["base"] = base["start"]
    for f in ("doc", "start", "strings"):
        links[f] = s[f][late]
    return _by_doc(kind, base["doc"], links)


def range_of(gram: np.ndarray, ranges: int) -> np.ndarray:
    return np.minimum(((_mix(gram) >> np.uint64(11)).astype(np.float64) / float(1 << 53) * ranges).astype(np.int64), ranges - 1)


def _routed(batch: pa.RecordBatch, ranges: int) -> pa.RecordBatch:
    """Rows that only pass through the shuffle."""
    return pa.RecordBatch.from_arrays([pa.array(-1 - batch.column("doc").to_numpy() % ranges), *batch.columns], names=["part", *batch.schema.names])


def _divided(of: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value of a sorted array with the rows that have it."""
    values, first = np.unique(of, return_index=True)
    for v, a, b in zip(values.tolist(), first.tolist(), [*first[1:].tolist(), len(of)]):
        yield v, rows[a:b]


def _grams(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a gram begins in sorted records, and how many it has."""
    change = np.flatnonzero(np.concatenate([[True], records["gram"][1:] != records["gram"][:-1]])) if len(records) else np.empty(0, dtype=np.int64)
    return change, np.diff(np.concatenate([change, [len(records)]])).astype(np.int64)


def route(texts: DataFrame, made, ranges: int, hot: bool) -> DataFrame:
    """kind, doc, pack of texts: copies of a first (NEAR, FAR: links), what must be merged (MIXED: records), and records of crowded minimizers (HOT).

    made: the records of a batch, in parts. Each task passes on the first two records of a class that it sees, and notes the others as
    copies, so a class that is everywhere costs two records a task. With ``hot``, a minimizer with many records in one task passes on
    only a mark, and one with many records in all isn't merged as it is: its records come back as HOT.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def hand_on():
            s, rank = classes(np.concatenate(held))
            held.clear()
            yield _routed(_copies(NEAR, s, rank), ranges)
            s = s[rank < 2]
            if hot:
                change, count = _grams(s)
                crowded = np.repeat(count > LOCAL_CROWD, count)
                yield _routed(_by_doc(HOT, s["doc"][crowded], s[crowded]), ranges)
                mark = s[change[count > LOCAL_CROWD]].copy()
                mark["strings"] = 0
                s = np.concatenate([s[~crowded], mark])
            of = range_of(s["gram"], ranges)
            order = np.argsort(of, kind="stable")
            s, of = s[order], of[order]
            cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.empty(0, dtype=np.int64)
            stops = np.concatenate([cuts[1:], [len(of)]]).astype(np.int64)
            packs = pa.array([s[a:b].tobytes() for a, b in zip(cuts, stops)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(of[cuts]), pa.array(np.full(len(cuts), MIXED, dtype=np.int32)), pa.nulls(len(cuts), pa.int64()), packs], names=["part", "kind", "doc", "pack"])

        n = 0
        for batch in batches:
            for records in made(batch):
                held.append(records)
                n += len(records)
                if n >= FLUSH:
                    yield from hand_on()
                    n = 0
        if held:
            yield from hand_on()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, packs in zip(batch.column("part").to_pylist(), batch.column("packs")):
                own = packs.values
                if part < 0:
                    yield pa.RecordBatch.from_arrays([own.field(c) for c in ("kind", "doc", "pack")], names=["kind", "doc", "pack"])
                    continue
                records = np.concatenate([np.frombuffer(p.as_py(), dtype=RECORD) for p in own.field("pack")])
                marked = records["gram"][records["strings"] == 0]
                s, rank = classes(records[records["strings"] > 0])
                yield _copies(FAR, s, rank)
                s = s[rank < 2]
                rank = rank[rank < 2]
                change, count = _grams(s)
                kinds = np.add.reduceat(rank == 0, change, dtype=np.int64) if len(s) else count
                crowded = np.isin(s["gram"][change], marked) | (hot & (count > CROWD))
                for kind, which in ((HOT, crowded), (MIXED, ~crowded & (kinds > 1))):
                    chosen = np.repeat(which, count)
                    yield _by_doc(kind, s["doc"][chosen], s[chosen])
                # the two of a class that is alone with its minimizer meet under the first one's document
                pair = s[np.repeat(~crowded & (kinds == 1) & (count == 2), count)].copy()
                pair["two"] = (pair["start"] - np.repeat(pair["start"][::2], 2)).view(np.uint64)
                pair["gram"], pair["offset"] = _mix(np.repeat(pair["doc"][::2], 2).view(np.uint64)), ALONE
                yield _by_doc(MIXED, pair["doc"], pair)

    rows = texts.mapInArrow(cut, "part long, kind int, doc long, pack binary")
    grouped = rows.groupBy("part").agg(F.collect_list(F.struct("kind", "doc", "pack")).alias("packs"))
    return stored(grouped.mapInArrow(decide, "kind int, doc long, pack binary"), "routed")


def inherit(copies: DataFrame, known: DataFrame) -> DataFrame:
    """doc, spans of the copies whose first is repeated throughout. copies: doc, pack of links; known: doc, spans of string starts that are repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for packed, spans in zip(batch.column("pack"), batch.column("spans").to_pylist()):
                links, s = np.frombuffer(packed.as_py(), dtype=LINK), np.frombuffer(b"".join(spans), dtype=SPAN)
                s = merged_spans(s["start"], s["end"])
                at = np.searchsorted(s["start"], links["base"], "right") - 1
                found.append(links[(at >= 0) & (s["end"][at] >= links["base"] + links["strings"])])
            every = np.concatenate(found) if found else np.empty(0, dtype=LINK)
            yield from _span_rows(every["doc"], every["start"], every["start"] + every["strings"])

    listed = stored(known.groupBy("doc").agg(F.collect_list("spans").alias("spans")), "repeated")
    return stored(copies.select("doc", "pack").join(listed, "doc").select("pack", "spans").mapInArrow(run, "doc long, spans binary"), "copies")


def repeated_spans(texts: DataFrame, width: int) -> DataFrame:
    """doc, spans (packed, of string starts) of what goes. texts: doc, text, each document once."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(16, size // RANGE_BYTES)
    text_of = lambda batch, k: batch.column("text")[k].as_py().encode("utf-8", "surrogatepass")
    # what is known of a document grows with the corpus, so these joins have one plan at every size
    listed = lambda df: stored(df.groupBy("doc").agg(F.collect_list("pack").alias("records")), "records")
    first = lambda batch: snippets_of_all((text_of(batch, k) for k in range(batch.num_rows)), batch.column("doc").to_pylist(), width)
    levels = [route(texts, first, ranges, True)]
    hot = listed(levels[0].where(F.col("kind") == HOT))
    if not hot.isEmpty():
        again = join_texts(texts, hot, "doc", broadcast=False)
        packed = lambda batch, k: np.frombuffer(b"".join(batch.column("records")[k].as_py()), dtype=RECORD)
        cut_again = lambda batch: (finer(text_of(batch, k), packed(batch, k), width) for k in range(batch.num_rows))
        levels.insert(0, route(again, cut_again, ranges, False))
    mixed = levels[0].where(F.col("kind") == MIXED)
    for level in levels[1:]:
        mixed = mixed.unionByName(level.where(F.col("kind") == MIXED))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The transform of a task's pieces, SHARD bytes at a time, and its other snippets, both divided by ranges."""

        def hand_on():
            rows = []
            if pieces:
                own, part = np.concatenate(pieces), range_of(np.concatenate(routes), ranges)
                order = np.argsort(part, kind="stable")
                own, part = own[order], part[order]
                transform, owner, _ = shard_transform([bodies[i] for i in order.tolist()])
                of = part[owner]
                by = np.argsort(of, kind="stable")  # within a range, the order of the suffixes stays
                rows += [(p, True, own[part == p].tobytes(), t.tobytes()) for p, t in _divided(of[by], transform[by])]
            if held:
                own = np.concatenate(held)
                part = range_of(own["gram"], ranges)
                order = np.argsort(part, kind="stable")
                for p, at in _divided(part[order], order):
                    rows.append((p, False, own[at].tobytes(), b"".join([snippet_bodies[i] for i in at.tolist()])))
            for x in (pieces, routes, bodies, held, snippet_bodies):
                x.clear()
            kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "made", "records", "data"])

        pieces, routes, bodies, held, snippet_bodies, size = [], [], [], [], [], 0
        for batch in batches:
            for k, packed in enumerate(batch.column("records")):
                r, data = np.frombuffer(b"".join(packed.as_py()), dtype=RECORD), text_of(batch, k)
                flat = np.frombuffer(data, dtype=np.uint8)
                own, way = chained(r[r["offset"] == ALONE])
                r = r[r["offset"] != ALONE]
                if len(own):
                    pieces.append(own), routes.append(way)
                    bodies += [flat[a:b] for a, b in zip(own["start"].tolist(), (own["start"] + own["strings"] + (width - 1)).tolist())]
                if len(r):
                    held.append(r)
                    snippet_bodies += [data[a:b] for a, b in zip(r["start"].tolist(), (r["start"] + r["strings"] + (width - 1)).tolist())]
                size += int(own["strings"].sum()) + len(own) * (width - 1)
                if size >= SHARD or len(snippet_bodies) >= FLUSH:
                    yield from hand_on()
                    size = 0
        if pieces or held:
            yield from hand_on()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole ranges, gathered up to MERGE bytes."""
        rows, size, last = [], 0, None

        def finish():
            transforms = [np.frombuffer(data, dtype=np.uint8) for made, _, data in rows if made]
            pieces = [np.frombuffer(r, dtype=PIECE) for made, r, _ in rows if made]
            loose = [np.frombuffer(r, dtype=RECORD) for made, r, _ in rows if not made]
            if loose:
                # neighbouring senders make one shard, since a transform for each would be very many small ones
                sender = np.repeat(np.arange(len(loose)) * RECEIVED // len(loose), [len(r) for r in loose])
                every = np.concatenate(loose)
                sizes = np.cumsum([0, *(every["strings"].astype(np.int64) + (width - 1))]).tolist()
                data = np.frombuffer(b"".join([d for made, _, d in rows if not made]), dtype=np.uint8)
                row, found, bodies = recurring(every, [data[a:b] for a, b in zip(sizes, sizes[1:])], width)
                for _, at in _divided(sender[row], np.arange(len(row))):
                    pieces.append(found[at])
                    transforms.append(shard_transform([bodies[i] for i in at.tolist()])[0])
            if not pieces:
                return
            doc, start, later = repeated(transforms, np.concatenate(pieces), width)
            for kind, which in ((REPEATED, slice(None)), (GONE, later)):
                for made in _span_rows(doc[which], start[which], start[which] + 1):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(made), kind, dtype=np.int32)), *made.columns], names=["kind", "doc", "spans"])

        for batch in batches:
            for part, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "made", "records", "data"))):
                if size >= MERGE and part != last:
                    yield from finish()
                    rows, size = [], 0
                rows.append(row)
                size, last = size + len(row[2]), part
        if rows:
            yield from finish()

    wanted = listed(mixed)
    amount = (wanted.agg(F.sum(F.aggregate("records", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p)))).first()[0] or 0) // RECORD.itemsize * 140
    sent = join_texts(texts, wanted, "doc", broadcast=False).mapInArrow(shards, "part long, made boolean, records binary, data binary")
    found = stored(sent.repartition(tasks_for(amount), "part").sortWithinPartitions("part").mapInArrow(merge, "kind int, doc long, spans binary"), "merged")
    known, gone = (found.where(F.col("kind") == k).select("doc", "spans") for k in (REPEATED, GONE))
    # a task's first may be a copy of the first of all, and a first of a crowded minimizer is known by its finer pieces
    for level in levels:
        for kind in (FAR, NEAR):
            made = inherit(level.where(F.col("kind") == kind), known)
            known, gone = known.unionByName(made), gone.unionByName(made)
    return gone.groupBy("doc").agg(F.collect_list("spans").alias("spans"))


def documents(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, bool]:
    """key, doc (a number in the order of documents) and text of every row, and whether no document repeats.

    Integer keys that are all there and differ are their own numbers. Otherwise the distinct keys and hashes of texts are sorted and numbered.
    """
    read = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    integral = isinstance(docs.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    if integral and read.groupBy("key").count().where("count > 1 OR key IS NULL").isEmpty():
        return read.select("key", F.col("key").cast("long").alias("doc"), "text"), True
    named = read.withColumn("name", document("key", "text"))
    order = named.select("name").distinct().orderBy("name").select("name", F.monotonically_increasing_id().alias("doc"))
    return join_texts(named, stored(order, "documents"), "name").select("key", "doc", "text"), False


def remove_repeats(docs: DataFrame, width: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans and kept (binary)."""
    rows, single = documents(docs, key, text)
    texts = rows.where(F.octet_length("text") >= width).select("doc", "text")
    texts = texts if single else stored(texts.dropDuplicates(["doc"]), "texts")
    spans = concluded(lambda: repeated_spans(texts, width), "spans")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, runs, kept = [], [], [], []
            for value, packed in zip(batch.column("text"), batch.column("spans").to_pylist()):
                data, s = value.as_py().encode("utf-8", "surrogatepass"), np.frombuffer(b"".join(packed or []), dtype=SPAN)
                s = merged_spans(s["start"], s["end"] + (width - 1))
                at, left = 0, []
                for a, b in s.tolist():
                    left.append(data[at:a])
                    at = b
                size.append(len(data)), gone.append(int((s["end"] - s["start"]).sum())), runs.append(len(s)), kept.append(b"".join([*left, data[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], names=["key", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())])
    made = join_texts(rows, spans, "doc", "left", broadcast=False).select("key", "text", "spans").mapInArrow(apply, schema)
    return made.select(F.col("key").alias(key), "n_bytes", "n_removed", "n_spans", "kept")
