"""Plain versions of the operators, one row at a time."""

import hashlib
import re
from collections import Counter

import xxhash

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def blank_words(text):
    return [w for w in BLANK.split(text or "") if w]


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(docs, items, window=10):
    """doc -> (n_words, n_hit, items)."""
    grams = {}
    for item, text in items:
        w = plain_words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[k : k + n]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = {}
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[g]
        out[doc] = (len(w), len(hit), found)
    return out


def base_statistics(text):
    """word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = blank_words(text)
    lines = [x for x in text.split("\n") if blank_words(x)]
    grams = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    count = Counter(grams)
    covered = {i for k, g in enumerate(grams) if count[g] > 1 for i in range(k, k + 8)}
    n = len(words)
    return sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


def fingerprint(text):
    words = blank_words(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs, budget=2):
    """doc -> (fingerprint, component)."""
    prints = {doc: fingerprint(text) for doc, text in docs}
    root = {doc: doc for doc in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    known = {}
    for doc in sorted(prints):
        known.setdefault(prints[doc], []).append(doc)
    values = list(known)
    for same in known.values():
        for d in same[1:]:
            root[max(top(d), top(same[0]))] = min(top(d), top(same[0]))
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= budget:
                x, y = top(known[a][0]), top(known[b][0])
                root[max(x, y)] = min(x, y)
    return {doc: (prints[doc], top(doc)) for doc in prints}


def jaccard_groups(rows, similarity=0.8):
    """key -> smallest key of its group, by comparing all pairs."""
    sets = {}
    for d, t in rows:
        w = blank_words(lower(t))
        sets[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and root[a] != root[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    return root


def one_edit(a, b):
    """Word edit distance at most 1, by dynamic programming."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] <= 1


def deduplicated_lines(docs, min_words=5):
    """doc -> kept text, by comparing each line with every earlier distinct one of about its length."""
    seen, out = {}, {}
    for doc, text in sorted((d for d in docs if d[1] is not None), key=lambda d: d[0]):
        kept = []
        for line in text.split("\n"):
            w = tuple(blank_words(line))
            if w:
                near = w in seen.get(len(w), ()) or len(w) >= min_words and any(one_edit(w, v) for n in (len(w) - 1, len(w), len(w) + 1) if n >= min_words for v in seen.get(n, ()) if len(set(w) ^ set(v)) <= 2)
                if w not in seen.setdefault(len(w), set()):
                    seen[len(w)].add(w)
                if near:
                    continue
            kept.append(line)
        out[doc] = "\n".join(kept)
    return out


def removed_bytes(docs, width=100):
    """doc -> (n_bytes, n_removed, n_spans, sha256 of the rest)."""
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - width + 1):
            s = data[k : k + width]
            if s in seen:
                gone[k : k + width] = b"\1" * width
            else:
                seen.add(s)
        out[doc] = (len(data), sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return out
