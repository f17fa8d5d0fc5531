"""Plain Python versions of the operators' definitions."""

import collections
import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def line_units(text):
    """Lines, each with the blank lines after it."""
    units = []
    for k, line in enumerate(text.split("\n")):
        if k == 0 or WORD.search(line):
            units.append(line)
        else:
            units[-1] += "\n" + line
    return units


def line_dedup(rows, run=2, long=None):
    """(doc_id, text) -> {(doc_id, text): kept text}; ids in order, null first. With ``long``
    a line of so many words is a window of its own too."""
    seen, out = set(), {}
    order = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for key in order:
        units = line_units(key[1])
        keys = [u.strip(" \t\n\x0b\x0c\r") for u in units]
        gone = set()
        for s in range(len(keys) - run + 1):
            w = tuple(keys[s : s + run])
            if w in seen:
                gone.update(range(s, s + run))
            seen.add(w)
        for s, line in enumerate(keys):
            if long is not None and len(words(line)) >= long:
                if (line,) in seen:
                    gone.add(s)
                seen.add((line,))
        out[key] = ("\n".join(u for k, u in enumerate(units) if k not in gone), len(units), len(gone))
    return out


def substring(rows, length=13):
    """[(doc_id, text)] -> [(doc_id, n_words, n_removed, kept)]."""
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - length + 1):
            if i is not None:
                x = tuple(w[k : k + length])
                first[x] = min(first.get(x, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if i is not None and first[tuple(w[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def simhash(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(fps, radius=2):
    """Root of each fingerprint's component by comparing all pairs."""
    x, root = np.array(fps, np.uint64), list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]) <= radius):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(x))]


def metrics(text):
    t = text or ""
    w = words(t)
    n = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = set()
    for k in range(len(w) - 2):
        if n[tuple(w[k : k + 3])] > 1:
            covered.update((k, k + 1, k + 2))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
