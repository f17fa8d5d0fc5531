"""Vectorised words and word-window hashes over batches of UTF-8 texts (numpy)."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at a time; blocks end at white space, so a long text needs no more memory.
BLOCK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**64 - 1, size=256, dtype=np.uint64) | np.uint64(1)
_STEP = _RNG.integers(1, 2**64 - 1, size=64, dtype=np.uint64) | np.uint64(1)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """Powers of the multiplier, for words of up to n bytes."""
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 256)
        steps = np.full(size, _MULT, dtype=np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, byte offset of its start)."""
    buf = np.frombuffer(text, dtype=np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(buf):
        end = min(len(buf), at + BLOCK)
        while end < len(buf) and not _SPACE[buf[end]]:
            nxt = np.flatnonzero(_SPACE[buf[end : end + BLOCK]])
            end = end + int(nxt[0]) if len(nxt) else min(len(buf), end + BLOCK)
        part = buf[at:end]
        word = ~_SPACE[part]
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        own = part[word]
        if len(own):
            first = np.flatnonzero(begin[word])
            lengths = np.diff(np.append(first, len(own)))
            inside = np.arange(len(own)) - np.repeat(first, lengths)
            terms = _BYTE[own] * _powers(int(lengths.max()))[inside]
            hashes.append(mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64)))
            starts.append(np.flatnonzero(begin) + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def batch_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of several texts: (hashes, index of the text, number of words by text)."""
    parts = [t or b"" for t in texts]
    lengths = np.fromiter((len(t) + 1 for t in parts), np.int64, len(parts))
    w, at = word_hashes(b" ".join(parts))
    doc = np.searchsorted(np.cumsum(lengths), at, side="right")
    return w, doc, np.bincount(doc, minlength=len(parts))


def windows(w: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; the last size - 1 positions have none."""
    n = len(w) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += w[j : j + n] * _STEP[j]
    return mix(out)


def slices(texts: list[bytes | None], limit: int = 4 * BLOCK):
    """Ranges of ``texts`` of about ``limit`` bytes."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or b"")
        if held >= limit:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
