"""Exact substring dedup by fixed-block anchors.

A repeat is a window of ``length`` consecutive words that also starts in a document with a
smaller id; every word under such a window goes. Of any ``length`` words, at least one
aligned block of ``(length + 1) // 2`` words lies whole inside, so:

1. Index and probe. The non-overlapping blocks of every document are the index, and every
   rolling window of block length probes it. Both travel in one shuffle, as sorted,
   delta-coded runs of truncated hashes; a hash that two documents share, one of them
   with an aligned block, is an anchor of both.
2. Extend. Around each anchor a document extends by whole windows: each window over an
   anchor is hashed (64 bits) and the smallest document id of each is found.
3. Remove. Windows with a smaller document elsewhere are laid over the words;
   neighbouring windows join to maximal repeats, and the words under them go.

Skew: before either shuffle a task reduces its documents to one entry per distinct hash
(the documents beyond the first are settled on the spot), so a passage that a third of all
documents share costs one entry per batch of a task. Parts are ranges of the hash and their
number grows with the input. Truncation in step 1 can only add anchors, never lose one.

Defined results: null text: no words; a null id is neither smaller nor larger than another,
so such a document loses nothing and removes nothing; rows of one id do not remove each
other's words; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefpairs.llm.wordhash import batch_words, mix, slices, windows

LENGTH = 13
#: Entries that a task gathers before it sorts and sends them.
BATCH_ENTRIES = 2_000_000
#: Settled entries by row.
SETTLED_ENTRIES = 100_000
#: Words by part of the shuffles.
PART_WORDS = 1_500_000

RUN_SCHEMA = "part int, kind int, n int, hashes binary, docs binary, ids binary"
PAIR_SCHEMA = "id long, hash long"
_RUN = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary()), ("ids", pa.binary())])
_PAIR = pa.schema([("id", pa.int64()), ("hash", pa.int64())])
GLOBAL, SETTLED = 0, 1


def _pack(x: np.ndarray) -> bytes:
    """Unsigned values as byte planes, as many as the largest value needs."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.zeros((n, 8), np.uint8)
    planes[:, : data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], n).T
    return planes.reshape(-1).view("<u8").astype(np.uint64)


def _run(part: int, kind: int, h: np.ndarray, ids: np.ndarray, flags: np.ndarray) -> tuple:
    """One row of the shuffle: hashes in ascending order, their documents and flags."""
    own, index = np.unique(ids, return_inverse=True)
    steps = lambda x: np.diff(x, prepend=x.dtype.type(0))
    return part, kind, len(h), _pack(steps(h)), _pack((index.astype(np.uint64) << np.uint64(2)) | flags.astype(np.uint64)), len(own).to_bytes(4, "little") + _pack(steps(own.view(np.uint64)))


def _read_run(n: int, hashes: bytes, docs: bytes, ids: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = np.cumsum(_unpack(ids[4:], int.from_bytes(ids[:4], "little")), dtype=np.uint64).view(np.int64)
    packed = _unpack(docs, n)
    return np.cumsum(_unpack(hashes, n), dtype=np.uint64), own[(packed >> np.uint64(2)).astype(np.int64)], (packed & np.uint64(3)).astype(np.uint8)


def _run_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows, strict=True), _RUN, strict=True)], schema=_RUN)


class _Entries:
    """(hash, id, flag) entries of a task, sent as one run per part.

    ``first``: of a hash's documents the smallest id goes on and the others are settled
    (they have a smaller one); else all of several are settled and a marker goes on.
    """

    BLOCK, SEVERAL = 1, 2

    def __init__(self, parts: int, bits: int, first: bool):
        self.parts, self.bits, self.first, self.sent = parts, bits, first, 0
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, h: np.ndarray, ids: np.ndarray, flags: np.ndarray) -> None:
        self.held.append((h, ids, flags))
        self.n += len(h)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        h, ids, flags = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.n = [], 0
        order = np.lexsort((ids, h))
        h, ids, flags = h[order], ids[order], flags[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])
        at = np.flatnonzero(new)
        h, ids, flags = h[at], ids[at], np.bitwise_or.reduceat(flags, at)
        lead = np.ones(len(h), bool)
        lead[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(lead)
        count = np.diff(np.append(at, len(h)))
        several = np.repeat(count > 1, count)
        settled = several & ~lead if self.first else several
        top = np.bitwise_or.reduceat(flags, at)
        if not self.first:
            top = top | np.where(count > 1, self.SEVERAL, 0).astype(np.uint8)
        gh, gids = h[at], ids[at]
        bounds = np.append(np.searchsorted(gh, self.edges()), len(gh))
        rows = []
        for p in range(self.parts):
            lo, hi = (bounds[p - 1] if p else 0), bounds[p]
            if hi > lo:
                rows.append(_run(p, GLOBAL, gh[lo:hi], gids[lo:hi], top[lo:hi]))
        sh, sids = h[settled], ids[settled]
        for lo in range(0, len(sh), SETTLED_ENTRIES):
            self.sent += 1
            h_, d_ = sh[lo : lo + SETTLED_ENTRIES], sids[lo : lo + SETTLED_ENTRIES]
            # Any part will do; which one follows from what is sent.
            rows.append(_run(int(mix(h_[:1] + np.uint64(self.sent))[0] % np.uint64(self.parts)), SETTLED, h_, d_, np.zeros(len(h_), np.uint8)))
        for lo in range(0, len(rows), 64):
            yield _run_batch(rows[lo : lo + 64])

    def edges(self) -> np.ndarray:
        """Ends of the parts' hash ranges, but the last."""
        return np.array([(p << self.bits) // self.parts for p in range(1, self.parts)], dtype=np.uint64)


def _held(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list, slice]]:
    """(word hashes, document index, ids, texts, rows) of slices of a batch."""
    texts = batch.column("text").to_pylist()
    ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
    for lo, hi in slices(texts):
        w, doc, _ = batch_words(texts[lo:hi])
        yield w, doc, ids[lo:hi], texts[lo:hi], slice(lo, hi)


def _inside(doc: np.ndarray, size: int) -> np.ndarray:
    """Whether a window of ``size`` words from here lies in one document."""
    return doc[: max(0, len(doc) - size + 1)] == doc[size - 1 :]


def _first_word(doc: np.ndarray) -> np.ndarray:
    """Position in its document of each word."""
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    return np.arange(len(doc)) - np.repeat(at, np.diff(np.append(at, len(doc))))


def _probe(block: int, parts: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _Entries(parts, bits, first=False)
        for batch in batches:
            for w, doc, ids, _, _ in _held(batch):
                ok = np.flatnonzero(_inside(doc, block))
                h = windows(w, block)[ok] >> np.uint64(64 - bits)
                entries.add(h, ids[doc[ok]], (_first_word(doc)[ok] % block == 0).astype(np.uint8))
                if entries.n >= BATCH_ENTRIES:
                    yield from entries.flush()
        yield from entries.flush()

    return run


def _matches(keys: np.ndarray, doc: np.ndarray, wanted: list, rows: int) -> np.ndarray:
    """Whether (document, hash) is among the document's wanted hashes."""
    sizes = np.fromiter((0 if x is None else len(x) for x in wanted), np.int64, rows)
    if not sizes.sum() or not len(keys):
        return np.zeros(len(keys), bool)
    values = np.concatenate([np.asarray(x, np.int64) for x in wanted if x is not None and len(x)]).view(np.uint64)
    salt = mix(np.arange(1, rows + 1, dtype=np.uint64))
    return np.isin(mix(keys ^ salt[doc]), mix(values ^ salt[np.repeat(np.arange(rows), sizes)]))


def _lists(column: pa.Array, rows: slice) -> list:
    return [None if x is None or not x.is_valid else x.values.to_numpy(zero_copy_only=False) for x in column[rows]]


def _extend(block: int, length: int, parts: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _Entries(parts, 64, first=True)
        for batch in batches:
            batch = batch.filter(batch.column("wanted").is_valid())
            for w, doc, ids, texts, rows in _held(batch):
                ok = np.flatnonzero(_inside(doc, block))
                hit = np.zeros(len(w) + length, np.int64)
                h = windows(w, block)[ok] >> np.uint64(64 - bits)
                hit[ok] = _matches(h, doc[ok], _lists(batch.column("wanted"), rows), len(texts))
                before = np.concatenate([[0], np.cumsum(hit)])
                # Windows that start at most length - block words before an anchor.
                start = np.flatnonzero(_inside(doc, length))
                start = start[before[start + length - block + 1] > before[start]]
                entries.add(windows(w, length)[start], ids[doc[start]], np.zeros(len(start), np.uint8))
                if entries.n >= BATCH_ENTRIES:
                    yield from entries.flush()
        yield from entries.flush()

    return run


def _settle(first: bool):
    """Entries of one part -> (id, hash) pairs: anchors, or windows with a smaller id."""

    def run(table: pa.Table) -> pa.Table:
        out_ids, out_hashes, held = [], [], []
        for part in table.select(["kind", "n", "hashes", "docs", "ids"]).to_batches():
            for kind, n, hashes, docs, ids in zip(*(c.to_pylist() for c in part.columns), strict=True):
                h, d, f = _read_run(n, hashes, docs, ids)
                if kind == SETTLED:
                    out_ids.append(d)
                    out_hashes.append(h)
                else:
                    held.append((h, d, f))
        if held:
            h, d, f = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((d, h))
            h, d, f = h[order], d[order], f[order]
            lead = np.ones(len(h), bool)
            lead[1:] = h[1:] != h[:-1]
            at = np.flatnonzero(lead)
            count = np.diff(np.append(at, len(h)))
            if first:
                found = d > np.repeat(d[at], count)
            else:
                flags = np.bitwise_or.reduceat(f, at)
                # Rows of one id may come from several tasks: only other ids count.
                other = np.maximum.reduceat(d, at) != d[at]
                shared = (other | (flags & _Entries.SEVERAL > 0)) & (flags & _Entries.BLOCK > 0)
                found = np.repeat(shared, count) & (f & _Entries.SEVERAL == 0)
            out_ids.append(d[found])
            out_hashes.append(h[found])
        ids = np.concatenate(out_ids) if out_ids else np.empty(0, np.int64)
        hashes = np.concatenate(out_hashes).view(np.int64) if out_hashes else np.empty(0, np.int64)
        return pa.Table.from_arrays([pa.array(ids), pa.array(hashes)], schema=_PAIR)

    return run


def _remove(length: int):
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, doc, _, texts, rows in _held(batch):
                start = np.flatnonzero(_inside(doc, length))
                wanted = _lists(batch.column("wanted"), rows)
                start = start[_matches(windows(w, length)[start], doc[start], wanted, len(texts))]
                step = np.zeros(len(w) + 1, np.int64)
                step[start] += 1
                step[start + length] -= 1
                gone = np.cumsum(step[:-1]) > 0
                n = np.bincount(doc, minlength=len(texts))
                removed = np.bincount(doc, weights=gone, minlength=len(texts)).astype(np.int64)
                ends = np.cumsum(n)
                kept = []
                for text, k, lo, hi in zip(texts, removed.tolist(), (ends - n).tolist(), ends.tolist(), strict=True):
                    own = (text or b"").split()
                    kept.append(b" ".join(itertools.compress(own, (~gone[lo:hi]).tolist()) if k else own).decode(errors="replace"))
                yield pa.RecordBatch.from_arrays([batch.column("id")[rows], pa.array(n.astype(np.int64)), pa.array(removed), pa.array(kept, pa.string())], schema=schema)

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept (remaining words, one space apart)."""
    block = (length + 1) // 2
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    words = max(1, size // 6)
    parts = max(24, -(-words // PART_WORDS))
    # Twelve bits beyond the number of words keep chance anchors rare at any size.
    bits = min(64, max(40, words.bit_length() + 12))
    known = src.filter(F.col("id").isNotNull() & F.col("text").isNotNull())

    def by_document(runs: DataFrame, first: bool) -> DataFrame:
        pairs = runs.groupBy("part").applyInArrow(_settle(first), PAIR_SCHEMA)
        return pairs.groupBy("id").agg(F.collect_list("hash").alias("wanted"))

    anchors = by_document(known.mapInArrow(_probe(block, parts, bits), RUN_SCHEMA), first=False)
    # Both joins read the same exchange of the texts, so nothing narrows this one.
    repeats = by_document(src.join(anchors, "id", "left").mapInArrow(_extend(block, length, parts, bits), RUN_SCHEMA), first=True)
    return src.join(repeats, "id", "left").mapInArrow(_remove(length), "id long, n_words long, n_removed long, kept string")
