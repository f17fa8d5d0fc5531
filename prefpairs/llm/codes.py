"""Vector codes: every part of a vector becomes the index of its nearest codebook entry, found
by Orchard search.

A vector's components are made integers and the vector is cut into equal parts, each with a
codebook of its own. For every entry of a codebook the others are listed by their distance from
it. A search holds the nearest entry seen so far and goes through that entry's list. An entry
that is nearer becomes the one held, and the search jumps to its list; entries once measured
are marked and passed over. It ends at the first entry that lies beyond twice the current
distance from the one held: by the triangle inequality neither that entry nor any after it
can be nearer or as near. Distances are exact integers (their squares are compared, so twice
becomes four times), and of entries as near the one of the lower index is held.

A round assigns the parts of all vectors to their entries and replaces each entry by the mean of
its parts. A task keeps sums by entry and emits one row for each, so a round shuffles tasks x entries
rows however many vectors there are and brings one row an entry to the driver. Vectors are read
again in every round rather than written out.

Defined results: a row is left out if its vector is null, empty, or holds a null or non-finite
component, whatever its id and label; rows of equal id count each, ordered by their vectors
when the first ones are chosen, null ids last; fewer rows than entries give as many entries as
rows; an empty table gives an empty result. Vectors of different lengths, or of one that the number
of parts does not divide, are an error. Components beyond a bound (2^27 for 64 of them, about half
a million before scaling) are held at the bound, where distances could pass 64 bits. Working columns are
prefixed ``_vc_``; only the named columns of the input are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefpairs.llm.common import materialize

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors searched together; bounds the search's working arrays.
BLOCK = 2048


def component_bound(dim: int) -> int:
    """Largest component at which the squared distance of two vectors stays below 2^62."""
    return math.isqrt(2**62 // max(dim, 1)) // 2


def integers(vectors: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are kept, their integer components). ``dim``: the length that they must have."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.where(vectors.is_valid().to_numpy(zero_copy_only=False), vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64())
    ok = flat.is_valid().to_numpy(zero_copy_only=False) & np.isfinite(flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
    row = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.bincount(row[~ok], minlength=len(lengths)) > 0
    kept = np.flatnonzero((lengths > 0) & ~bad)
    sizes = set(lengths[kept].tolist()) | ({dim} if dim else set())
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes)}")
    size = sizes.pop() if sizes else 0
    if size % PARTS:
        raise ValueError(f"vectors of {size} components cannot be cut into {PARTS} equal parts")
    use = np.zeros(len(lengths), bool)
    use[kept] = True
    values = flat.fill_null(0).to_numpy(zero_copy_only=False)[use[row]].reshape(len(kept), size)
    bound = component_bound(size)
    return kept, np.clip(np.floor(values * SCALE), -bound, bound).astype(np.int64)


@dataclass(frozen=True)
class Orchard:
    """A codebook's entries and, for each of them, the others by distance (ties by index)."""

    entries: np.ndarray
    order: np.ndarray
    apart: np.ndarray
    start: int

    @classmethod
    def plant(cls, entries: np.ndarray) -> Orchard:
        gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        n = len(entries)
        own = gaps.copy()
        own[np.arange(n), np.arange(n)] = -1  # an entry heads its own list, before its equals
        order = np.argsort(own, axis=1, kind="stable")[:, 1:]
        # Searches start at the entry with the least sum of distances.
        start = int(np.argmin(np.sqrt(gaps.astype(float)).sum(axis=1)))
        return cls(entries, order, np.take_along_axis(gaps, order, axis=1), start)

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the entry nearest to each row of ``x``."""
        n, listed = len(x), self.order.shape[1]
        held = np.full(n, self.start)
        best = ((x - self.entries[self.start]) ** 2).sum(axis=1)
        marked = np.zeros((n, len(self.entries)), bool)
        marked[:, self.start] = True
        at = np.zeros(n, np.int64)
        going = np.arange(n) if listed else np.empty(0, np.int64)
        while len(going):
            h, k = held[going], at[going]
            # Beyond twice the current distance; without products that could pass 64 bits.
            within = self.apart[h, k] // 4 <= best[going]
            within &= (self.apart[h, k] // 4 < best[going]) | (self.apart[h, k] % 4 == 0)
            going, h, k = going[within], h[within], k[within]
            at[going] += 1
            s = self.order[h, k]
            fresh = ~marked[going, s]
            rows, s, h = going[fresh], s[fresh], h[fresh]
            marked[rows, s] = True
            d = ((x[rows] - self.entries[s]) ** 2).sum(axis=1)
            nearer = (d < best[rows]) | (d == best[rows]) & (s < h)
            rows = rows[nearer]
            held[rows], best[rows], at[rows] = s[nearer], d[nearer], 0
            going = going[at[going] < listed]
        return held, best


def plant_all(codebooks: np.ndarray) -> list[Orchard]:
    return [Orchard.plant(codebooks[p]) for p in range(len(codebooks))]


def assign(orchards: list[Orchard], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indexes by row and part, squared distances likewise)."""
    width = vectors.shape[1] // len(orchards)
    found = [orchard.search(vectors[:, p * width : (p + 1) * width]) for p, orchard in enumerate(orchards)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], at: int, dim: int):
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            part = batch.slice(lo, BLOCK)
            kept, vectors = integers(part.column(at), dim)
            if len(kept):
                yield part.take(pa.array(kept)), vectors


def _sums(codebooks: np.ndarray):
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchards = plant_all(codebooks)
        total, count = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for _, vectors in _blocks(batches, 0, parts * width):
            index, _ = assign(orchards, vectors)
            for p in range(parts):
                slot = p * entries + index[:, p]
                np.add.at(total, slot, vectors[:, p * width : (p + 1) * width])
                count += np.bincount(slot, minlength=len(count))
        used = np.flatnonzero(count)
        values = pa.array(total[used].ravel())
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * width, pa.int32()), values)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), sums], names=["slot", "n", "sums"])

    return run


def _first_codebooks(kept: DataFrame) -> np.ndarray | None:
    """The parts of the vectors of the smallest ids, as (part, entry, component)."""
    head = kept.orderBy(F.col("_vc_id").asc_nulls_last(), "_vc_v").limit(ENTRIES).select("_vc_v")
    _, vectors = integers(pa.array([r[0] for r in head.collect()], pa.list_(pa.float64())))
    if not len(vectors):
        return None
    return np.ascontiguousarray(vectors.reshape(len(vectors), PARTS, -1).transpose(1, 0, 2))


def train(kept: DataFrame, codebooks: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after ``rounds`` of assignment and replacement by floored means."""
    parts, entries, width = codebooks.shape
    sums = [F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)]
    for _ in range(rounds):
        found = kept.select("_vc_v").mapInArrow(_sums(codebooks), "slot long, n long, sums array<long>")
        codebooks = codebooks.copy()
        for slot, n, *total in found.groupBy("slot").agg(F.sum("n").alias("n"), *sums).collect():
            codebooks[slot // entries, slot % entries] = [t // n for t in total]
    return codebooks


def _encoded(codebooks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchards = plant_all(codebooks)
        for part, vectors in _blocks(batches, 2, codebooks.shape[0] * codebooks.shape[2]):
            index, error = assign(orchards, vectors)
            codes = [bytes(row).hex() for row in index.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(codes), pa.array(error.sum(axis=1))], names=["id", "label", "code", "error"])

    return run


def codebooks_digest(codebooks: np.ndarray) -> str:
    """Digest of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray | None]:
    """(rows, codebooks): id, label, code, error (squared distances over the parts) and
    label_error (error over the rows of equal label, nulls together)."""
    rows = df.select(F.col(id_col).alias("_vc_id"), F.col(label).alias("_vc_label"), F.col(vector).cast("array<double>").alias("_vc_v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    # Nested in the test, so that the order of rows compares kept vectors only.
    kept = rows.filter((F.size("_vc_v") > 0) & F.forall("_vc_v", finite))
    codebooks = _first_codebooks(kept)
    kinds = f"id {df.schema[id_col].dataType.simpleString()}, label {df.schema[label].dataType.simpleString()}, code string, error long"
    if codebooks is None:
        return df.sparkSession.createDataFrame([], kinds + ", label_error long"), None
    codebooks = train(kept, codebooks)
    out = materialize(kept.select("_vc_id", "_vc_label", "_vc_v").mapInArrow(_encoded(codebooks), kinds), "vector-codes")
    # Written, so that the join below is a plain one that AQE can split on a hot label.
    sums = materialize(out.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    joined = out.join(sums.withColumnRenamed("label", "_vc_label"), F.col("label").eqNullSafe(F.col("_vc_label")), "left").drop("_vc_label")
    return joined, codebooks
