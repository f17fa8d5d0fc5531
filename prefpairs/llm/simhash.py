"""SimHash near-duplicates through vantage-point trees.

Fingerprints: 64 bits, each set when it is set in over half of the shingles' XXH64 hashes.
Two fingerprints link when they differ in at most ``radius`` bits.

Search: a vantage-point tree, built on a bounded sample of the distinct fingerprints
(``SAMPLE``; every fingerprint is routed, whatever the sample), deals them to shards. At a
node with vantage point v and distance m, a fingerprint x goes inside if d(x, v) <= m +
radius and outside if d(x, v) > m: by the triangle inequality two fingerprints within the
radius always share a child, so no pair is lost, and only those in the boundary band go
both ways. Each shard is split further in its task by the same rule with vantage points of
its own, down to leaves that are compared in blocks. A set that no vantage point divides
(one dense cloud) is searched by looking up every fingerprint within the radius instead.
A shard of more than ``LARGE`` fingerprints, which the tree could not divide, is not one
task: its fingerprints meet at their midpoints, the values within half the radius of them,
in groups no larger than the number of those values.

A shard returns links to one representative of each of its clusters, never all pairs; the
links are joined to components across shards. Equal fingerprints count as one throughout,
so groups of copies cost nothing.

Defined results: null and empty texts, and texts without words, have fingerprint zero and
link like any other; a null id is not a smallest id unless no other is reachable, then the
component is null; repeated rows get the same result; an empty table gives an empty
result. Only the named columns are read, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefpairs.llm.common import materialize
from prefpairs.llm.components import connected_components

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Distinct fingerprints that the tree of shards is fitted on; all of them are searched.
SAMPLE = 16_384
#: Fingerprints by shard aimed at; the sample has a node for every eight of its own at most.
SHARD = 2_048
#: Fingerprints that one task searches; larger shards go by midpoints.
LARGE = 1 << 18
LEAF = 384
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = iter([b" ".join(words)])
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n, ones, digest = 0, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    while True:
        h = np.fromiter((digest(p, SEED) for p, _ in zip(parts, range(_CHUNK), strict=False)), np.uint64)
        if not len(h):
            break
        n += len(h)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def _fingerprints(shingle: int):
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in batch.column("text").to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(fps.view(np.int64))], schema=schema)

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, key, fp): key is a hash of the text, fp the fingerprint as a signed long."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), F.col(text).cast("binary").alias("text"))
    return src.mapInArrow(_fingerprints(shingle), "id long, key long, fp long")


def _distance(x: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(x ^ v)


def _divide(x: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """Vantage point and distance with the least work below, or None if nothing is gained."""
    probe = x if len(x) <= 4096 else rng.choice(x, 4096, replace=False)
    best, found = 0.75 * len(probe) ** 2, None
    for v in rng.choice(probe, min(8, len(probe)), replace=False):
        below = np.cumsum(np.bincount(_distance(probe, v), minlength=65 + radius))
        inside = np.append(below[radius:], [below[-1]] * radius)
        cost = inside.astype(float) ** 2 + (below[-1] - below).astype(float) ** 2
        m = int(np.argmin(cost))
        if cost[m] < best:
            best, found = float(cost[m]), (v, m)
    return found


@dataclass
class Tree:
    """Node k divides at (vantage[k], within[k]); children 2k + 1 (inside), 2k + 2."""

    depth: int
    vantage: dict[int, np.uint64]
    within: dict[int, int]
    radius: int

    @classmethod
    def fit(cls, sample: np.ndarray, depth: int, radius: int) -> Tree:
        tree, rng = cls(depth, {}, {}, radius), np.random.default_rng(SEED)
        todo = [(0, sample, 0)]
        while todo:
            k, x, level = todo.pop()
            if level < depth and len(x) >= 8 and (found := _divide(x, radius, rng)):
                tree.vantage[k], tree.within[k] = found
                d = _distance(x, found[0])
                todo += [(2 * k + 1, x[d <= found[1] + radius], level + 1), (2 * k + 2, x[d > found[1]], level + 1)]
        return tree

    def route(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, its members): members in a boundary band appear in several shards."""
        todo = [(0, x)]
        while todo:
            k, x = todo.pop()
            if not len(x):
                continue
            if k not in self.vantage:
                yield k, x
                continue
            d = _distance(x, self.vantage[k])
            todo += [(2 * k + 1, x[d <= self.within[k] + self.radius]), (2 * k + 2, x[d > self.within[k]])]


def _route(tree: Tree):
    schema = pa.schema([("shard", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, x in tree.route(batch.column("fp").to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), shard)), pa.array(x.view(np.int64))], schema=schema)

    return run


class _Clusters:
    """Clusters of positions 0..n-1 under links given in blocks."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def _offsets(radius: int) -> np.ndarray:
    """All masks of 1 to ``radius`` bits."""
    masks, last = [], np.array([0], np.uint64)
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for r in range(1, radius + 1):
        last = np.unique((last[:, None] ^ bits[None, :]).ravel())
        last = last[np.bitwise_count(last) == r]
        masks.append(last)
    return np.concatenate(masks) if masks else np.empty(0, np.uint64)


def shard_links(x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of one shard -> (representative, member) links of its clusters."""
    x = np.unique(x)
    clusters, rng = _Clusters(len(x)), np.random.default_rng(SEED)
    todo = [np.arange(len(x))]
    while todo:
        at = todo.pop()
        own = x[at]
        found = _divide(own, radius, rng) if len(at) > LEAF else None
        if found:
            d = _distance(own, found[0])
            todo += [at[d <= found[1] + radius], at[d > found[1]]]
        elif len(at) > 64 * LEAF:
            # Dense cloud: look up every neighbour; own is in ascending order.
            for mask in _offsets(radius):
                near = own ^ mask
                place = np.minimum(np.searchsorted(own, near), len(own) - 1)
                hit = np.flatnonzero(own[place] == near)
                clusters.link(at[hit], at[place[hit]])
        else:
            for lo in range(0, len(at), 256):
                a, b = np.nonzero(np.bitwise_count(own[lo : lo + 256, None] ^ own[None, lo:]) <= radius)
                clusters.link(at[lo + a[a < b]], at[lo + b[a < b]])
    member = np.flatnonzero(clusters.root != np.arange(len(x)))
    return x[clusters.root[member]], x[member]


def _search(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        a, b = shard_links(table.column("fp").to_numpy().view(np.uint64), radius)
        return pa.Table.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    return run


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``distinct`` (fp), each once -> links (a, b) whose components are those of all pairs
    within the radius."""
    n = distinct.count()
    rows = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(max(n, 1))) < SAMPLE).select("fp").toArrow()
    sample = np.sort(rows.column("fp").to_numpy().view(np.uint64))
    tree = Tree.fit(sample, (n // SHARD).bit_length(), radius)
    sharded = materialize(distinct.select("fp").mapInArrow(_route(tree), "shard long, fp long"), "simhash-shards")
    # One number a shard, of shards no more than the sample allows.
    large = [r["shard"] for r in sharded.groupBy("shard").count().filter(F.col("count") > LARGE).collect()]
    inside = F.col("shard").isin(large)
    found = sharded.filter(~inside).groupBy("shard").applyInArrow(_search(radius), "a long, b long")
    return found.unionAll(midpoint_links(sharded.filter(inside).select("fp").distinct(), radius)) if large else found


def midpoint_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within the radius, by a shuffle.

    Two fingerprints within the radius have a value between them that is within the radius
    halved and rounded down of one and rounded up of the other. A fingerprint is sent to all
    values that near; at each, all are linked to the smallest of those within the lower half.
    A value meets no more fingerprints than it has neighbours, however dense the cloud.
    """
    near = [0, *(int(m) for m in _offsets(radius // 2).view(np.int64))]
    far = sorted(set(int(m) for m in _offsets(radius - radius // 2).view(np.int64)) - set(near))
    masks = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m in set(far)).alias("far")) for m in near + far])
    sent = distinct.select("fp", F.inline(masks)).select(F.col("fp").bitwiseXOR(F.col("m")).alias("at"), "fp", "far")
    met = sent.groupBy("at").agg(F.min(F.when(~F.col("far"), F.col("fp"))).alias("a"), F.collect_list("fp").alias("met"))
    return met.filter((F.size("met") > 1) & F.col("a").isNotNull()).select("a", F.explode("met").alias("b")).filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: id, key, fp, first (id, key): the component's smallest id with
    its text hash; rows of null id come last."""
    rows = materialize(fingerprints(docs, id_col, text, shingle), "simhash-rows")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    distinct = materialize(rows.groupBy("fp").agg(F.min(order).alias("low")), "simhash-distinct")
    parts = connected_components(links(distinct, radius), "simhash-links")
    linked = materialize(parts.join(distinct, parts["node"] == distinct["fp"]).select("fp", "low", "component"), "simhash-linked")
    # Written, so that AQE can split the join on a large component.
    lows = materialize(linked.groupBy("component").agg(F.min("low").alias("first")), "simhash-lows")
    # Only fingerprints with a link need another's smallest id.
    classes = linked.join(lows, "component").select("fp", "first")
    firsts = materialize(distinct.join(classes, "fp", "left").select("fp", F.coalesce("first", "low").alias("first")), "simhash-firsts")
    return rows.join(firsts, "fp").select("id", "key", "fp", F.struct("first.id", "first.key").alias("first"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that come first, by (id, text hash), in their component: one each."""
    first = near_duplicates(docs, id_col, text, shingle, radius).select(F.col("first.id").alias("first_id"), F.col("first.key").alias("first_key")).distinct()
    # The row travels in a struct, out of reach of the working columns' names.
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("key"))
    kept = keyed.join(first, (F.col("key") == F.col("first_key")) & F.col("id").eqNullSafe(F.col("first_id")), "left_semi")
    # Rows alike in id and text are one document.
    nth = F.row_number().over(Window.partitionBy("key", "id").orderBy(F.lit(1)))
    return kept.withColumn("nth", nth).filter("nth = 1").select("row.*")
