"""Exact "first n rows by key" without funnelling rows through one task.

``orderBy(k).limit(n)`` plans a TakeOrderedAndProject whose final step merges
``n x partitions`` rows in a single task, which does not hold for large n on a wide
cluster. Instead we find the n-th smallest key by distributed histogram refinement:
each round is one aggregation over the key column only (column-pruned, partial
aggregation on the map side) that returns at most ``buckets`` counts to the driver, and
narrows the candidate range ``buckets``-fold until one value is left. The rounds are the
same at every size: a 64-bit key needs at most 6, dense ids of N rows about
log_buckets(N). The prefix itself is then a plain filter ``key <= threshold`` that every
task applies independently.

Keys must be integral and, over the listed columns together, unique. A NULL key comes
after all others, so no row is lost when ``n`` reaches beyond the rows that have one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 4096

@dataclass(frozen=True)
class Rank:
    value: int      # the k-th smallest key
    below: int      # rows with key < value
    at_most: int    # rows with key <= value


def kth_smallest(df: DataFrame, col: str, k: int, buckets: int = DEFAULT_BUCKETS) -> Rank | None:
    """Rank of the k-th smallest (1-based) non-NULL value of integral column ``col``.

    Returns None when fewer than k non-NULL keys exist.
    """
    keys = df.select(F.col(col).cast("bigint").alias("k")).filter(F.col("k").isNotNull())
    # The rounds reread only this one column; keep it cached for their duration. A lost
    # block is recomputed from lineage, so executor loss costs time, not correctness.
    keys = keys.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _refine(keys, k, buckets)
    finally:
        keys.unpersist()


def _refine(
    keys: DataFrame,
    k: int,
    buckets: int,
    bounds: tuple[int, int] | None = None,
) -> Rank | None:
    if bounds is None:
        lo, hi, total = keys.agg(F.min("k"), F.max("k"), F.count(F.lit(1))).first()
    else:  # every key is known to lie in bounds: the first histogram also counts them
        (lo, hi), total = bounds, None
    if total == 0 or k < 1 or (total is not None and k > total):
        return None
    below, in_range = 0, total
    while lo != hi:
        width = -(-(hi - lo + 1) // buckets)
        if hi - lo < 2**63 - 1:  # k - lo is in [0, hi - lo]: BIGINT arithmetic cannot overflow
            bucket = F.expr(f"(k - cast({lo} as bigint)) div cast({width} as bigint)")
        else:  # a range spanning nearly all of BIGINT
            bucket = F.expr(f"(cast(k as decimal(20,0)) - cast({lo} as decimal(20,0))) div {width}")
        counts = (
            keys.filter(F.col("k").between(lo, hi))
            .groupBy(bucket.alias("b"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        hist = sorted((int(r["b"]), int(r["n"])) for r in counts)
        if in_range is None:  # first round over given bounds
            in_range = sum(n for _, n in hist)
            if k > in_range:
                return None
        for b, n in hist:
            if below + n >= k:
                lo, hi, in_range = lo + b * width, min(hi, lo + b * width + width - 1), n
                break
            below += n
    if in_range is None:  # bounds of a single value: count it
        in_range = keys.filter(F.col("k") == F.lit(lo)).count()
        if k > in_range:
            return None
    return Rank(value=lo, below=below, at_most=below + in_range)


def first_n_predicate(
    df: DataFrame,
    cols: list[str],
    n: int,
    buckets: int = DEFAULT_BUCKETS,
    head_bounds: tuple[int, int] | None = None,
) -> Column:
    """Predicate selecting exactly the first ``n`` rows of ``df`` ordered by ``cols``.

    The key tuple is projected and cached once; every refinement round, including the
    tie-breaking on later columns, reads only that cache. ``head_bounds`` (inclusive),
    when every value of the first column is known to lie in it, saves the min/max pass.
    """
    if n <= 0:
        return F.lit(False)
    keys = df.select(*[F.col(c).cast("bigint").alias(c) for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _prefix_predicate(keys, cols, n, buckets, head_bounds)
    finally:
        keys.unpersist()


def _prefix_predicate(
    keys: DataFrame, cols: list[str], n: int, buckets: int, head_bounds: tuple[int, int] | None = None
) -> Column:
    head = cols[0]
    key = F.col(head)
    rank = _refine(keys.select(key.alias("k")).filter(F.col("k").isNotNull()), n, buckets, bounds=head_bounds)
    if rank is None:  # fewer keys than n: all of them, then rows without one
        return _with_null_keys(keys, cols, n, buckets)
    if rank.at_most == n:
        return key <= F.lit(rank.value)
    if len(cols) == 1:
        raise ValueError(f"ordering key is not unique: {rank.at_most - rank.below} rows share the value at position {n}")
    ties = keys.filter(key == F.lit(rank.value))
    rest = _prefix_predicate(ties, cols[1:], n - rank.below, buckets)
    return (key < F.lit(rank.value)) | ((key == F.lit(rank.value)) & rest)


def _with_null_keys(keys: DataFrame, cols: list[str], n: int, buckets: int) -> Column:
    """First ``n`` rows when at most ``n`` have a key in ``cols[0]``."""
    key = F.col(cols[0])
    have, none = keys.agg(F.count(key), F.count_if(key.isNull())).first()
    left = n - have
    if left >= none:
        return F.lit(True)
    if left == 0:
        return key.isNotNull()
    if len(cols) == 1:
        raise ValueError(f"ordering key is not unique: {none} rows without a key follow the first {have}")
    return key.isNotNull() | (key.isNull() & _prefix_predicate(keys.filter(key.isNull()), cols[1:], left, buckets))


def first_n(df: DataFrame, cols: list[str], n: int, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """The first ``n`` rows ordered by ``cols`` (unordered output; sort if you need it)."""
    return df.filter(first_n_predicate(df, cols, n, buckets))
