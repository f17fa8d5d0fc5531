"""Mixing sources to target weights by systematic sampling.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the
whole size of the corpus; a target stops at ``max_copies`` times its source's size and
the excess is shared again among the others by weight, until none is above.

Sampling: within a source every document has the same expected number of copies, target /
source size. The documents are put in order of size, their expected copies are
prefix-summed, one random offset per source is added, and a document is emitted once for
each integer boundary its step crosses. Ordering by size makes the words taken follow the
target to within about one document.

The prefix sum is distributed: rows are range-partitioned by (source, size, id), counted
by (part, source), and the counts of earlier parts are added to the rank within the part.
A hot source, or a hot size within one, is split like any other range. The sources are
numbered and their caps summed in the same way, so no task holds all of them.

Defined results: a null text has size 0; null is a source of its own; repeated rows are
sampled one by one; a corpus without words gives targets of 0 and no copies; an empty table
gives an empty result. Working columns are prefixed ``_mx_``. Reruns agree: the offset is
a hash of the seed and the source, and the order is total up to interchangeable rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefpairs.llm.common import WHITE, materialize

#: The weights, in the order of the sources, repeating.
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = 42


def size_of(text: Column) -> Column:
    """Number of words: starts of runs of other than white space."""
    t = F.coalesce(text, F.lit(""))
    return F.size(F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def offset_of(source: Column, seed: int = SEED) -> Column:
    """Random offset in [0, 1) of a source: 52 bits of a keyed digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _running(rows: DataFrame, order: list[Column], sums: list[str], name: str) -> DataFrame:
    """``rows`` with ``before_<c>``, the sum of c over the rows that come earlier in a total
    ``order``, and ``all_<c>``, its sum over all rows; a task holds one range of the order."""
    ranged = materialize(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), f"{name}-order")
    # One row per part: their number is that of the partitions, not of the rows.
    parts = ranged.groupBy("part").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = [x for c in sums for x in (F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"start_{c}"), F.sum(c).over(whole).alias(f"all_{c}"))]
    starts = materialize(parts.select(F.col("part").alias("start_part"), *offsets), f"{name}-parts")
    local = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.select("*", *[F.coalesce(F.sum(c).over(local), F.lit(0)).alias(f"in_{c}") for c in sums])
    joined = within.join(F.broadcast(starts), F.col("part") == F.col("start_part"))
    return joined.select(*rows.columns, *[x for c in sums for x in ((F.col(f"start_{c}") + F.col(f"in_{c}")).alias(f"before_{c}"), F.col(f"all_{c}"))])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``sizes`` (source, size) by document -> source, source_size, target.

    The capped sources are those of smallest cap / weight, so one pass over the sources in
    that order finds them. One row per source after a partial aggregate; the sources are
    numbered, and their caps and weights summed, along range partitions.
    """
    src = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mixing-sources")
    named = _running(src.withColumn("one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], ["one"], "mixing-names")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("before_one") % len(weights) + 1).cast("int"))
    src = named.select("source", "source_size", w.cast("long").alias("weight"), (F.col("source_size") * max_copies).alias("cap"))
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    src = _running(src, order, ["cap", "weight", "source_size"], "mixing-caps")
    level = (F.col("all_source_size") - F.col("before_cap")) / (F.col("all_weight") - F.col("before_weight"))
    src = materialize(src.withColumn("capped", level > F.col("cap") / F.col("weight")), "mixing-levels")
    rest = src.agg(
        (F.max("all_source_size") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0))).alias("free"),
        F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).alias("left"),
    )
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("free") / F.col("left") * F.col("weight"))
    return src.crossJoin(F.broadcast(rest)).select("source", "source_size", target.alias("target"))


def sampled(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per document: id, source, key (hash of the text), size, source_size, target,
    copies."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.xxhash64(text).alias("key"), size_of(F.col(text)).alias("size"))
    # Written before the ranges are drawn, so that sampling them does not read the texts again.
    rows = materialize(rows, "mixing-rows")
    order = ["source", "size", "id", "key"]
    # The part number is written with the rows: it must not change if a task runs again.
    ranged = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    parts = materialize(ranged, "mixing-order")
    targets = materialize(source_targets(parts), "mixing-targets")
    # One row per part and source: as many as there are parts and sources.
    counts = parts.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(counts.select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")), "mixing-starts")
    local = F.row_number().over(Window.partitionBy("part", "source").orderBy("size", "id", "key"))
    ranked = parts.withColumn("local", local)
    same = ranked["source"].eqNullSafe(starts["source"]) & (ranked["part"] == starts["part"])
    ranked = ranked.join(starts, same).select("id", ranked["source"], "key", "size", (F.col("start") + F.col("local")).alias("k"))
    ranked = ranked.join(targets, ranked["source"].eqNullSafe(targets["source"])).select("id", ranked["source"], "key", "size", "k", "source_size", "target")
    step = F.when(F.col("source_size") > 0, F.least(F.lit(float(max_copies)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    at = lambda k: F.floor(k * step + offset_of(F.col("source"), seed))
    return ranked.select("id", "source", "key", "size", "source_size", "target", (at(F.col("k")) - at(F.col("k") - 1)).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as it was drawn."""
    drawn = sampled(docs, id_col, text, source, seed).groupBy("id", "source", "key").agg(F.sum("copies").alias("_mx_c"), F.count(F.lit(1)).alias("_mx_m"))
    drawn = drawn.filter("_mx_c > 0").withColumnsRenamed({"id": "_mx_id", "source": "_mx_source", "key": "_mx_key"})
    # The row travels in a struct, out of reach of the working columns' names.
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.col(source).alias("source"), F.xxhash64(text).alias("key"))
    same = (F.col("key") == F.col("_mx_key")) & F.col("id").eqNullSafe(F.col("_mx_id")) & F.col("source").eqNullSafe(F.col("_mx_source"))
    joined = keyed.join(drawn, same)
    # Rows that agree in id, source and text share their draws evenly.
    nth = F.row_number().over(Window.partitionBy("key", "id", "source").orderBy(F.lit(1)))
    turn = F.when(F.col("_mx_m") == 1, F.lit(1)).otherwise(nth)
    n = F.floor(F.col("_mx_c") / F.col("_mx_m")) + (turn <= F.col("_mx_c") % F.col("_mx_m")).cast("long")
    return joined.withColumn("_mx_n", n).filter("_mx_n > 0").withColumn("_mx_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mx_n")))).select("row.*")
