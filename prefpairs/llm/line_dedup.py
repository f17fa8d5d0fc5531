"""Line dedup by winnowing (native: DataFrame functions only).

A document is the sequence of its lines. Every window of ``run`` consecutive lines selects
the smallest line hash in it (the rightmost of equals); the positions so selected, one row
each however many windows select them, are the document's fingerprints. Two equal runs of at
least ``run`` lines share a fingerprint at the same place: the winnowing guarantee. Positions
are joined on the fingerprint, and those that stand alone are dropped. A match is extended to
both sides by up to ``run`` - 1 lines, its surroundings: positions with the same surroundings
match over all of them, and of those the first is compared, window by window through its
fingerprint, with the first ones of other surroundings. What a longer run has beyond is
covered from its next fingerprints. Of equal windows the first in (document id, line) order
stays and the lines of all later ones go. No pair of positions is ever listed: a position only
meets the first of its like.

A line goes if and only if a window over it occurs earlier, in an earlier document or
earlier in its own. With ``long`` set, a single line of that many words or more is a window
of its own, so it also goes where its neighbours differ and where it is the whole document.

Lines are compared without white space at both ends, by two 64-bit hashes of different seeds
(128 bits). A blank line belongs to the line before it and goes with it; blank lines at the
start form one line of their own.

Defined results: a null text has no lines and stays null; documents of fewer than ``run``
lines lose none but long ones; rows equal in id and text count as one document and get the
same result; a null id comes before all others; an empty table gives an empty result. Input
columns of any name do no harm and are returned as they were, but for ``_ld_lines`` and
``_ld_removed``, which the result sets anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefpairs.llm.common import WHITE, materialize

#: Line break before a line with a word.
BREAK = r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), BREAK)


def _hashes(own: Column) -> Column:
    """(h, g) of each line; h selects, both together tell lines apart."""
    bare = F.transform(own, lambda x: F.trim(x, F.lit(WHITE)))
    return F.transform(bare, lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit("g"), x).alias("g")))


def _least(part: Column) -> Column:
    """Place of the smallest hash, the rightmost of equals, in a window."""
    return -F.array_min(F.transform(part, lambda x, k: F.struct(x["h"].alias("f"), (-k).alias("back"))))["back"]


def _selected(hs: Column, run: int) -> Column:
    """Positions that some window of ``run`` lines selects, each once."""
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(hs) - run), lambda s: s + _least(F.slice(hs, s + 1, run))))


def _place(n: int, p: Column, lo: Column, near: Column) -> Column:
    return F.struct(F.lit(n).alias("n"), p.alias("p"), (p - lo).alias("at"), near.alias("near"))


def _with_surroundings(hs: Column, run: int) -> Column:
    """(n, p, at, near) of the selected positions: near are the lines from at most run - 1
    before the position to as many behind, at its place among them."""

    def place(p: Column) -> Column:
        lo = F.greatest(F.lit(0), p - (run - 1))
        return _place(run, p, lo, F.slice(hs, lo + 1, F.least(F.size(hs), p + run) - lo))

    return F.transform(_selected(hs, run), place)


def _is_long(line: Column, long: int) -> Column:
    # The length is tested first: most lines are too short for so many words.
    return (F.length(line) >= 2 * long - 1) & (F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")) >= long)


def positions(docs: DataFrame, id_col: str, text: str, run: int, long: int | None = None) -> DataFrame:
    """(_ld_id, _ld_key, n, p, at, near): a row for every selected position, and with ``long``
    one of n = 1 for every line of so many words."""
    known = docs.filter(F.col(text).isNotNull())
    split = known.select(F.col(id_col).alias("_ld_id"), F.xxhash64(text).alias("_ld_key"), lines(F.col(text)).alias("_ld_own"))
    flags = F.expr("CAST(array() AS array<boolean>)")
    if long is not None and run > 1:
        flags = F.transform("_ld_own", lambda x: _is_long(x, long))
    hashed = split.select("_ld_id", "_ld_key", _hashes(F.col("_ld_own")).alias("_ld_h"), flags.alias("_ld_long"))
    hs = F.col("_ld_h")
    none = F.slice(F.array(_place(run, F.lit(0), F.lit(0), hs)), 1, 0)
    wide = F.when(F.size(hs) >= run, _with_surroundings(hs, run)).otherwise(none)
    singles = F.filter(F.transform(hs, lambda x, k: _place(1, k, k, F.array(x))), lambda w: F.get(F.col("_ld_long"), w["p"]))
    return hashed.select("_ld_id", "_ld_key", F.inline(F.concat(wide, F.when(F.exists("_ld_long", lambda x: x), singles).otherwise(none))))


def repeated_windows(docs: DataFrame, id_col: str, text: str, run: int, long: int | None = None) -> DataFrame:
    """(_ld_id, _ld_key, _ld_starts): (start, lines) of what occurs earlier, by document."""
    found = positions(docs, id_col, text, run, long)
    placed = materialize(found.withColumn("f", F.get("near", F.col("at"))["h"]), "line-positions")
    # The small sides of the joins are written, so that AQE can split a hot value.
    shared = materialize(placed.groupBy("n", "f").count().filter("count > 1").select("n", "f"), "line-shared")
    matched = placed.join(shared, ["n", "f"], "left_semi").drop("f")
    here = F.struct("_ld_id", "_ld_key", "p")
    alike = matched.groupBy("n", "at", "near").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    alike = materialize(alike, "line-surroundings")
    # All but the first of those with equal surroundings repeat all of them.
    several = alike.filter("first <> last").select("n", "at", "near", "first")
    whole = matched.join(several, ["n", "at", "near"]).filter(here != F.col("first"))
    whole = whole.select("_ld_id", "_ld_key", (F.col("p") - F.col("at")).alias("s"), F.size("near").alias("n"))
    # Their first one repeats the windows through its fingerprint that stand earlier in others.
    part = lambda t: F.slice("near", t + 1, F.col("n"))
    through = F.filter(F.sequence(F.lit(0), F.size("near") - F.col("n")), lambda t: t + _least(part(t)) == F.col("at"))
    windows = F.transform(through, lambda t: F.struct((F.col("first.p") - F.col("at") + t).alias("s"), F.xxhash64(F.transform(part(t), lambda x: x["h"])).alias("w"), F.xxhash64(F.transform(part(t), lambda x: x["g"])).alias("v")))
    wins = alike.select("first._ld_id", "first._ld_key", "n", F.inline(windows))
    start = F.struct("_ld_id", "_ld_key", "s")
    first = wins.groupBy("n", "w", "v").agg(F.min(start).alias("first"), F.max(start).alias("last"))
    first = materialize(first.filter("first <> last").drop("last"), "line-first")
    later = wins.join(first, ["n", "w", "v"]).filter(start != F.col("first")).select("_ld_id", "_ld_key", "s", "n")
    return whole.unionByName(later).groupBy("_ld_id", "_ld_key").agg(F.sort_array(F.collect_set(F.struct("s", "n"))).alias("_ld_starts"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", run: int = 2, long: int | None = None) -> DataFrame:
    """``docs`` with later repeated runs of at least ``run`` lines, and with ``long`` also later
    copies of single lines of ``long`` words or more, removed from ``text``, and ``_ld_lines``
    and ``_ld_removed``: number of lines before, number removed."""
    starts = repeated_windows(docs, id_col, text, run, long).withColumnsRenamed({"_ld_id": "_ld_rid", "_ld_key": "_ld_rkey"})
    # The row travels in a struct, out of reach of the working columns' names.
    row = F.struct(*docs.columns).alias("_ld_row")
    keyed = docs.select(row, F.col(id_col).alias("_ld_id"), F.xxhash64(text).alias("_ld_key"), F.col(text).alias("_ld_text"))
    joined = keyed.join(starts, (F.col("_ld_key") == F.col("_ld_rkey")) & F.col("_ld_id").eqNullSafe(F.col("_ld_rid")), "left").drop("_ld_rid", "_ld_rkey", "_ld_key", "_ld_id")
    cut = joined.withColumn("_ld_all", F.when(F.col("_ld_text").isNotNull(), lines(F.col("_ld_text"))).otherwise(F.expr("CAST(array() AS array<string>)")))
    covered = F.flatten(F.transform("_ld_starts", lambda w: F.sequence(w["s"], w["s"] + w["n"] - 1)))
    cut = cut.withColumn("_ld_gone", F.sort_array(F.array_distinct(covered)))
    at, last = F.col("_ld_gone"), F.size("_ld_gone")

    def kept(k: Column) -> Column:
        """Lines between the k-th line that goes and the one before it."""
        lo = F.when(k == 0, F.lit(0)).otherwise(F.get(at, k - 1) + 1)
        hi = F.when(k == last, F.size("_ld_all")).otherwise(F.get(at, k))
        return F.slice("_ld_all", lo + 1, F.greatest(F.lit(0), hi - lo))

    rest = F.when(at.isNull(), F.col("_ld_all")).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), last), kept)))
    out = cut.withColumn("_ld_rest", rest)
    new = F.when(F.col("_ld_starts").isNull(), F.col("_ld_text")).otherwise(F.array_join("_ld_rest", "\n"))
    own = [c for c in docs.columns if c not in ("_ld_lines", "_ld_removed")]
    columns = [(new if c == text else F.col("_ld_row").getField(c)).alias(c) for c in own]
    return out.select(*columns, F.size("_ld_all").cast("long").alias("_ld_lines"), (F.size("_ld_all") - F.size("_ld_rest")).cast("long").alias("_ld_removed"))
