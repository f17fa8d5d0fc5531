"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests (native:
DataFrame functions only).

A text is cut into paragraphs (lines; a long line is cut after sentences), each paragraph is
hashed to a 62-bit digest, and every digest is added to one cell in each of three
subtables. A cell holds a count and sums of the digest's halves and of a check value, so two
sketches subtract cell by cell: what both texts have cancels. The difference is peeled: a
cell whose sums are a multiple of one digest, by its check value and its place, gives that
digest and how often it differs, which is then taken from its other cells, and so on until
all cells are empty. If peeling gets stuck the pair is tried again with a larger sketch: the
digests are dealt to several tables by another hash, by their number, and only the tables that
fail again are dealt further. The number of differing paragraphs is exact.

Likeness of two fingerprints: 1 - differing / all paragraphs of both (1 if both are empty).

Everything about a pair happens in its row, so the only shuffle is the one that brings the
next document to each document: rows are dealt to ranges of the id, and the first row of each
range is copied to the end of the range before it.

Defined results: a null text is empty and has the fingerprint of no paragraphs; a null id
comes after all others; rows of one id follow each other in order of their text's hash; a
lone document is its own next; an empty table gives an empty result. Only the named columns
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a subtable; there are three.
WIDTH = 16
#: Digests by table that a failed one is dealt to, the most tables at once, and how often.
DEALT = 24
MOST_TABLES = 64
LEVELS = 16
#: A line is cut at the first end of a sentence after so many characters.
PARAGRAPH = 120
#: Documents by range of ids; at most so many ranges.
RANGE_DOCS = 2_000
MAX_RANGES = 4_096

_HALF = 2**31 - 1
_CELL = "struct<n:bigint,hi:bigint,lo:bigint,chk:bigint>"


def paragraphs(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[^\n]{{{PARAGRAPH},}}?[.!?](?=[\x20\x09-\x0D]|$)|[^\n]+"), F.lit(0))


def digests(text: Column) -> Column:
    """62-bit digests of the paragraphs, in order."""
    return F.transform(paragraphs(text), lambda p: F.xxhash64(p).bitwiseAND(F.lit(2**62 - 1)))


def _hi(d: Column) -> Column:
    return F.shiftright(d, 31)


def _lo(d: Column) -> Column:
    return d.bitwiseAND(F.lit(_HALF))


def _check(d: Column) -> Column:
    return F.xxhash64(d, F.lit("check")).bitwiseAND(F.lit(_HALF))


def _cells(d: Column, salt: Column) -> Column:
    """Numbers of the three cells of a digest."""
    return F.array(*[F.pmod(F.xxhash64(d, salt, F.lit(t)), F.lit(WIDTH)).cast("int") + t * WIDTH for t in range(3)])


def _cell(n: Column, hi: Column, lo: Column, chk: Column) -> Column:
    return F.struct(n.alias("n"), hi.alias("hi"), lo.alias("lo"), chk.alias("chk"))


def _item(n: Column, d: Column, salt: Column) -> Column:
    """A digest, n times, with what it adds to its cells."""
    return F.struct(_cells(d, salt).alias("at"), n.alias("n"), (n * _hi(d)).alias("hi"), (n * _lo(d)).alias("lo"), (n * _check(d)).alias("chk"))


def _combine(c: Column, e: Column, sign: int) -> Column:
    return _cell(c["n"] + sign * e["n"], c["hi"] + sign * e["hi"], c["lo"] + sign * e["lo"], c["chk"] + sign * e["chk"])


def _all_cells() -> Column:
    return F.sequence(F.lit(0), F.lit(3 * WIDTH - 1))


def sketch(ds: Column, salt: Column) -> Column:
    """Cells of the digests ``ds``."""
    items = F.transform(ds, lambda d: _item(F.lit(1).cast("bigint"), d, salt))
    zero = _cell(*[F.lit(0).cast("bigint")] * 4)
    # The items are an array of one array, so that they are made once and not per cell.
    return F.flatten(
        F.transform(
            F.array(items),
            lambda own: F.transform(
                _all_cells(),
                lambda j: F.aggregate(own, zero, lambda c, e: F.when(F.array_contains(e["at"], j), _combine(c, e, 1)).otherwise(c)),
            ),
        )
    )


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _combine(x, y, -1))


def peel(cells: Column, salt: Column) -> Column:
    """(cells left, d, stuck): d is the number of digests recovered."""

    def pure(c: Column, j: Column) -> Column:
        """The item that alone fills a cell, or null."""
        n, unit = c["n"], F.abs(c["n"]) == 1
        # Mostly one digest, once: no division then.
        half = lambda x: F.when(unit, x * n).otherwise(F.when(x % n == 0, F.floor(x / n).cast("bigint")))
        d = F.shiftleft(half(c["hi"]), 31) + half(c["lo"])
        checked = F.element_at(F.transform(F.array(d), lambda d: F.when((c["chk"] == n * _check(d)) & F.array_contains(_cells(d, salt), j), _item(n, d, salt))), 1)
        return F.when(n == 0, None).when(F.signum(c["hi"]) * F.signum(n) < 0, None).otherwise(checked)

    def round_(state: Column) -> Column:
        found = F.array_distinct(F.filter(F.transform(state["cells"], pure), lambda e: e.isNotNull()))

        def take(found: Column) -> Column:
            left = F.transform(state["cells"], lambda c, j: F.aggregate(F.filter(found, lambda e: F.array_contains(e["at"], j)), c, lambda x, e: _combine(x, e, -1)))
            gained = F.aggregate(found, F.lit(0).cast("bigint"), lambda s, e: s + F.abs(e["n"]))
            return F.struct(left.alias("cells"), (state["d"] + gained).alias("d"), (F.size(found) == 0).alias("stuck"))

        return F.when(state["stuck"], state).otherwise(F.element_at(F.transform(F.array(found), take), 1))

    start = F.struct(cells.alias("cells"), F.lit(0).cast("bigint").alias("d"), F.lit(False).alias("stuck"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(3 * WIDTH)), start, lambda s, _: round_(s))


def empty(cells: Column) -> Column:
    return F.forall(cells, lambda c: (c["n"] == 0) & (c["hi"] == 0) & (c["lo"] == 0) & (c["chk"] == 0))


def _retry(a: Column, b: Column) -> Column:
    """Number of digests in which ``a`` and ``b`` differ, by ever larger sketches."""
    group = lambda x, y: F.struct(x.alias("a"), y.alias("b"))

    def deal(g: Column, level: Column) -> Column:
        # More tables than there are digests by DEALT at every further level.
        n = F.greatest(F.lit(2), F.least(F.lit(MOST_TABLES), F.ceil((F.size(g["a"]) + F.size(g["b"])) / F.lit(DEALT)).cast("int") + level - 1))
        part = lambda ds, k: F.filter(ds, lambda d: F.pmod(F.xxhash64(d, level, F.lit("deal")), n) == k)
        tables = F.transform(F.sequence(F.lit(0), n - 1), lambda k: group(part(g["a"], k), part(g["b"], k)))
        return F.filter(tables, lambda t: F.size(t["a"]) + F.size(t["b"]) > 0)

    def step(state: Column, level: Column) -> Column:
        dealt = F.flatten(F.transform(state["failed"], lambda g: deal(g, level)))
        tried = F.transform(dealt, lambda g: F.struct(g.alias("g"), peel(subtract(sketch(g["a"], level), sketch(g["b"], level)), level).alias("r")))

        def sum_up(tried: Column) -> Column:
            gained = F.aggregate(tried, F.lit(0).cast("bigint"), lambda s, t: s + F.when(empty(t["r"]["cells"]), t["r"]["d"]).otherwise(0))
            failed = F.transform(F.filter(tried, lambda t: ~empty(t["r"]["cells"])), lambda t: t["g"])
            return F.struct(failed.alias("failed"), (state["d"] + gained).alias("d"))

        return F.when(F.size(state["failed"]) == 0, state).otherwise(F.element_at(F.transform(F.array(tried), sum_up), 1))

    start = F.struct(F.array(group(a, b)).alias("failed"), F.lit(0).cast("bigint").alias("d"))
    # What no table can tell apart after all levels counts as different.
    rest = lambda s: s["d"] + F.aggregate(s["failed"], F.lit(0).cast("bigint"), lambda n, g: n + F.size(g["a"]) + F.size(g["b"]))
    return F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), start, step, rest)


def text_of(cells: Column) -> Column:
    """A sketch as a string: count, sums and check sum of each cell in hexadecimal."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(":", F.hex(c["n"]), F.hex(c["hi"]), F.hex(c["lo"]), F.hex(c["chk"]))), ",")


def _base_salt() -> Column:
    return F.lit(0)


def with_likeness(df: DataFrame, name: str, a: str, b: str, sketch_a: str, sketch_b: str) -> DataFrame:
    """``df`` with the likeness ``name`` of the texts whose digests are ``a`` and ``b``."""
    first = df.withColumn("_sk_r", peel(subtract(F.col(sketch_a), F.col(sketch_b)), _base_salt()))
    d = first.withColumn("_sk_d", F.when(empty(F.col("_sk_r.cells")), F.col("_sk_r.d")).otherwise(_retry(F.col(a), F.col(b))))
    both = F.size(a) + F.size(b)
    return d.withColumn(name, F.when(both == 0, 1.0).otherwise(1 - F.col("_sk_d") / both)).drop("_sk_r", "_sk_d")


# --- each document and its next --------------------------------------------------------


def _range_of(id_: Column, bounds: list[int]) -> Column:
    """Number of bounds up to the id, by bisection."""
    steps = max(1, len(bounds).bit_length())
    full = F.array(*[F.lit(b).cast("bigint") for b in bounds + [2**63 - 1] * ((1 << steps) - len(bounds))])
    found = F.aggregate(
        F.array(*[F.lit(1 << k) for k in reversed(range(steps))]),
        F.lit(0),
        lambda at, s: F.when(F.element_at(full, (at + s).cast("int")) <= id_, at + s).otherwise(at),
    )
    return F.when(id_.isNull(), 0).otherwise(found)


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, ds, next_text, next_ds): each row with the row that follows it in descending
    order of the id; after the last comes the first."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = rows.count()
    cuts = min(MAX_RANGES, -(-n // RANGE_DOCS)) - 1
    bounds: list[int] = []
    if cuts > 0:
        points = F.array(*[F.lit((k + 1) / (cuts + 1)) for k in range(cuts)])
        bounds = sorted(set(rows.agg(F.percentile_approx("id", points, 20_000).alias("b")).first()["b"] or []))
    placed = rows.withColumn("range", _range_of(F.col("id"), bounds))
    # At most MAX_RANGES rows: the first id of each range, in descending order.
    heads = sorted((r["range"], r["head"]) for r in placed.groupBy("range").agg(F.max("id").alias("head")).collect())
    if not heads:
        return rows.select("id", "text", digests(F.col("text")).alias("ds"), F.col("text").alias("next_text"), digests(F.col("text")).alias("next_ds"))
    before = {r: heads[(k + 1) % len(heads)][0] for k, (r, _) in enumerate(heads)}
    own = {r: head for r, head in heads}
    size = heads[-1][0] + 1
    head_of = F.array(*[F.lit(own.get(r)).cast("bigint") for r in range(size)])
    before_of = F.array(*[F.lit(before.get(r, 0)) for r in range(size)])
    is_head = F.get(head_of, F.col("range")).eqNullSafe(F.col("id"))
    at = lambda r, guest: F.struct(r.alias("range"), F.lit(guest).alias("guest"))
    places = F.when(is_head, F.array(at(F.col("range"), 0), at(F.get(before_of, F.col("range")), 1))).otherwise(F.array(at(F.col("range"), 0)))
    dealt = placed.select("id", "text", F.inline(places)).repartition("range")
    keyed = dealt.select("range", "guest", "id", "text", F.xxhash64("text").alias("key"), digests(F.col("text")).alias("ds"))
    w = Window.partitionBy("range").orderBy("guest", F.col("id").desc_nulls_last(), "key")
    return keyed.select("guest", "id", "text", "ds", F.lead("text").over(w).alias("next_text"), F.lead("ds").over(w).alias("next_ds")).filter("guest = 0").drop("guest")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_chars, the edited text and its digest, both fingerprints,
    and the likeness to the edited text and to the next document."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = with_next(docs, id_col, text).select("id", "text", "ds", "next_text", "next_ds", n.alias("n"), half.alias("half"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - F.col("half")), F.substring("next_text", F.lit(1), F.col("half")))
    texts = pairs.select("id", "n", "ds", "next_ds", edited.alias("edited"))
    listed = texts.select("id", "n", "ds", "next_ds", "edited", digests(F.col("edited")).alias("edited_ds"))
    made = listed.select("*", *(sketch(F.col(c), _base_salt()).alias(f"{c}_sketch") for c in ("ds", "edited_ds", "next_ds")))
    near = with_likeness(made, "near_edited", "ds", "edited_ds", "ds_sketch", "edited_ds_sketch")
    near = with_likeness(near, "near_next", "ds", "next_ds", "ds_sketch", "next_ds_sketch")
    return near.select("id", F.col("n").cast("long").alias("n_chars"), "edited", text_of(F.col("ds_sketch")).alias("fingerprint"), text_of(F.col("edited_ds_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")
