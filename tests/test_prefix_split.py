"""Exact distributed prefix selection and train/eval splits."""

import random

import pytest
from pyspark.sql import functions as F

from prefpairs.operators.prefix import first_n, kth_smallest
from prefpairs.operators.training import dpo_projection, max_samples, sft_text, split_exact, train_eval_split


@pytest.mark.parametrize("n", [1, 7, 500, 1999, 2000, 5000])
def test_first_n_matches_sort_limit(spark, n):
    rnd = random.Random(n)
    rows = [(rnd.randint(-10**15, 10**15), rnd.randint(0, 3), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a long, b long, c long")  # (a, b, c) unique via c
    got = sorted(map(tuple, first_n(df, ["a", "b", "c"], n).collect()))
    want = sorted(map(tuple, df.orderBy("a", "b", "c").limit(n).collect()))
    assert got == want


def test_first_n_heavy_ties(spark):
    # one head value holds a third of the rows: resolved by the next column
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a long, b long")
    for n in (1, 500, 1000, 1001, 2999):
        got = sorted(map(tuple, first_n(df, ["a", "b"], n).collect()))
        want = sorted(map(tuple, df.orderBy("a", "b").limit(n).collect()))
        assert got == want, n


def test_kth_extremes(spark):
    df = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,)], "k long")
    assert kth_smallest(df, "k", 1).value == -(2**63)
    assert kth_smallest(df, "k", 2).value == 0
    assert kth_smallest(df, "k", 3).value == 2**63 - 1
    assert kth_smallest(df, "k", 4) is None
    assert kth_smallest(df.filter("k > 5"), "k", 1).below == 0


def _pairs(spark, n=3000):
    return spark.range(n).select(
        F.floor(F.col("id") / 2).alias("entry_id"), (F.col("id") % 2).alias("strategy_ord"),
        F.concat(F.lit("p"), F.col("id")).alias("prompt"), F.lit("CLICK: (1, 2)").alias("chosen"),
        F.lit("COMPLETE").alias("rejected"))


def test_max_samples(spark):
    p = _pairs(spark)
    got = sorted((r.entry_id, r.strategy_ord) for r in max_samples(p, 1001).collect())
    assert got == [(i // 2, i % 2) for i in range(1001)]
    assert max_samples(p, None).count() == 3000


def test_split_hash_is_repeatable_and_keeps_entries_together(spark):
    p = _pairs(spark)
    s1 = {(r.entry_id, r.strategy_ord): r.split for r in train_eval_split(p).collect()}
    s2 = {(r.entry_id, r.strategy_ord): r.split for r in train_eval_split(p.repartition(5)).collect()}
    assert s1 == s2 and set(s1.values()) == {"train", "eval"}
    assert all(s1[(e, 0)] == s1[(e, 1)] for e in range(1500))       # entry key: no leak
    frac = sum(v == "train" for v in s1.values()) / len(s1)
    assert 0.85 < frac < 0.95
    per_pair = {(r.entry_id, r.strategy_ord): r.split for r in train_eval_split(p, key="pair").collect()}
    assert any(per_pair[(e, 0)] != per_pair[(e, 1)] for e in range(1500))


def test_split_exact_sizes(spark):
    p = _pairs(spark)
    for n_eval in (0, 1, 301, 3000):
        s = split_exact(p, n_eval)
        counts = {r.split: r.n for r in s.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert counts.get("eval", 0) == n_eval and counts.get("train", 0) == 3000 - n_eval


def test_sft_and_dpo(spark):
    p = _pairs(spark, 4)
    assert [r.text for r in sft_text(p).collect()][0] == "p0CLICK: (1, 2)<|end_of_turn|>"
    assert dpo_projection(p).columns == ["prompt", "chosen", "rejected"]
    dup = p.withColumn("prompt", F.lit("same"))
    assert sft_text(dup, drop_duplicates=True).count() == 1


def test_first_n_many_rounds(spark):
    """Many rounds of few buckets, compared with sort + limit."""
    import prefpairs.operators.prefix as P

    rnd = random.Random(3)
    rows = [(rnd.choice([5, 6, rnd.randint(-10**12, 10**12)]), rnd.randint(0, 9), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    for n in (1, 1000, 2999):
        got = sorted(map(tuple, P.first_n(df, ["a", "b", "c"], n, buckets=16).collect()))
        want = sorted(map(tuple, df.orderBy("a", "b", "c").limit(n).collect()))
        assert got == want, n


def test_first_n_rejects_ambiguous_keys(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (2, 0), (3, 0)], "a long, b long")
    assert sorted(r.a for r in first_n(df, ["a"], 1).collect()) == [1]
    assert sorted(r.a for r in first_n(df, ["a"], 3).collect()) == [1, 2, 2]
    with pytest.raises(ValueError, match="not unique"):
        first_n(df, ["a"], 2)
    with pytest.raises(ValueError, match="not unique"):
        first_n(df, ["a", "b"], 2)


def test_eval_count_matches_library_rule():
    from prefpairs.operators.training import eval_count

    assert [eval_count(n) for n in (10, 20, 16668, 0)] == [1, 2, 1667, 0]
    assert eval_count(100, 0.75) == 25


@pytest.mark.parametrize("n", [1, 37, 2999, 3000, 3001])
def test_first_n_with_bounds(spark, n):
    from prefpairs.operators.prefix import first_n_predicate

    rnd = random.Random(n)
    rows = [(rnd.randint(0, 2**48 - 1), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = sorted(map(tuple, df.filter(first_n_predicate(df, ["a", "b"], n, head_bounds=(0, 2**48 - 1))).collect()))
    want = sorted(map(tuple, df.orderBy("a", "b").limit(n).collect()))
    assert got == want
    single = spark.createDataFrame([(5, i) for i in range(4)], "a long, b long")
    assert single.filter(first_n_predicate(single, ["a", "b"], 2, head_bounds=(5, 5))).count() == 2


def test_first_n_with_bounds_many_rounds(spark):
    import prefpairs.operators.prefix as P

    rnd = random.Random(5)
    rows = [(rnd.choice([7, rnd.randint(0, 2**48 - 1)]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a long, b long")
    for n in (1, 700, 1999, 2000):
        got = sorted(map(tuple, df.filter(P.first_n_predicate(df, ["a", "b"], n, buckets=8, head_bounds=(0, 2**48 - 1))).collect()))
        want = sorted(map(tuple, df.orderBy("a", "b").limit(n).collect()))
        assert got == want, n


def test_first_n_keeps_rows_without_a_key(spark):
    """NULL keys come last, and none of their rows is lost."""
    rows = [(None if i % 4 == 0 else i, None if i % 10 == 0 else i, i) for i in range(200)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    nulls_last = [F.col(c).asc_nulls_last() for c in "abc"]
    for n in (1, 149, 150, 151, 185, 199, 200, 500):
        got = sorted(r.c for r in first_n(df, ["a", "b", "c"], n).collect())
        assert got == sorted(r.c for r in df.orderBy(*nulls_last).limit(n).collect()), n
    assert first_n(df, ["a"], 500).count() == 200 and first_n(df, ["a"], 150).count() == 150
    with pytest.raises(ValueError, match="not unique"):
        first_n(df, ["a"], 160)


def test_first_n_sends_only_counts_to_the_driver(spark, monkeypatch):
    """The same rounds at every size: what the driver sorts are histograms, never keys."""
    import prefpairs.operators.prefix as P

    rounds = []

    def seen(rows):
        rounds.append(sorted(rows))
        return rounds[-1]

    monkeypatch.setattr(P, "sorted", seen, raising=False)
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    predicate = P.first_n_predicate(df, ["k"], 1234, buckets=64)
    assert len(rounds) >= 2 and all(len(r) <= 64 for r in rounds)
    assert sum(n for _, n in rounds[0]) == 5000
    assert df.filter(predicate).count() == 1234


def test_duplicates_keep_their_first_row(spark):
    """The same rows stay, and land on the same side, however the pairs are partitioned."""
    p = _pairs(spark, 900).withColumn("prompt", F.concat(F.lit("p"), (F.col("entry_id") % 250).cast("string")))
    order = ("entry_id", "strategy_ord")
    seen = set()
    for part in (p.coalesce(1), p.repartition(7), p.repartition(5, "strategy_ord")):
        rows = sft_text(part, order, drop_duplicates=True, order=order)
        out = split_exact(rows, 60, key="text", tiebreak=order).collect()
        assert len(out) == rows.select("text").distinct().count() and sum(r.split == "eval" for r in out) == 60
        seen.add(frozenset(tuple(r) for r in out))
    assert len(seen) == 1
    first = {}
    for r in sft_text(p, order).collect():
        first[r.text] = min(first.get(r.text, (10**9, 0)), (r.entry_id, r.strategy_ord))
    assert {(r[2], (r[0], r[1])) for r in next(iter(seen))} == set(first.items())
