"""Operators 2, 9 and 10 against plain Python, on awkward rows, and against their SQL."""

import collections
import math

from llm import brute
import pytest
from conftest import SF001
from pyspark.sql import functions as F
from tools.compare import digest, duck

from prefpairs.llm import line_dedup, mixing, quality
from prefpairs.llm.oracle import ORACLE_SQL
from prefpairs.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF001)
    rel = duck(SF001).sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


@pytest.mark.parametrize("name", ["op2_line_dedup", "op5_fingerprints", "op9_quality_rules"])
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExternalRDD"))


def test_line_dedup_is_exact(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    want = brute.line_dedup(rows)
    got = line_dedup.line_dedup(awkward).collect()
    assert len(got) == len(rows)
    for r in got:
        in_rows = [t for i, t in rows if i == r.doc_id]
        if r.text is None:
            assert None in in_rows and (r._ld_lines, r._ld_removed) == (0, 0)
        else:
            assert (r.text, r._ld_lines, r._ld_removed) in [v for (i, _), v in want.items() if i == r.doc_id]
    by_id = {(r.doc_id, r._ld_lines): r for r in got}
    assert by_id[(5, 8)].text == "own start\nown end"  # the null id comes first and keeps the passage
    assert by_id[(11, 4)].text == "same"
    assert by_id[(14, 3)].text == "lead\n\n"


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_line_dedup_runs_of_any_length(spark, run):
    import random

    rng = random.Random(run)
    rows = [(i, "\n".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 25)))) for i in range(60)]
    want = brute.line_dedup(rows, run)
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), run=run).collect()
    assert {(r.doc_id, r.text, r._ld_removed) for r in got} == {(i, v[0], v[2]) for (i, _), v in want.items()}


@pytest.mark.parametrize("run", [2, 4])
def test_line_dedup_decides_by_its_fingerprints(spark, monkeypatch, run):
    """Fewer positions than windows are shuffled, runs are found at any offset, and positions
    that are not chosen by content miss them."""
    import random

    rng = random.Random(run)
    passage = [f"passage line {k}" for k in range(12)]
    rows = []
    for i in range(40):
        own = [f"own {i} {k}" for k in range(rng.randint(1, 9))]
        lo, n = rng.randint(0, 6), rng.randint(run, 6)
        rows.append((i, "\n".join([*own, *passage[lo : lo + n], f"end {i}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(i, v[0], v[2]) for (i, _), v in brute.line_dedup(rows, run).items()}
    result = lambda: {(r.doc_id, r.text, r._ld_removed) for r in line_dedup.line_dedup(docs, run=run).collect()}
    assert result() == want
    windows = sum(max(0, t.count("\n") + 2 - run) for _, t in rows)
    assert line_dedup.positions(docs, "doc_id", "text", run).count() < windows
    monkeypatch.setattr(line_dedup, "_selected", lambda hs, run: F.sequence(F.lit(0), F.size(hs) - run, F.lit(run)))
    assert result() != want


def test_line_dedup_of_repeated_rows_and_names(spark):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "x\na\nb"), (3, "a\nb\nc\nd"), (None, "b\nc\nq")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.line_dedup(rows)
    wide = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(["_ld_id", "_ld_key", "_ld_h", "_ld_row", "_ld_all", "_ld_lines", "n", "near", "first"])])
    out = line_dedup.line_dedup(wide)
    assert out.columns == [*[c for c in wide.columns if c != "_ld_lines"], "_ld_lines", "_ld_removed"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.text, r._ld_lines, r._ld_removed) in [v for (i, _), v in want.items() if i == r.doc_id]
        assert (r["_ld_id"], r["_ld_row"], r["_ld_all"], r["near"]) == (0, 3, 4, 7)


def test_line_dedup_of_long_single_lines(spark):
    """A long line goes where it repeats between other neighbours and as a whole document; a
    short one stays."""
    import random

    rng = random.Random(7)
    pool = [" ".join(f"p{k}w{j}" for j in range(n)) for k, n in enumerate([50, 51, 80, 49, 10, 3, 1, 1])]
    rows = [(0, pool[0]), (1, f"own one\n{pool[0]}\nown two"), (2, f" {pool[0]}\t"), (3, f"own three\n{pool[3]}"), (4, pool[3])]
    rows += [(10 + i, "\n".join(rng.choice([*pool, f"u{i}"]) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    seen, want = set(), {}
    for i, text in rows:
        keys, gone = [x.strip() for x in text.split("\n")], set()
        for s in range(len(keys)):
            for n in (1, 2):
                w = tuple(keys[s : s + n])
                if len(w) == n and (n == 2 or len(w[0].split()) >= 50):
                    gone |= set(range(s, s + n)) if w in seen else set()
                    seen.add(w)
        want[i] = ("\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone), len(gone))
    assert want[1] == ("own one\nown two", 1) and want[2] == ("", 1) and want[4] == (pool[3], 0)
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), long=50).collect()
    assert {r.doc_id: (r.text, r._ld_removed) for r in got} == want


def test_quality_measures(awkward):
    want = collections.Counter((r.doc_id, *brute.metrics(r.text)) for r in awkward.collect())
    got = quality.quality_table(awkward)
    assert collections.Counter(tuple(r) for r in got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()) == want


def test_host_verdicts_shrink_rates(spark):
    """A host that fails throughout is rejected when it is large; a small one is drawn to the
    corpus and is not. Documents of the rejected host go even if they pass the base rules."""
    good, bad = " ".join(f"word{k}" for k in range(60)), "too short"
    rows = [(i, good if i % 10 else bad, f"h{i % 8}") for i in range(400)]
    rows += [(1000 + i, good if i % 20 == 0 else bad, "spam") for i in range(200)] + [(2000, bad, "tiny"), (2001, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in quality.quality_table(docs).collect()}
    assert not out[1000].base_failed and not out[1000].kept and out[1000].host_rate > 0.6
    assert out[2001].kept and out[1].kept and not out[0].kept
    hosts = quality.host_counts(docs.select(F.col("source").alias("host"), (F.col("text") == bad).alias("base_failed")))
    v = {r.host: r for r in quality.host_verdicts(hosts).collect()}
    assert v["spam"].host_rejected and v["tiny"].rate < 1.0 and None not in v
    kept = {r.doc_id for r in quality.quality_filter(docs).collect()}
    assert kept == {i for i, r in out.items() if r.kept}


def test_mixing_targets_cap_and_reshare(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), ("d", 50), (None, 0)], "source string, size long")
    t = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # Weights 5, 2, 1, 5, 2: shared again until none is above three times its source.
    want = {"a": 30.0, "b": 300.0, "d": 150.0, None: 0.0, "c": 1160.0 - 480.0}
    assert t == pytest.approx(want)
    assert sum(t.values()) == pytest.approx(1160)


def test_mixing_targets_of_many_sources(spark, monkeypatch):
    """No window takes all sources into one task, and the targets are those of plain Python."""
    import random

    rng = random.Random(11)
    whole = {f"s{k}": int(rng.lognormvariate(3, 2)) for k in range(3000)} | {None: 70, "é": 0}
    plans, write = [], mixing.materialize
    monkeypatch.setattr(mixing, "materialize", lambda df, name: plans.append(df) or write(df, name))
    out = mixing.source_targets(spark.createDataFrame(list(whole.items()), "source string, size long"))
    got = {r.source: r.target for r in out.collect()}
    specs = [x for df in [*plans, out] for x in df._jdf.queryExecution().optimizedPlan().toString().split("windowspecdefinition(")[1:]]
    assert all(x.startswith("part#") for x in specs)
    names = sorted(whole, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    want, left, free = {}, sum(whole.values()), set(names)
    while True:
        total = sum(weight[x] for x in free)
        above = {s for s in free if left * weight[s] / total > 3 * whole[s]}
        if not above:
            break
        want |= {s: 3.0 * whole[s] for s in above}
        left -= sum(3 * whole[s] for s in above)
        free -= above
    assert got == pytest.approx(want | {s: left * weight[s] / total for s in free})


def test_mixing_takes_near_targets(spark):
    import random

    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * int(rng.lognormvariate(4, 1))), rng.choice(["a"] * 6 + ["b", "c", "d", None])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = mixing.sampled(docs).collect()
    taken = collections.defaultdict(int)
    for r in out:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for source, target in {r.source: r.target for r in out}.items():
        largest = max(r.size for r in out if r.source == source)
        assert abs(taken[source] - target) <= 3 * largest
    again = mixing.sampled(docs.repartition(11)).collect()
    assert sorted(tuple(r)[0::6] for r in out) == sorted(tuple(r)[0::6] for r in again)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out)


def test_mixing_is_systematic(awkward):
    """Copies follow from the rank by size, the step and the offset alone."""
    rows = mixing.sampled(awkward).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for source, own in by.items():
        own.sort(key=lambda r: (r["size"], r.id is not None, r.id or 0, r.key))
        u = awkward.sparkSession.range(1).select(mixing.offset_of(F.lit(source))).first()[0]
        step = min(3.0, own[0].target / own[0].source_size) if own[0].source_size else 0.0
        want = [math.floor(k * step + u) - math.floor((k - 1) * step + u) for k in range(1, len(own) + 1)]
        assert sorted(zip([r["size"] for r in own], want)) == sorted((r["size"], r.copies) for r in own)
    assert mixing.mix(awkward).count() == sum(r.copies for r in rows)
