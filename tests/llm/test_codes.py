"""Vector codes: the search against all entries, the operator against plain Python, odd rows."""

import collections
import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from prefpairs.llm import codes, queries
from prefpairs.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """[(id, vector, label)] -> {(id, label, code, error): times}, codebooks."""
    kept = [(i, [math.floor(256 * x) for x in v], y, v) for i, v, y in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[3]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: tuple(v[p * width : (p + 1) * width])
    books = [[cut(v, p) for _, v, _, _ in kept[:entries]] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, book: min((apart(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = collections.defaultdict(list)
            for _, v, _, _ in kept:
                own[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            for k, members in own.items():
                books[p][k] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    out = collections.Counter()
    for i, v, y, _ in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out[i, y, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)] += 1
    return out, books


def test_search_is_exact():
    rng = np.random.default_rng(5)
    for width, spread, n in itertools.product((1, 2, 4, 9), (2, 60, 2**27), (1, 2, 64)):
        entries = rng.integers(-spread, spread, (n, width))
        entries[n // 2] = entries[0]  # equal entries: the lower index is nearest
        x = np.concatenate([rng.integers(-spread, spread, (500, width)), entries])
        d = ((x[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        index, best = codes.Orchard.plant(entries).search(x)
        assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_search_prunes():
    """Distances are measured to a part of the entries only."""
    rng = np.random.default_rng(6)
    entries, x = rng.integers(-60, 60, (64, 4)), rng.integers(-60, 60, (2000, 4))
    orchard = codes.Orchard.plant(entries)
    measured = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                measured.append(len(key))
            return np.asarray(self)[key]

    codes.Orchard(orchard.entries.view(Counted), orchard.order, orchard.apart, orchard.start).search(x)
    assert sum(measured) < 0.7 * len(x) * 63


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF001, "embeddings").select("vec_id", "embedding", "label").collect()]
    want, books = brute(rows)
    flat = ",".join(str(c) for book in books for entry in book for c in entry)
    by_label = collections.Counter()
    for (_, y, _, error), n in want.items():
        by_label[y] += n * error
    out = queries.op11_vector_codes(spark, SF001).collect()
    label_of = {r[0]: r[2] for r in rows}
    assert collections.Counter((r.vec_id, label_of[r.vec_id], r.code, r.error) for r in out) == want
    assert all(r.label_error == by_label[label_of[r.vec_id]] for r in out)
    assert {r.codebooks_sha256 for r in out} == {hashlib.sha256(flat.encode()).hexdigest()}


def odd_rows():
    rng = np.random.default_rng(7)
    v = lambda: [float(np.float32(x)) for x in rng.normal(0, 0.3, 32)]
    same = v()
    rows = [(k, v(), k % 3) for k in range(90)]
    rows += [(200, same, None), (200, same, None), (201, same, 1), (None, v(), 2), (None, None, None), (5, v(), 0)]
    rows += [(210, None, 1), (211, [], 1), (212, [None, *same[1:]], 1), (213, [math.nan, *same[1:]], 1), (214, [*same[:-1], -math.inf], 1)]
    return rows + [(220, [0.0] * 32, None), (221, [-0.5] * 32, 4)]


def test_odd_rows(spark):
    rows = odd_rows()
    want, books = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    names = ["id", "code", "error", "label_error", "slot", "n", "sums", "s0", "_vc_id", "_vc_v", "_vc_label"]
    for d in (df, df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])):
        out, found = codes.vector_codes(d)
        got = out.collect()
        assert collections.Counter((r.id, r.label, r.code, r.error) for r in got) == want
        assert found.tolist() == [[list(e) for e in book] for book in books]
        sums = collections.Counter()
        for (_, y, _, error), n in want.items():
            sums[y] += n * error
        assert all(r.label_error == sums[r.label] for r in got)


def test_few_and_no_rows(spark):
    few = odd_rows()[:3]
    out, books = codes.vector_codes(spark.createDataFrame(few, SCHEMA))
    assert books.shape == (16, 3, 2) and all(r.error == 0 for r in out.collect())
    for rows in ([], [(1, None, 1)]):
        out, books = codes.vector_codes(spark.createDataFrame(rows, SCHEMA))
        assert books is None and out.collect() == [] and out.columns == ["id", "label", "code", "error", "label_error"]


def test_large_components_are_held_at_the_bound():
    kept, values = codes.integers(pa.array([[1e30] * 64, [-1e30] * 64, [0.25] * 64], pa.list_(pa.float64())))
    assert kept.tolist() == [0, 1, 2]
    far = ((values[0] - values[1]) ** 2).sum()
    assert 2**61 < far <= 2**62 and values[2].tolist() == [64] * 64


def test_unequal_lengths_are_an_error():
    with pytest.raises(ValueError, match="different lengths"):
        codes.integers(pa.array([[1.0] * 16, [1.0] * 32], pa.list_(pa.float64())))
    with pytest.raises(ValueError, match="equal parts"):
        codes.integers(pa.array([[1.0] * 17], pa.list_(pa.float64())))
