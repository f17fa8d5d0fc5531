"""The pipeline's stages against plain Python."""

import collections
import math

import corpus_pipeline
import pyarrow.parquet as pq
import sentencepiece
from conftest import SF001
from llm import brute
from pyspark.sql import functions as F

from prefpairs.llm import mixing
from prefpairs.llm.common import table


def _quality(rows):
    measured = [(r, brute.metrics(r[1])[-1]) for r in rows]
    n, failed = collections.Counter(), collections.Counter()
    for r, f in measured:
        if r[3] is not None:
            n[r[3]] += 1
            failed[r[3]] += f
    total = sum(n.values())
    mean = sum(failed.values()) / total
    var = max(sum(failed[h] ** 2 / n[h] for h in n) / total - mean**2 - mean * (1 - mean) * len(n) / total, 1e-6)
    weight = max(mean * (1 - mean) / var - 1, 1e-6)
    bad = {h for h in n if (failed[h] + mean * weight) / (n[h] + weight) > 0.6}
    return [r for r, f in measured if not f and r[3] not in bad]


def _lines(rows):
    kept = brute.line_dedup([(r[0], r[1]) for r in rows], long=50)
    out = []
    for i, text, lang, source, n in rows:
        new, lines, removed = kept[i, text]
        if removed < lines or not removed:
            out.append((i, new, lang, source, len(new) if removed else n))
    return out


def _near(rows):
    roots = brute.components([brute.simhash(r[1]) for r in rows])
    first = {}
    for r, root in zip(rows, roots, strict=True):
        first[root] = min(first.get(root, r[0]), r[0])
    return [r for r, root in zip(rows, roots, strict=True) if first[root] == r[0]]


def _mix(spark, rows):
    size = {r[0]: len(brute.words(r[1])) for r in rows}
    own = collections.defaultdict(list)
    for r in rows:
        own[r[3]].append(r)
    names = sorted(own, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    whole = {s: sum(size[r[0]] for r in own[s]) for s in names}
    target, left, free = {}, sum(whole.values()), set(names)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * whole[s]}
        if not above:
            target.update(share)
            break
        for s in above:
            target[s] = 3.0 * whole[s]
            left -= 3 * whole[s]
        free -= above
    out = []
    for s in names:
        u = spark.range(1).select(mixing.offset_of(F.lit(s))).first()[0]
        step = target[s] / whole[s] if whole[s] else 0
        for k, r in enumerate(sorted(own[s], key=lambda r: (size[r[0]], r[0])), 1):
            out += [r] * (math.floor(k * step + u) - math.floor((k - 1) * step + u))
    return out


def test_pipeline_matches_brute_force(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF001}/documents.parquet").to_pylist()]
    docs = table(spark, SF001, "documents")
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    for (_, stage), plain in zip(corpus_pipeline.STAGES[:4], (_quality, _lines, _near, lambda r: _mix(spark, r)), strict=True):
        rows = plain(rows)
        docs = corpus_pipeline.materialize(stage(spark, docs, SF001), "test")
        assert collections.Counter(tuple(r) for r in docs.collect()) == collections.Counter(rows)
    sp = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.public_tokenizers.path("piece_bpe_32k.model"))
    want = collections.Counter((r[0], r[3], tuple(sp.encode(r[1] or ""))) for r in rows)
    out = corpus_pipeline.run(spark, SF001).collect()
    assert collections.Counter((r.doc_id, r.source, tuple(r.ids)) for r in out) == want
    assert all(r.n_tokens == len(r.ids) and r.round_trip for r in out)
