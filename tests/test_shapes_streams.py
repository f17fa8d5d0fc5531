"""Noise shapes and the streaming training sets and counters."""

import collections
import math
import os

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from prefpairs.functions.noise import SHAPES, with_perturbed
from prefpairs.operators.pairs import flatten_pairs, generate_pairs, generation_stats
from prefpairs.operators.training import sft_text, train_eval_split
from prefpairs.schema import PairConfig
from prefpairs.sources.adapters import events_to_entries
from prefpairs.sources.sinks import write_jsonl
from prefpairs.streaming.prepare_stream import read_prepared, run_counts_stream, run_prepare_stream, total_counts


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_shapes(spark, shape):
    """Deviation, reach and independence of partitioning of each shape."""
    points = spark.range(40_000).select(F.col("id").alias("k"), F.lit(50_000).alias("x"), F.lit(50_000).alias("y"))
    moved = lambda df: with_perturbed(df, "x", "y", "k", 42, 50.0, 100_000.0, 100_000.0, "nx", "ny", shape=shape)
    rows = [(r.nx - 50_000, r.ny - 50_000) for r in moved(points).orderBy("k").collect()]
    sd = {"truncated": 50 * math.sqrt(1 - 2 * math.exp(-2) / (1 - math.exp(-2)))}.get(shape, 50.0)
    for axis in (0, 1):
        values = [r[axis] for r in rows]
        mean = sum(values) / len(values)
        assert abs(mean) < 1.5
        assert abs(math.sqrt(sum((v - mean) ** 2 for v in values) / len(values)) - sd) < 0.03 * sd
    assert abs(sum(x * y for x, y in rows) / len(rows)) < 0.03 * sd * sd
    reach = max(math.hypot(*r) for r in rows)
    assert reach <= 101 if shape in ("disc", "truncated") else reach > 180
    if shape == "disc":  # half of the area lies within radius / sqrt(2)
        assert abs(sum(math.hypot(*r) < 100 / math.sqrt(2) for r in rows) / len(rows) - 0.5) < 0.01
    assert sorted(map(tuple, moved(points.repartition(7)).select("k", "nx", "ny").collect()))[:500] == [(k, x + 50_000, y + 50_000) for k, (x, y) in enumerate(rows[:500])]


def test_unknown_shape(spark):
    with pytest.raises(ValueError, match="unknown noise shape"):
        generate_pairs(events_to_entries(spark.read.parquet(f"{SF001}/events.parquet")), PairConfig(noise_shape="square"))


def _rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def pairs(spark):
    return flatten_pairs(generate_pairs(events_to_entries(spark.read.parquet(f"{SF001}/events.parquet")))).select("entry_id", "strategy_ord", "prompt", "chosen", "rejected")


def test_prepare_stream_restarts_and_replays(spark, tmp_out, pairs):
    """Files that come later are added, nothing twice; a batch that is run again after its
    commit was lost writes its folder anew."""
    folder, out = os.path.join(tmp_out, "in"), os.path.join(tmp_out, "out")
    want = _rows(train_eval_split(sft_text(pairs, ("entry_id", "strategy_ord"))))
    columns = ("entry_id", "strategy_ord", "text", "split")
    for part in (F.col("entry_id") % 2 == 0, F.col("entry_id") % 2 == 1):
        pairs.filter(part).repartition(3).write.mode("append").parquet(folder)
        run_prepare_stream(spark, folder, out, max_files_per_trigger=2)
    assert len([d for d in os.listdir(out) if d.startswith("batch_id=")]) == 4
    assert _rows(read_prepared(spark, out).select(*columns)) == want
    commits = os.path.join(out + "-checkpoint", "commits")
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for f in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))
    run_prepare_stream(spark, folder, out, max_files_per_trigger=2)
    assert _rows(read_prepared(spark, out).select(*columns)) == want


def test_prepare_stream_of_lines(spark, tmp_out, pairs):
    path = write_jsonl(pairs, os.path.join(tmp_out, "p.jsonl"))
    out = run_prepare_stream(spark, path, os.path.join(tmp_out, "out"), "dpo", fmt="jsonl")
    want = train_eval_split(pairs.select("prompt", "chosen", "rejected"), key="content")
    assert _rows(read_prepared(spark, out).select("prompt", "chosen", "rejected", "split")) == _rows(want)
    with open(os.path.join(path, "part-broken.json"), "w") as f:
        f.write('{"prompt": 1}\n')
    with pytest.raises(Exception, match="line is no pair"):
        run_prepare_stream(spark, path, os.path.join(tmp_out, "out"), "dpo", fmt="jsonl")


def test_counts_stream(spark, tmp_out):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    folder, out = os.path.join(tmp_out, "in"), os.path.join(tmp_out, "out")
    for k in range(3):
        events.filter(F.col("event_id") % 3 == k).repartition(2).write.mode("append").parquet(folder)
        run_counts_stream(spark, folder, out, events_to_entries, max_files_per_trigger=1)
        seen = events.filter(F.col("event_id") % 3 <= k)
        assert total_counts(spark, out).collect() == generation_stats(events_to_entries(seen)).collect()
