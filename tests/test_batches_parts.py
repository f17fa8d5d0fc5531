"""Batches that resume, and ordered JSON lines in parts."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from prefpairs.operators.pairs import flatten_pairs, generate_pairs
from prefpairs.plans import batches
from prefpairs.schema import PairConfig
from prefpairs.sources.readers import read_pairs_jsonl
from prefpairs.sources.sinks import write_jsonl_ordered
from prefpairs.sources.synthetic import synthetic_entries


def rows(df):
    return sorted(map(tuple, flatten_pairs(df.drop("batch")).collect()), key=repr)


def test_a_killed_run_is_taken_up(spark, tmp_out, monkeypatch):
    entries, out = synthetic_entries(spark, 100), f"{tmp_out}/run"
    made = batches.pairs_from_parsed
    calls = []

    def dies(parsed, cfg):
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt
        return made(parsed, cfg)

    monkeypatch.setattr(batches, "pairs_from_parsed", dies)
    with pytest.raises(KeyboardInterrupt):
        batches.generate_in_batches(spark, entries, out, batch_size=20)
    monkeypatch.setattr(batches, "pairs_from_parsed", made)
    done = {r.batch for r in batches.ledger(spark, out).collect()}
    assert len(done) == 2
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{out}/pairs/batch=*/*.parquet") + glob.glob(f"{out}/entries/**/*.parquet", recursive=True)}
    # Pairs that were written without an entry in the ledger do not count.
    (left,) = [b.batch for b in spark.read.parquet(f"{out}/plan").orderBy("batch").collect() if b.batch not in done][:1]
    batches.read_batches(spark, out).drop("batch").write.parquet(f"{out}/pairs/batch={left}")
    assert {r.batch for r in batches.read_batches(spark, out).select("batch").distinct().collect()} == done
    got = batches.generate_in_batches(spark, entries, out, batch_size=20)
    assert got["finished"] == got["batches"] and got["written"] == got["batches"] - 2 and got["entries"] == 100
    assert rows(batches.read_batches(spark, out)) == rows(generate_pairs(entries))
    assert all(os.path.getmtime(f) == t for f, t in files.items())
    again = batches.generate_in_batches(spark, entries, out, batch_size=20)
    assert again["written"] == 0 and {**again, "written": 0} == {**got, "written": 0}
    with pytest.raises(ValueError, match="another configuration"):
        batches.generate_in_batches(spark, entries, out, PairConfig(noise_std=9.0), batch_size=20)


def test_batches_of_nothing_and_of_one_id(spark, tmp_out):
    entries = synthetic_entries(spark, 40)
    none = batches.generate_in_batches(spark, entries.filter("false"), f"{tmp_out}/none", batch_size=3)
    assert (none["batches"], none["finished"], none["entries"]) == (0, 0, 0)
    same = entries.withColumn("entry_id", F.lit(7).cast("long"))
    got = batches.generate_in_batches(spark, same, f"{tmp_out}/same", batch_size=10)
    assert (got["batches"], got["entries"]) == (1, 40)
    assert rows(batches.read_batches(spark, f"{tmp_out}/same")) == rows(generate_pairs(same))
    with pytest.raises(ValueError):
        batches.generate_in_batches(spark, entries, f"{tmp_out}/bad", batch_size=0)


@pytest.mark.parametrize("python_bytes", [False, True])
def test_parts_in_order_are_the_ordered_file(spark, tmp_out, python_bytes):
    pairs, path = generate_pairs(synthetic_entries(spark, 3000)).repartition(7), f"{tmp_out}/pairs.jsonl"
    manifest = write_jsonl_ordered(pairs, path, rows_per_part=500, python_bytes=python_bytes).collect()
    files = sorted(glob.glob(f"{path}/part=*/part-*"))
    assert len(files) == len(manifest) > 8
    want = pairs.orderBy("entry_id", "strategy_ord").collect()
    text = [open(f, encoding="utf-8").read() for f in files]
    if python_bytes:
        assert "".join(text) == "".join(json.dumps({k: r[k] for k in ("prompt", "chosen", "rejected")}) + "\n" for r in want)
    lines = [json.loads(line) for t in text for line in t.splitlines()]
    assert lines == [{k: r[k] for k in ("prompt", "chosen", "rejected")} for r in want]
    assert [m.rows for m in manifest] == [t.count("\n") for t in text] and max(m.rows for m in manifest) < 1500
    for m in manifest:
        assert (m.entry_id, m.strategy_ord) == (want[m.before].entry_id, want[m.before].strategy_ord)
    read = read_pairs_jsonl(spark, path, positions=True).orderBy("line_id").collect()
    assert [r.prompt for r in read] == [r.prompt for r in want] and [r.rejected for r in read] == [r.rejected for r in want]
    head = read_pairs_jsonl(spark, path, positions=True, head=700)
    assert sorted(r.rejected for r in head.collect()) == sorted(r.rejected for r in want[:700])


def test_parts_of_equal_keys_and_of_nothing(spark, tmp_out):
    pairs = generate_pairs(synthetic_entries(spark, 600))
    same = pairs.withColumn("entry_id", F.lit(1).cast("long")).withColumn("prompt", F.concat("prompt", F.uuid().substr(1, 4)))
    same.write.parquet(f"{tmp_out}/same-table")
    manifest = write_jsonl_ordered(spark.read.parquet(f"{tmp_out}/same-table"), f"{tmp_out}/same.jsonl", rows_per_part=100).collect()
    assert sum(m.rows for m in manifest) == 1200 and max(m.rows for m in manifest) < 400
    assert write_jsonl_ordered(pairs.filter("false"), f"{tmp_out}/none.jsonl").collect() == []


def test_many_batches_go_in_few_rounds(spark, tmp_out, monkeypatch):
    entries, out, made, calls = synthetic_entries(spark, 160), f"{tmp_out}/run", batches.pairs_from_parsed, []
    # Every fourth entry has no action, so that some batches have no pair.
    bad = F.col("entry_id") % 4 == 0
    entries = entries.withColumn("conversations", F.when(bad, F.slice("conversations", 1, 1)).otherwise(F.col("conversations")))
    spark.createDataFrame([("left over",)], "prompt string").write.parquet(f"{out}/pairs/batch=0")

    def counted(parsed, cfg):
        calls.append(1)
        return made(parsed, cfg)

    monkeypatch.setattr(batches, "pairs_from_parsed", counted)
    monkeypatch.setattr(batches, "ROUNDS", 4, raising=False)
    got = batches.generate_in_batches(spark, entries, out, batch_size=2)
    assert got["batches"] == got["finished"] == got["written"] > 40 and len(calls) <= 4
    assert (got["entries"], got["skipped_invalid"]) == (160, 40)
    assert rows(batches.read_batches(spark, out)) == rows(generate_pairs(entries))
    plan = {r.batch: r.n_entries for r in spark.read.parquet(f"{out}/plan").collect()}
    assert {r.batch: r.n_entries for r in batches.ledger(spark, out).collect()} == plan


def test_batches_without_a_pair(spark, tmp_out):
    entries = synthetic_entries(spark, 6).withColumn("conversations", F.slice("conversations", 1, 1))
    got = batches.generate_in_batches(spark, entries, tmp_out, batch_size=3)
    assert got["finished"] == got["batches"] and (got["entries"], got["skipped_invalid"]) == (6, 6)
    assert batches.read_batches(spark, tmp_out).collect() == []


def test_parts_do_not_make_tasks(spark, tmp_out, monkeypatch):
    asked, range_by = [], type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda df, n, *keys: asked.append(n) or range_by(df, n, *keys))
    pairs, path = generate_pairs(synthetic_entries(spark, 200)), f"{tmp_out}/pairs.jsonl"
    manifest = write_jsonl_ordered(pairs, path, rows_per_part=3).collect()
    assert max(asked) <= spark.sparkContext.defaultParallelism < len(manifest) / 10
    files = sorted(glob.glob(f"{path}/part=*/part-*"))
    assert len(files) == len(manifest) and [f"part={m.part}" for m in manifest] == [f.split("/")[-2] for f in files]
    sizes = [open(f, encoding="utf-8").read().count("\n") for f in files]
    assert [m.rows for m in manifest] == sizes and max(sizes) == 3 and sum(sizes) == 400
    assert [m.before for m in manifest] == [sum(sizes[:i]) for i in range(len(sizes))]
    want = pairs.orderBy("entry_id", "strategy_ord").collect()
    assert [(m.entry_id, m.strategy_ord) for m in manifest] == [(want[m.before].entry_id, want[m.before].strategy_ord) for m in manifest]
    read = read_pairs_jsonl(spark, path, positions=True).orderBy("line_id").collect()
    assert [r.rejected for r in read] == [r.rejected for r in want]
