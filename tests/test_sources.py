"""Readers, adapters, fallback resolution, row ids, sinks and streaming."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from prefpairs.operators.entries import extract_entries
from prefpairs.operators.pairs import flatten_pairs, generate_pairs, raw_prefix
from prefpairs.plans import queries as Q
from prefpairs.sources.adapters import adapt, conversations_to_entries, events_to_entries
from prefpairs.sources.readers import read_entries, resolve_entries, spread
from prefpairs.sources.sinks import peek, preview, write_pairs_table
from prefpairs.streaming.pairs_stream import run_pairs_stream


def _write_entries(path, entries):
    with open(path, "w") as f:
        for e in entries:
            f.write(json.dumps(e) + "\n")


def test_read_json_entries_and_fallback(spark, tmp_out):
    p = os.path.join(tmp_out, "data.json")
    _write_entries(p, [{"entry_id": 0, "conversations": [{"from": "human", "value": "Go"}, {"from": "gpt", "value": "CLICK: (3, 4)"}]},
                       {"entry_id": 1, "conversations": [{"value": "x"}]}])
    df, used = resolve_entries(spark, [(os.path.join(tmp_out, "missing.json"), "json"), (p, "json")])
    assert used == p
    pairs = flatten_pairs(generate_pairs(df)).collect()
    assert len(pairs) == 2 and pairs[0].chosen == "CLICK: (3, 4)"
    fb, used = resolve_entries(spark, [(os.path.join(tmp_out, "nope"), "json")])
    assert used == "synthetic:10" and fb.count() == 10


def test_json_without_ids_fails(spark, tmp_out):
    p = os.path.join(tmp_out, "noid.json")
    _write_entries(p, [{"conversations": [{"from": "a", "value": "b"}, {"from": "c", "value": "COMPLETE"}]}])
    with pytest.raises(Exception, match="entry_id"):
        read_entries(spark, p).collect()


def test_parquet_row_ids(spark, tmp_out):
    out = os.path.join(tmp_out, "pq")
    src = events_to_entries(spark.read.parquet(f"{SF001}/events.parquet")).drop("entry_id")
    src.repartition(3).write.parquet(out)
    df = read_entries(spark, out, "parquet")
    ids = [r.entry_id for r in df.select("entry_id").collect()]
    assert len(ids) == len(set(ids)) == 1000
    files = sorted(spark.read.parquet(out).inputFiles())
    assert len({i >> 40 for i in ids}) == len(files)


def test_conversations_adapter(spark):
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    e = conversations_to_entries(conv)
    rows = {r.entry_id: r for r in e.collect()}
    first = conv.filter("conv_id = 0").orderBy("turn").limit(2).collect()
    assert [m.value for m in rows[0].conversations] == [t.text for t in first]
    assert [m["from"] for m in rows[0].conversations] == [t.role for t in first]
    assert all(len(r.conversations) <= 2 for r in rows.values())
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_custom_adapter(spark):
    raw = spark.createDataFrame([(5, "Open", "COMPLETE")], "id long, q string, a string")
    ent = adapt(raw, lambda d: d.select(F.col("id").alias("entry_id"), F.array(
        F.struct(F.lit("u").alias("from"), F.col("q").alias("value")),
        F.struct(F.lit("a").alias("from"), F.col("a").alias("value"))).alias("conversations")))
    assert extract_entries(ent).first().raw_action == "COMPLETE"
    with pytest.raises(ValueError):
        adapt(raw, lambda d: d)


def test_raw_prefix_and_peek(spark):
    ev = events_to_entries(spark.read.parquet(f"{SF001}/events.parquet"))
    assert sorted(r.entry_id for r in raw_prefix(ev, 25).collect()) == list(range(25))
    pk = peek(flatten_pairs(generate_pairs(ev)).select("entry_id", "strategy_ord", "chosen"), ["entry_id", "strategy_ord"], 2).collect()
    assert len(pk) == 2 and json.loads(pk[0].json)["chosen"].startswith(("CLICK", "TYPE", "SCROLL", "LONG_PRESS", "COMPLETE", "INCOMPLETE"))


def test_pairs_table_partitioned(spark, tmp_out):
    ev = events_to_entries(spark.read.parquet(f"{SF001}/events.parquet"))
    out = write_pairs_table(generate_pairs(ev), os.path.join(tmp_out, "pairs"))
    logical = spark.read.parquet(out).filter("rejection_strategy = 'logical'")
    assert logical.count() == 851
    assert "PartitionFilters" in logical._jdf.queryExecution().executedPlan().toString()


def test_stream_equals_batch(spark, tmp_out):
    out = run_pairs_stream(spark, f"{SF001}/events.parquet", os.path.join(tmp_out, "stream"))
    streamed = sorted(map(tuple, flatten_pairs(spark.read.parquet(out)).collect()))
    batch = sorted(map(tuple, Q.q_pairs_all(spark, SF001).collect()))
    assert streamed == batch


def test_spread(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(0, 100, 1, 6)
    assert spread(many, 4) is many
    some = spark.range(0, 100, 1, 3)
    assert spread(some, 8) is some            # 3 of 8 slots: not worth a shuffle


def test_generate_and_prepare_jobs(spark, tmp_out):
    from prefpairs.plans.job import generate, prepare

    src = os.path.join(tmp_out, "data.json")
    rows = spark.read.parquet(f"{SF001}/events.parquet")
    events_to_entries(rows).coalesce(1).write.json(src)
    rep = generate(spark, [(os.path.join(tmp_out, "none.json"), "json"), (src, "json")], os.path.join(tmp_out, "run"))
    assert rep["source"] == src
    assert (rep["valid_pairs"], rep["json_errors"], rep["skipped_invalid"], rep["pairs_spatial"]) == (1702, 0, 149, 851)
    sft = prepare(spark, rep["pairs_table"], os.path.join(tmp_out, "sft"), "sft")
    assert sft["train"] + sft["eval"] == 1702
    dpo = prepare(spark, rep["pairs_table"], os.path.join(tmp_out, "dpo"), "dpo", n_eval=100, limit=1000)
    assert dpo == {"train": 900, "eval": 100}
    ex = prepare(spark, rep["pairs_table"], os.path.join(tmp_out, "dpo_exact"), "dpo", exact=True)
    assert ex == {"train": 1702 - 171, "eval": 171}
    from_jsonl = prepare(spark, os.path.join(tmp_out, "run", "pairs.jsonl"), os.path.join(tmp_out, "sft2"), "sft")
    assert from_jsonl["train"] + from_jsonl["eval"] == 1702
    sample = generate(spark, [(src, "json")], os.path.join(tmp_out, "run2"), sample_size=100)
    assert sample["valid_pairs"] <= 200


def test_custom_strategy_registry(spark):
    from prefpairs.operators.rejections import register_strategy, strategy_names
    from prefpairs.schema import PairConfig
    from prefpairs.sources.synthetic import synthetic_entries

    register_strategy("swap_axes", lambda cfg: F.when(F.col("x").isNotNull(), F.concat(F.col("action_type"), F.lit(": ("), F.col("y"), F.lit(", "), F.col("x"), F.lit(")"))).otherwise(F.col("chosen")))
    assert "swap_axes" in strategy_names()
    got = flatten_pairs(generate_pairs(synthetic_entries(spark, 1), PairConfig(strategies=("logical", "swap_axes")))).orderBy("strategy_ord").collect()
    assert [r.rejection_strategy for r in got] == ["logical", "swap_axes"]
    assert got[1].rejected == "CLICK: (400, 250)"


def test_stream_microbatches_and_restart(spark, tmp_out):
    from conftest import SF01

    src = os.path.join(tmp_out, "events_in")
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    parts = [ev.filter(F.col("event_id") % 3 == i) for i in range(3)]
    for i in (0, 1):
        parts[i].write.mode("append").parquet(src)
    out, ckpt = os.path.join(tmp_out, "pairs_out"), os.path.join(tmp_out, "ckpt")
    run_pairs_stream(spark, src, out, checkpoint=ckpt, max_files_per_trigger=1)
    parts[2].write.mode("append").parquet(src)
    run_pairs_stream(spark, src, out, checkpoint=ckpt, max_files_per_trigger=1)   # restart: new file only
    streamed = sorted(map(tuple, flatten_pairs(spark.read.parquet(out)).collect()))
    batch = sorted(map(tuple, Q.q_pairs_all(spark, SF01).collect()))
    assert streamed == batch


def test_conversations_hot_key_salted(spark):
    """One conversation owns a third of all turns across 16 input splits; the salted
    two-level reduction gives the same first two turns as a brute-force sort."""
    from conftest import SF01

    conv = spark.read.parquet(f"{SF01}/conversations.parquet")
    hot = (
        conv.withColumn("turn", F.col("turn") * 1000 + F.col("conv_id"))
        .withColumn("conv_id", F.when(F.col("conv_id") % 3 == 0, F.lit(0)).otherwise(F.col("conv_id")))
        .repartition(16)
    )
    got = {r.entry_id: [(m["from"], m.value) for m in r.conversations] for r in conversations_to_entries(hot, salt_buckets=4).collect()}
    rows = sorted(hot.collect(), key=lambda r: (r.conv_id, r.turn))
    want = {}
    for r in rows:
        want.setdefault(r.conv_id, [])
        if len(want[r.conv_id]) < 2:
            want[r.conv_id].append((r.role, r.text))
    assert got == want
    plan = conversations_to_entries(hot, salt_buckets=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4


def test_positional_ids_for_json_without_ids(spark, tmp_out):
    """Id-less JSON lines get file-ordinal << 40 | line number, exact even when a file
    is read as several splits; JSON arrays get their array position."""
    import glob

    src = os.path.join(tmp_out, "lines")
    os.makedirs(src)
    rows = events_to_entries(spark.read.parquet(f"{SF001}/events.parquet")).orderBy("entry_id").collect()
    for k in range(3):                                   # three files, blank lines inside
        with open(os.path.join(src, f"part-{k}.json"), "w") as f:
            for r in rows[k::3]:
                conv = [{"from": m["from"], "value": m.value} for m in r.conversations]
                f.write(json.dumps({"conversations": conv}) + ("\n \t\n\n" if r.entry_id % 50 == 0 else "\n"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")   # several splits per file
    try:
        got = {r.entry_id: r.conversations[0].value for r in read_entries(spark, src, "json-pos").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {}
    for ordinal, fname in enumerate(sorted(glob.glob(f"{src}/part-*.json"))):  # noqa: B007
        lines = [ln for ln in open(fname) if ln.strip()]
        for i, ln in enumerate(lines):
            want[(ordinal << 40) | i] = json.loads(ln)["conversations"][0]["value"]
    assert got == want and len(got) == 1000

    arr = os.path.join(tmp_out, "array.json")
    recs = [{"conversations": [{"from": "u", "value": f"q{i}"}, {"from": "a", "value": "COMPLETE"}]} for i in range(5)]
    with open(arr, "w") as f:
        json.dump(recs, f, indent=1)
    rows = sorted((r.entry_id, r.conversations[0].value) for r in read_entries(spark, arr, "json-array-pos").collect())
    assert rows == [(i, f"q{i}") for i in range(5)]


def test_preview_truncates(spark):
    ev = events_to_entries(spark.read.parquet(f"{SF001}/events.parquet"))
    p = flatten_pairs(generate_pairs(ev)).select("entry_id", "strategy_ord", "prompt", "chosen")
    row = preview(p, ["entry_id", "strategy_ord"], 1, width=10).first()
    full = p.orderBy("entry_id", "strategy_ord").first()
    assert row.prompt == full.prompt[:10] and row.entry_id == full.entry_id


def test_dataset_candidates_order(spark, tmp_out):
    from prefpairs.sources.readers import dataset_candidates

    root = os.path.join(tmp_out, "ds")
    ev = events_to_entries(spark.read.parquet(f"{SF001}/events.parquet"))
    ev.filter("entry_id < 10").write.parquet(os.path.join(root, "validation"))
    ev.filter("entry_id >= 10").write.parquet(os.path.join(root, "test"))
    df, used = resolve_entries(spark, dataset_candidates(root))
    assert used.endswith("/validation") and df.count() == 10   # no data.json, no train/


def test_cli_generate_and_prepare(spark, tmp_out, capsys):
    from prefpairs.plans.job import main

    out = os.path.join(tmp_out, "cli")
    missing = ["generate", "--source", os.path.join(tmp_out, "missing.json") + ":json-pos", "--out", out, "--single-file"]
    with pytest.raises(FileNotFoundError):
        main(missing)
    main([*missing, "--synthetic", "10"])
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rep["source"] == "synthetic:10" and rep["valid_pairs"] == 20 and rep["action_click"] == 22
    main(["prepare", "--pairs", rep["pairs_table"], "--out", os.path.join(tmp_out, "sft"), "--kind", "sft", "--exact"])
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts == {"train": 18, "eval": 2}


def test_positional_ids_gzip(spark, tmp_out):
    import gzip

    src = os.path.join(tmp_out, "gz")
    os.makedirs(src)
    with gzip.open(os.path.join(src, "part-0.json.gz"), "wt") as f:
        for i in range(50):
            f.write(json.dumps({"conversations": [{"from": "u", "value": f"q{i}"}, {"from": "a", "value": "COMPLETE"}]}) + "\n")
    rows = sorted((r.entry_id, r.conversations[0].value) for r in read_entries(spark, src, "json-pos").collect())
    assert rows == [(i, f"q{i}") for i in range(50)]


def test_prepare_orders_jsonl_by_line(spark, tmp_out):
    """JSON lines have an order: the place of the line, as a sequential reader sees it."""
    from prefpairs.plans.job import prepare
    from prefpairs.sources.readers import read_pairs_jsonl
    from prefpairs.sources.sinks import write_jsonl
    from prefpairs.sources.synthetic import synthetic_entries

    path = write_jsonl(generate_pairs(synthetic_entries(spark, 10)).orderBy("entry_id", "strategy_ord"), os.path.join(tmp_out, "p.jsonl"), single_file=True)
    part = next(f for f in os.listdir(path) if f.startswith("part-"))
    lines = [json.loads(x)["prompt"] for x in open(os.path.join(path, part))]
    rows = read_pairs_jsonl(spark, path, positions=True).orderBy("line_id").collect()
    assert [r.prompt for r in rows] == lines and [r.line_id for r in rows] == list(range(20))
    assert sum(prepare(spark, path, os.path.join(tmp_out, "o1"), "dpo", limit=5).values()) == 5
    kept = spark.read.parquet(os.path.join(tmp_out, "o1"))
    assert sorted(r.prompt for r in kept.collect()) == sorted(lines[:5]) and "line_id" in kept.columns
    assert prepare(spark, path, os.path.join(tmp_out, "o2"), "dpo", n_eval=3) == {"train": 17, "eval": 3}
    assert prepare(spark, path, os.path.join(tmp_out, "o3"), "sft", exact=True) == {"train": 18, "eval": 2}
    assert sum(prepare(spark, path, os.path.join(tmp_out, "o4"), "sft", drop_duplicates=True, split_by="content").values()) <= 10


def test_pair_tables_by_declared_format(spark, tmp_out):
    from prefpairs.plans.job import load_pairs, prepare

    plain = os.path.join(tmp_out, "plain")
    spark.createDataFrame([(f"p{i}", "c", "r") for i in range(5)], "prompt string, chosen string, rejected string").write.parquet(plain)
    assert sum(prepare(spark, plain, os.path.join(tmp_out, "o"), "sft").values()) == 5
    assert spark.read.parquet(os.path.join(tmp_out, "o")).filter("text is null").count() == 0
    with pytest.raises(ValueError, match="order"):
        prepare(spark, plain, os.path.join(tmp_out, "o"), "sft", limit=2)
    with pytest.raises(Exception, match="json_error"):
        load_pairs(spark, plain, "jsonl")[0].collect()
    with pytest.raises(ValueError):
        load_pairs(spark, plain, "csv")


def test_faulty_pair_lines_never_become_rows(spark, tmp_out):
    from prefpairs.sources.readers import read_pairs_jsonl

    path = os.path.join(tmp_out, "pairs.jsonl")
    good = '{"prompt": "p", "chosen": "c", "rejected": "r"}'
    with open(path, "w") as f:
        f.write("\n".join([good, "{bad", '{"prompt": "p", "rejected": "r"}', "", '{"prompt": 5, "chosen": "c", "rejected": "r"}', good + " x", "[1]"]))
    with pytest.raises(Exception, match="line is no pair"):
        read_pairs_jsonl(spark, path).collect()
    assert [tuple(r) for r in read_pairs_jsonl(spark, path, on_fault="drop").collect()] == [("p", "c", "r")]
    faults = sorted(str(r.fault) for r in read_pairs_jsonl(spark, path, on_fault="keep").collect())
    assert faults == sorted(["None", "json_error", "missing_key", "non_text", "json_error", "missing_key"])


FAULTY = [
    {"conversations": [{"value": "q"}, {"value": "COMPLETE"}]},
    {"conversations": [{"value": 5}, {"value": "COMPLETE"}]},
    {"conversations": [{"value": "q"}, {"value": {"a": 1}}]},
    {"conversations": [{"value": True}, {"value": "COMPLETE"}]},
    {"conversations": [{"value": None}, {"value": "COMPLETE"}]},
    {"conversations": [{"value": "q"}]},
    {"conversations": "abc"},
    {},
]
WANT = {None: 1, "non_text_message": 3, "empty_message": 1, "too_few_messages": 2, "malformed_record": 1}


@pytest.mark.parametrize("fmt", ["json", "json-pos", "json-array", "json-array-pos"])
def test_entry_faults_are_skipped_and_counted(spark, tmp_out, fmt):
    from prefpairs.operators.pairs import skip_reasons

    path, want = os.path.join(tmp_out, "data.json"), dict(WANT)
    records = [{"entry_id": i, **r} for i, r in enumerate(FAULTY)]
    with open(path, "w") as f:
        if "array" in fmt:
            json.dump(records, f)
        else:
            f.write("\n".join(map(json.dumps, records)) + '\n{broken\n{"entry_id": 9} x\n')
            want["malformed_record"] += 2
    got = {r.skip_reason: r.entries for r in skip_reasons(read_entries(spark, path, fmt)).collect()}
    assert got == want


def test_null_ids_fail_in_every_source(spark, tmp_out):
    ent = spark.createDataFrame([(None, [("u", "q"), ("a", "COMPLETE")])], "entry_id long, conversations array<struct<`from`:string,value:string>>")
    ent.write.parquet(os.path.join(tmp_out, "pq"))
    with pytest.raises(Exception, match="entry without entry_id"):
        read_entries(spark, os.path.join(tmp_out, "pq"), "parquet").collect()
    with pytest.raises(Exception, match="entry without entry_id"):
        adapt(ent, lambda d: d).collect()


def _question_lines(path, n, first=0):
    with open(path, "w") as f:
        for i in range(first, first + n):
            f.write(json.dumps({"conversations": [{"value": f"question {i}"}, {"value": "COMPLETE"}]}) + "\n")


def test_positions_hold_when_settings_change(spark, tmp_out):
    """The cut is pinned when the rows are counted: settings and cores that change before they
    are read change no id."""
    path = os.path.join(tmp_out, "lines.json")
    _question_lines(path, 3000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for counted, read in (("16384", "65536"), ("65536", "16384"), ("16kb", "1g")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", counted)
            df = read_entries(spark, path, "json-pos")
            spark.conf.set("spark.sql.files.maxPartitionBytes", read)
            spark.conf.set("spark.sql.files.minPartitionNum", "64")
            assert df.rdd.getNumPartitions() > 1
            rows = df.select("entry_id", "conversations").collect()
            assert sorted((r.entry_id, r.conversations[0].value) for r in rows) == [(i, f"question {i}") for i in range(3000)]
            spark.conf.unset("spark.sql.files.minPartitionNum")
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_positions_fail_when_files_change(spark, tmp_out):
    """A file that is written anew after its lines were counted: an error, never lost or
    misnumbered rows."""
    folder = os.path.join(tmp_out, "lines")
    os.makedirs(folder)
    for k in range(3):
        _question_lines(os.path.join(folder, f"{k}.json"), 500, 500 * k)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = read_entries(spark, folder, "json-pos")
        _question_lines(os.path.join(folder, "1.json"), 700)
        with pytest.raises(Exception, match="other splits|FAILED_READ_FILE|been updated"):
            df.select("entry_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_positions_keep_the_callers_settings(spark, tmp_out):
    path = os.path.join(tmp_out, "lines.json")
    _question_lines(path, 10)
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        df = read_entries(spark, path, "json-pos")
        assert df.sparkSession.conf.get("spark.sql.shuffle.partitions") == "5"
        joined = df.join(spark.range(4).withColumnRenamed("id", "entry_id"), "entry_id")  # of two sessions
        assert joined.count() == 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_head_reads_the_first_files_only(spark, tmp_out):
    """The first n lines in path order, from the files that hold them."""
    from prefpairs.sources.readers import read_pairs_jsonl

    folder = os.path.join(tmp_out, "a folder")
    os.makedirs(folder)
    for k in range(12):
        with open(os.path.join(folder, f"part-{k:02d}.json"), "w") as f:
            for i in range(k * 10, k * 10 + 10):
                f.write(json.dumps({"prompt": f"p{i}", "chosen": "c", "rejected": "r"}) + "\n \n")
    open(os.path.join(folder, "part-00.json"), "w").close()  # the first file is empty
    for n, files in ((1, 2), (10, 2), (11, 3), (35, 5), (110, 12), (10**6, 12)):
        df = read_pairs_jsonl(spark, folder, positions=True, head=n)
        read = sorted(os.path.basename(f) for f in df.inputFiles() if "part-" in f and f.endswith(".json"))
        assert read == [f"part-{k:02d}.json" for k in range(files)]
        got = [r.prompt for r in df.orderBy("line_id").collect()]
        assert got == [f"p{i}" for i in range(10, 120)][:n]
    with pytest.raises(ValueError):
        read_pairs_jsonl(spark, folder, head=3)
    _question_lines(os.path.join(tmp_out, "e.json"), 50)
    rows = read_entries(spark, os.path.join(tmp_out, "e.json"), "json-pos", head=7).collect()
    assert sorted(r.entry_id for r in rows) == list(range(7))
    with pytest.raises(ValueError):
        read_entries(spark, folder, "json", head=3)


def test_generate_samples_from_the_first_files(spark, tmp_out):
    from prefpairs.plans.job import generate

    folder = os.path.join(tmp_out, "in")
    os.makedirs(folder)
    for k in range(4):
        _question_lines(os.path.join(folder, f"{k}.json"), 20, 20 * k)
    report = generate(spark, [(folder, "json-pos")], os.path.join(tmp_out, "out"), sample_size=25)
    assert report["valid_pairs"] == 50 and report["skipped_invalid"] == 0



def test_only_missing_sources_move_on(spark, tmp_out):
    from prefpairs.sources.readers import first_split, resolve_source

    os.makedirs(os.path.join(tmp_out, "empty"))
    with pytest.raises(FileNotFoundError):
        resolve_source(spark, [(os.path.join(tmp_out, "nope"), "parquet"), (os.path.join(tmp_out, "empty"), "parquet")])
    with pytest.raises(ValueError):
        resolve_source(spark, [(os.path.join(tmp_out, "empty"), "jsonn")], 10)
    assert resolve_source(spark, [(os.path.join(tmp_out, "nope"), "json")], 3).synthetic
    files = ["/r/training/x/data-test.parquet", "/r/training/x/data-train-0.parquet", "/r/training/x/data-train-1.parquet"]
    assert first_split(files, "/r/training/x") == files[1:] and first_split(files[:1], "/r/training/x") == files[:1]
    assert first_split(["/a/1.parquet"], "/a") == ["/a/1.parquet"]


def test_sample_applies_to_any_path(spark, tmp_out):
    """A folder whose name starts like the synthetic label is a source like any other."""
    from prefpairs.plans.job import generate

    for name in ("other", "synthetic_runs"):
        src = os.path.join(tmp_out, name)
        events_to_entries(spark.read.parquet(f"{SF001}/events.parquet")).filter("entry_id in (1, 2, 3, 4)").write.parquet(src)
        rep = generate(spark, [(src, "parquet")], os.path.join(tmp_out, name + "-out"), sample_size=2)
        assert rep["valid_pairs"] + 2 * rep["skipped_invalid"] == 4
