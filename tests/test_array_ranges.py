"""JSON arrays in byte ranges: every cut of a file gives the same records, in order."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from prefpairs.sources import array_ranges as ar
from prefpairs.sources.readers import _placed_records, pinned_session, read_entries

NASTY = ['a', '"', '\\', '\\"', '\\\\', '{', '}', '[', ']', ',', '},{', '"},{"entry_id":7}', "é", "\U0001f600", "\n", ""]


def ranges_of(path: str, step: int) -> list[tuple[bytes, bool]]:
    """The two scans and the sums between them, in plain Python."""
    size, out, quotes, depth, root = os.path.getsize(path), [], 0, 0, None
    effects = [(lo, min(lo + step, size), *ar._range_effect(path, lo, min(lo + step, size))) for lo in range(0, size, step)]
    first = next((e[5] for e in effects if e[5] is not None), None)
    for lo, hi, n, outside, inside, own in effects:
        owns = own is not None and root is None
        root = own if root is None else root
        out += ar._range_records(path, lo, hi, size, quotes % 2 == 1, depth, first, owns)
        depth += inside if quotes % 2 else outside
        quotes += n
    return out


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_every_cut_gives_the_records(tmp_path, monkeypatch, block):
    monkeypatch.setattr(ar, "BLOCK", block)
    rng = random.Random(5)
    for ascii_only in (True, False):
        rows = [{"entry_id": i, "x": "".join(rng.choices(NASTY, k=rng.randrange(9))), "y": [{"z": [1, "]"]}] * rng.randrange(3)} for i in range(12)]
        path = str(tmp_path / f"rows{ascii_only}.json")
        with open(path, "w", encoding="utf-8") as f:
            f.write("﻿ \n" if not ascii_only else "")
            json.dump(rows, f, ensure_ascii=ascii_only, indent=None if ascii_only else 1)
        for step in (1, 2, 3, 11, 64, 10_000):
            got = ranges_of(path, step)
            assert not any(broken for _, broken in got), (step, got)
            assert [json.loads(text) for text, _ in got] == rows, step


@pytest.mark.parametrize(
    "text, want",
    [
        ("", []),
        ("[]", []),
        (" [ \n ] ", []),
        ('[{"a":1},]', [('{"a":1}', False), ("", True)]),
        ('[{"a":1},{"b":"x', [('{"a":1}', False), ('{"b":"x', True)]),
        ("[", [("", True)]),
        ('[{"a":1},5,null,[{"b":2}],{"c":3}]', [('{"a":1}', False), ("5", True), ("null", True), ('[{"b":2}]', True), ('{"c":3}', False)]),
        ('[{"a":1}] x', [('{"a":1}', False), (" x", True)]),
        ('[{"a":1}]\n[{"b":2}]', [('{"a":1}', False), ('{"b":2}', False)]),
        (' {"a":[1,2]} ', [(' {"a":[1,2]} ', False)]),
    ],
)
@pytest.mark.parametrize("step", [1, 4, 100])
def test_odd_files(tmp_path, text, want, step):
    path = str(tmp_path / "odd.json")
    with open(path, "w") as f:
        f.write(text)
    assert [(t.decode(), b) for t, b in ranges_of(path, step)] == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [{"entry_id": i, "conversations": [{"from": "u", "value": f'say "{i}" {{[,' + "x" * (i % 90)}, {"from": "a", "value": "COMPLETE"}]} for i in range(4000)]
    path = str(tmp_path / "one file.json")
    with open(path, "w") as f:
        json.dump(rows, f)
    plain = {r.entry_id: r.conversations[0].value for r in read_entries(spark, path, "json-array").collect()}
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    session.conf.set("spark.sql.files.openCostInBytes", "1000")
    cut = read_entries(session, path, "json-array").withColumn("task", F.spark_partition_id())
    got = cut.collect()
    assert len({r.task for r in got}) > 10
    assert {r.entry_id: r.conversations[0].value for r in got} == plain == {r["entry_id"]: r["conversations"][0]["value"] for r in rows}
    numbered = read_entries(session, path, "json-array-pos").select("entry_id", F.get("conversations", 0)["value"].alias("v"))
    assert [(r.entry_id, r.v) for r in numbered.orderBy("entry_id").collect()] == [(i, plain[i]) for i in range(4000)]
    head = read_entries(session, path, "json-array-pos", head=70)
    assert sorted(r.entry_id for r in head.collect()) == list(range(70))


def test_ranges_do_not_follow_the_cores(spark, tmp_path):
    """Ranges of a pinned session stay when what a scan is cut by changes in the other."""
    path = str(tmp_path / "a.json")
    with open(path, "w") as f:
        json.dump([{"entry_id": i, "conversations": []} for i in range(2000)], f)
    session = spark.newSession()
    session.conf.set("spark.sql.files.openCostInBytes", "100")
    session.conf.set("spark.sql.files.minPartitionNum", "3")
    pinned = pinned_session(session, [path])
    blocks = lambda s: {r["_block"] for r in _placed_records(s, path)[1].select("_block").distinct().collect()}
    want = blocks(pinned)
    assert blocks(session) == want
    session.conf.set("spark.sql.files.minPartitionNum", "9")
    assert blocks(session) != want and blocks(pinned) == want


def test_compressed_arrays_are_streamed(spark, tmp_path):
    import gzip

    with gzip.open(str(tmp_path / "a.json.gz"), "wt") as f:
        json.dump([{"entry_id": 4, "conversations": []}], f)
    assert [r.entry_id for r in read_entries(spark, str(tmp_path), "json-array").collect()] == [4]
