"""Physical-plan properties that matter at scale."""


from conftest import SF001
from prefpairs.operators.audit import audit_lines
from prefpairs.operators.pairs import generate_pairs, raw_prefix
from prefpairs.plans.queries import pair_lines
from prefpairs.sources.adapters import events_to_entries


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_single_stage_no_shuffle(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    plan = _plan(generate_pairs(events_to_entries(ev)))
    assert "Exchange" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan
    assert "Generate" in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "ts:" not in read_schema          # unused column pruned at the scan


def test_prefix_filter_reaches_scan(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    plan = _plan(generate_pairs(raw_prefix(events_to_entries(ev), 100)))
    assert "PushedFilters" in plan and "LessThanOrEqual(event_id" in plan


def test_parse_filter_not_inlined(spark):
    """The valid-entry filter stays above the parse barrier: each JSON/regex step is
    compiled once, not substituted into the predicate."""
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    opt = generate_pairs(events_to_entries(ev))._jdf.queryExecution().optimizedPlan().toString()
    assert opt.count("md5(") == 4               # two digests per axis, none duplicated


def test_audit_is_one_aggregate(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    plan = _plan(audit_lines(pair_lines(generate_pairs(events_to_entries(ev)))))
    assert plan.count("HashAggregate") == 2      # partial + final
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan


def test_unread_rejections_are_pruned(spark):
    """Selecting only keys (prefix selection) or SFT text does not compute the noise."""
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    pairs = generate_pairs(events_to_entries(ev))
    keys = pairs.select("entry_id", "strategy_ord")._jdf.queryExecution().optimizedPlan().toString()
    assert keys.count("md5(") == 0


def test_positions_shuffle_no_line(spark, tmp_out):
    """Between the text scan and the parsed entry there is no exchange: the directory of the
    splits is broadcast."""
    import os

    from prefpairs.sources.readers import read_entries, read_pairs_jsonl

    src = os.path.join(tmp_out, "lines")
    spark.range(2000).selectExpr("concat('{\"prompt\": \"p', id, '\", \"chosen\": \"c\", \"rejected\": \"r\"}') AS value").repartition(3).write.text(src)
    for df in (read_pairs_jsonl(spark, src, positions=True), read_pairs_jsonl(spark, src, positions=True, head=900), read_entries(spark, src, "json-pos")):
        plan = _plan(df)
        lines = plan[: plan.index("BroadcastExchange")]  # the scan's side comes first
        assert "BroadcastHashJoin" in lines and "FileScan text" in lines and "SortMergeJoin" not in plan
        assert "Exchange" not in lines.replace("BroadcastExchange", "")
