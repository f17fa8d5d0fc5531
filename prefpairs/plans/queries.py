"""Named queries over the driver's tables: one per operator family.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame with BIGINT / DOUBLE /
STRING columns only; names match the SQL in ``plans.oracle``. Inputs are the whole
``events`` and ``conversations`` tables; sizes of prefixes/splits are the operators'
own parameters.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefpairs import constants as K
from prefpairs.functions.actions import parse_actions
from prefpairs.operators import audit, pairs, training
from prefpairs.operators.entries import extract_entries, parse_entries, valid_entries
from prefpairs.operators.pixels import with_pixels
from prefpairs.operators.rejections import chosen_action, register_strategy
from prefpairs.plans.batches import generate_in_batches, read_batches
from prefpairs.schema import PairConfig
from prefpairs.session import scratch_path
from prefpairs.sources import sinks
from prefpairs.sources.adapters import adapt, conversations_to_entries, events_to_entries, message
from prefpairs.sources.readers import read_entries, read_lines, read_pairs_jsonl, resolve_source, spread
from prefpairs.sources.synthetic import synthetic_entries_from_ids
from prefpairs.streaming.audit_stream import latest_totals, run_audit_stream
from prefpairs.streaming.pairs_stream import run_pairs_stream
from prefpairs.streaming.prepare_stream import read_prepared, run_counts_stream, run_prepare_stream, total_counts

# Operator parameters used by the registered queries.
RAW_PREFIX_N = 2500
VALID_CAP_N = 2000
MAX_SAMPLES_M = 5000
SPLIT_N_EVAL = 1000
DEVICE_SIZE = (1080, 2400)
PEEK_N = 3
SLICE = (100, 5_000_000)
ORDERED_PART = 3_000
BATCH_SIZE = 5_000

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, spread over all task slots when the file has too few splits."""
    return spread(table(spark, sf_dir, "events"))


def event_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_entries(events(spark, sf_dir))


def event_pairs(spark: SparkSession, sf_dir: str, cfg: PairConfig = PairConfig()) -> DataFrame:
    return pairs.generate_pairs(event_entries(spark, sf_dir), cfg)


def _extracted(entries: DataFrame) -> DataFrame:
    return extract_entries(entries).filter(F.col("skip_reason").isNull()).select("entry_id", "instruction", "raw_action")


def q_entries_extracted(spark, sf_dir):
    return _extracted(event_entries(spark, sf_dir))


def q_entries_from_conversations(spark, sf_dir):
    return _extracted(conversations_to_entries(table(spark, sf_dir, "conversations")))


def q_actions_parsed(spark, sf_dir):
    return parse_entries(event_entries(spark, sf_dir)).select("entry_id", "action_type", "x", "y", "text", "skip_reason")


def q_actions_canonical(spark, sf_dir):
    v = valid_entries(event_entries(spark, sf_dir))
    return v.select("entry_id", "action_type", chosen_action().alias("chosen"))


def q_prompts_built(spark, sf_dir):
    v = valid_entries(event_entries(spark, sf_dir))
    return v.select("entry_id", pairs.build_prompt(F.col("instruction")).alias("prompt"))


def _one_strategy(spark, sf_dir, name):
    p = event_pairs(spark, sf_dir, PairConfig(strategies=(name,)))
    return p.select("entry_id", "chosen", "rejected")


def q_rejections_spatial(spark, sf_dir):
    return _one_strategy(spark, sf_dir, K.SPATIAL)


def q_rejections_logical(spark, sf_dir):
    return _one_strategy(spark, sf_dir, K.LOGICAL)


def q_pairs_all(spark, sf_dir):
    return pairs.flatten_pairs(event_pairs(spark, sf_dir))


def q_generation_stats(spark, sf_dir):
    return pairs.generation_stats(event_entries(spark, sf_dir))


def q_sample_raw_prefix(spark, sf_dir):
    entries = pairs.raw_prefix(event_entries(spark, sf_dir), RAW_PREFIX_N)
    return pairs.flatten_pairs(pairs.generate_pairs(entries))


def q_sample_valid_cap(spark, sf_dir):
    capped = pairs.cap_valid(valid_entries(event_entries(spark, sf_dir)), VALID_CAP_N)
    return pairs.flatten_pairs(pairs.pairs_from_parsed(capped))


def audit_fault_lines(events: DataFrame) -> DataFrame:
    """Malformed and incomplete JSON lines derived from ``error`` events (one per event),
    to exercise every audit branch alongside the real pair lines."""
    eid = F.col("event_id")
    xn = F.floor(F.col("value") * F.lit(10.0)).cast("bigint") % F.lit(1001)
    sid = eid.cast("string")
    line = (
        F.when(eid % 6 == 0, F.concat(F.lit('{"prompt": "p'), sid, F.lit('"}')))
        .when(eid % 6 == 1, F.lit(""))
        .when(eid % 6 == 2, F.concat(F.lit('{"prompt": "p", "chosen": "CLICK: ('), sid, F.lit(', 1)"')))
        .when(eid % 6 == 3, F.concat(F.lit("["), sid, F.lit("]")))
        .when(eid % 6 == 4, F.concat(F.lit('{"prompt": "p", "chosen": "x", "rejected": "y"} '), sid))
        .otherwise(
            F.concat(
                F.lit('{"prompt": null, "chosen": "CLICK: ('),
                xn.cast("string"),
                F.lit(', 5)", "rejected": "LONG_PRESS: ('),
                (xn + F.lit(1001)).cast("string"),
                F.lit(', 7)"}'),
            )
        )
    )
    return events.filter(F.col("event_type") == "error").select(line.alias("value"))


def pair_lines(p: DataFrame) -> DataFrame:
    return p.select(F.to_json(F.struct("prompt", "chosen", "rejected"), {"ignoreNullFields": "false"}).alias("value"))


def q_audit_pairs(spark, sf_dir):
    ev = events(spark, sf_dir)
    lines = pair_lines(pairs.generate_pairs(events_to_entries(ev))).unionByName(audit_fault_lines(ev))
    return audit.audit_lines(lines)


def q_action_distribution(spark, sf_dir):
    return audit.action_distribution(event_pairs(spark, sf_dir))


def q_coords_out_of_range(spark, sf_dir):
    out = audit.coords_out_of_range(event_pairs(spark, sf_dir))
    return out.select("entry_id", F.col("strategy_ord").cast("bigint").alias("strategy_ord"), "side", "action")


def q_sft_text(spark, sf_dir):
    p = pairs.flatten_pairs(event_pairs(spark, sf_dir))
    return training.sft_text(p, keep=("entry_id", "strategy_ord"))


def q_dpo_projection(spark, sf_dir):
    return training.dpo_projection(event_pairs(spark, sf_dir))


def q_max_samples_prefix(spark, sf_dir):
    p = pairs.flatten_pairs(event_pairs(spark, sf_dir))
    return training.max_samples(p, MAX_SAMPLES_M).select("entry_id", "strategy_ord", "prompt", "chosen", "rejected")


def q_train_eval_split(spark, sf_dir):
    p = pairs.flatten_pairs(event_pairs(spark, sf_dir))
    sft = training.sft_text(p, keep=("entry_id", "strategy_ord"))
    return training.train_eval_split(sft)


def q_split_exact(spark, sf_dir):
    p = pairs.flatten_pairs(event_pairs(spark, sf_dir))
    dpo = training.dpo_projection(p, keep=("entry_id", "strategy_ord"))
    return training.split_exact(dpo, SPLIT_N_EVAL)


def q_pixels(spark, sf_dir):
    v = valid_entries(event_entries(spark, sf_dir)).filter(F.col("x").isNotNull())
    w, h = DEVICE_SIZE
    return with_pixels(v, float(w), float(h)).select("entry_id", "action_type", "px", "py")


def q_synthetic_pairs(spark, sf_dir):
    ids = events(spark, sf_dir).select("event_id")
    return pairs.flatten_pairs(pairs.generate_pairs(synthetic_entries_from_ids(ids, "event_id")))


def q_jsonl_roundtrip(spark, sf_dir):
    path = sinks.write_jsonl(event_pairs(spark, sf_dir), scratch_path(spark, "pairs-jsonl"))
    return read_pairs_jsonl(spark, path)


def q_jsonl_ordered(spark, sf_dir):
    """JSON lines written in generation order by many tasks, read back by their place."""
    path = scratch_path(spark, "pairs-ordered")
    manifest = sinks.write_jsonl_ordered(event_pairs(spark, sf_dir), path, rows_per_part=ORDERED_PART)
    read = read_pairs_jsonl(spark, path, positions=True)
    # Parts are never empty, so the n-th file is the n-th part.
    parts = manifest.select(F.col("part").cast("long").alias("_part"), "before")
    numbered = parts.withColumn("_ord", F.row_number().over(Window.orderBy("_part")) - 1)
    placed = read.withColumn("_ord", F.shiftright("line_id", 40)).join(numbered.drop("_part"), "_ord")
    return placed.select((F.col("before") + F.col("line_id") % (1 << 40)).alias("line"), "prompt", "chosen", "rejected")


def q_pairs_in_batches(spark, sf_dir):
    """Pairs written batch by batch: a run that stops after one batch, and one that goes on."""
    path, entries = scratch_path(spark, "pairs-batches"), event_entries(spark, sf_dir)
    generate_in_batches(spark, entries, path, batch_size=BATCH_SIZE, max_batches=1)
    generate_in_batches(spark, entries, path, batch_size=BATCH_SIZE)
    return pairs.flatten_pairs(read_batches(spark, path))


def q_jsonl_audit(spark, sf_dir):
    path = sinks.write_jsonl(event_pairs(spark, sf_dir), scratch_path(spark, "pairs-audit"))
    return audit.audit_lines(read_lines(spark, path))


def q_pairs_streamed(spark, sf_dir):
    out = run_pairs_stream(
        spark,
        os.path.join(sf_dir, "events.parquet"),
        scratch_path(spark, "pairs-stream"),
        spread_to=spark.sparkContext.defaultParallelism,  # the test tables are one row group
    )
    return pairs.flatten_pairs(spark.read.parquet(out))


def q_peek(spark, sf_dir):
    p = pairs.flatten_pairs(event_pairs(spark, sf_dir)).select("entry_id", "strategy_ord", "prompt", "chosen", "rejected")
    return sinks.peek(p, ["entry_id", "strategy_ord"], PEEK_N)


# --- sources and sinks: the tables written out and read back --------------------------


def write_entry_lines(spark, sf_dir, with_ids: bool) -> str:
    """Entries as JSON lines in files that follow the order of the ids; the sender of each
    message carries the id."""
    e = event_entries(spark, sf_dir)
    tagged = F.transform("conversations", lambda m: F.struct(F.col("entry_id").cast("string").alias("from"), m["value"].alias("value")))
    out = e.select("entry_id", tagged.alias("conversations")).repartitionByRange("entry_id").sortWithinPartitions("entry_id")
    path = scratch_path(spark, "entry-lines")
    (out if with_ids else out.drop("entry_id")).write.json(path)
    return path


def q_entries_json_lines(spark, sf_dir):
    """Id-less JSON lines: positions are unique and follow the order of the lines."""
    read = read_entries(spark, write_entry_lines(spark, sf_dir, with_ids=False), "json-pos")
    origin = F.get("conversations", 0)["from"].cast("bigint")
    in_file = Window.partitionBy(F.shiftright("entry_id", 40)).orderBy("entry_id")
    ordered = read.select("*", origin.alias("_origin")).withColumn("in_order", F.coalesce(F.lag("_origin").over(in_file) < F.col("_origin"), F.lit(True)))
    kept = extract_entries(ordered).filter(F.col("skip_reason").isNull())
    return kept.select(F.col("_origin").alias("entry_id"), "instruction", "raw_action", "in_order")


def q_entries_json_array(spark, sf_dir):
    """JSON array files of up to 500 entries each."""
    e = event_entries(spark, sf_dir)
    arrays = e.groupBy(F.floor(F.col("entry_id") / 500).alias("g")).agg(F.to_json(F.collect_list(F.struct("entry_id", "conversations"))).alias("value"))
    path = scratch_path(spark, "entry-arrays")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return _extracted(read_entries(spark, path, "json-array"))


def q_entries_parquet(spark, sf_dir):
    path = scratch_path(spark, "entries")
    event_entries(spark, sf_dir).write.parquet(path)
    return _extracted(read_entries(spark, path, "parquet"))


def q_source_fallback(spark, sf_dir):
    """The first candidate that exists: here the third."""
    path = write_entry_lines(spark, sf_dir, with_ids=True)
    return _extracted(resolve_source(spark, [(path + "-a", "parquet"), (path + "-b", "json-pos"), (path, "json")]).entries)


def q_entries_faults(spark, sf_dir):
    """Records that are no entries, and messages that are no text, by outcome."""
    eid = F.col("event_id")
    sid = eid.cast("string")
    record = lambda user, action: F.concat(F.lit('{"entry_id": '), sid, F.lit(f', "conversations": [{{"value": {user}}}, {{"value": {action}}}]}}'))
    line = (
        F.when(eid % 8 == 0, record('"go"', '"COMPLETE"'))
        .when(eid % 8 == 1, record("5", '"COMPLETE"'))
        .when(eid % 8 == 2, record('"go"', '{"a": 1}'))
        .when(eid % 8 == 3, record("true", '"COMPLETE"'))
        .when(eid % 8 == 4, record("null", '"COMPLETE"'))
        .when(eid % 8 == 5, F.concat(F.lit("{broken "), sid))
        .when(eid % 8 == 6, F.concat(F.lit('{"entry_id": '), sid, F.lit(', "conversations": [{"value": "go"}]}')))
        .otherwise(F.concat(record('"go"', '"COMPLETE"'), F.lit(" x")))
    )
    path = scratch_path(spark, "entry-faults")
    events(spark, sf_dir).select(line.alias("value")).write.text(path)
    out = pairs.skip_reasons(read_entries(spark, path, "json"))
    return out.select(F.coalesce("skip_reason", F.lit("valid")).alias("outcome"), F.col("entries").alias("n"))


def ordered_pair_lines(spark, sf_dir) -> str:
    """Pair JSON lines in files that follow the generation order."""
    p = event_pairs(spark, sf_dir).repartitionByRange("entry_id", "strategy_ord").sortWithinPartitions("entry_id", "strategy_ord")
    return sinks.write_jsonl(p, scratch_path(spark, "pairs-ordered"))


def q_pairs_jsonl_faults(spark, sf_dir):
    ev = events(spark, sf_dir)
    path = scratch_path(spark, "pairs-faults")
    pair_lines(pairs.generate_pairs(events_to_entries(ev))).unionByName(audit_fault_lines(ev)).write.text(path)
    read = read_pairs_jsonl(spark, path, on_fault="keep")
    return read.groupBy(F.coalesce("fault", F.lit("none")).alias("fault")).agg(F.count(F.lit(1)).alias("n"))


def q_jsonl_max_samples(spark, sf_dir):
    read = read_pairs_jsonl(spark, ordered_pair_lines(spark, sf_dir), positions=True, head=MAX_SAMPLES_M)
    return read.select("prompt", "chosen", "rejected")


def q_jsonl_split_exact(spark, sf_dir):
    read = read_pairs_jsonl(spark, ordered_pair_lines(spark, sf_dir), positions=True)
    out = training.split_exact(read, SPLIT_N_EVAL, key="content", tiebreak=("line_id",))
    return out.select("prompt", "chosen", "rejected", "split")


def q_train_eval_split_rows(spark, sf_dir):
    p = pairs.flatten_pairs(event_pairs(spark, sf_dir))
    return training.train_eval_split(training.sft_text(p, keep=("entry_id", "strategy_ord")), key="pair")


def q_pairs_table_logical(spark, sf_dir):
    """The partitioned pair table, one strategy read back."""
    path = sinks.write_pairs_table(event_pairs(spark, sf_dir), scratch_path(spark, "pairs-table"))
    one = spark.read.parquet(path).filter(F.col("rejection_strategy") == K.LOGICAL)
    return one.select("entry_id", "prompt", "chosen", "rejected", F.col("metadata.source").alias("source"))


def q_summary_report(spark, sf_dir):
    path = sinks.write_jsonl(event_pairs(spark, sf_dir), scratch_path(spark, "pairs-report"))
    return audit.summary(spark, path).drop("output_path")


def q_prepared_counts(spark, sf_dir):
    """Rows by split, as the prepare job reports them."""
    from prefpairs.plans.job import prepare

    path = sinks.write_pairs_table(event_pairs(spark, sf_dir), scratch_path(spark, "pairs-prepare"))
    counts = prepare(spark, path, scratch_path(spark, "prepared"), "dpo")
    return spark.createDataFrame(sorted(counts.items()), "split string, n bigint")


def q_entries_slice(spark, sf_dir):
    return _extracted(pairs.slice_entries(event_entries(spark, sf_dir), *SLICE))


def q_preview(spark, sf_dir):
    p = pairs.flatten_pairs(event_pairs(spark, sf_dir)).select("entry_id", "strategy_ord", "prompt", "chosen", "rejected")
    return sinks.preview(p, ["entry_id", "strategy_ord"], PEEK_N, width=12)


def q_rejections_no_noise(spark, sf_dir):
    """Without noise every moved point falls on its origin, so each takes the collision step."""
    p = event_pairs(spark, sf_dir, PairConfig(noise_std=0.0, strategies=(K.SPATIAL,)))
    return p.select("entry_id", "chosen", "rejected")


def q_rejections_custom(spark, sf_dir):
    """A strategy of the user's own: the coordinates swapped."""
    swapped = F.concat(F.col("action_type"), F.lit(": ("), F.col("y").cast("string"), F.lit(", "), F.col("x").cast("string"), F.lit(")"))
    register_strategy("swapped", lambda cfg: F.when(F.col("x").isNotNull(), swapped).otherwise(F.col("chosen")))
    return _one_strategy(spark, sf_dir, "swapped")


def q_audit_uncounted(spark, sf_dir):
    """Coordinates that cannot be read are not counted; an empty input counts zeros."""
    sid = F.col("event_id").cast("string")
    line = F.concat(F.lit('{"prompt": "p", "chosen": "CLICK: (a'), sid, F.lit(', 2)", "rejected": "LONG_PRESS: (1, '), sid, F.lit(', 3)"}'))
    lines = events(spark, sf_dir).select(line.alias("value"))
    odd, none = audit.audit_lines(lines), audit.audit_lines(lines.filter(F.lit(False)))
    return odd.select(F.lit("unreadable").alias("input"), "*").unionByName(none.select(F.lit("empty").alias("input"), "*"))


def q_audit_bare_numbers(spark, sf_dir):
    """Lines with NaN and Infinity: as numbers, within strings, and where they are faults."""
    sid = F.col("event_id").cast("string")
    kinds = [
        ('{"prompt": NaN, "chosen": "CLICK: (1, 2)", "rejected": "TYPE: ', '", "x": [-Infinity, NaN]}'),   # a valid pair
        ('{"prompt": "a \\" NaN, ', ' \\\\", "chosen": "SCROLL: (NaN, Infinity)", "rejected": Infinity}'),   # valid: in strings
        ('{"prompt": Infinity, "x": ', "}"),                                                                 # keys are missing
        ('{"prompt": -NaN, "chosen": "CLICK: (1, 2)", "rejected": "', '"}'),                                 # a fault
        ('{"prompt": "p", "chosen": "CLICK: (1, 2)", "rejected": 1NaN, "x": ', "}"),                         # a fault
        ('{"prompt": "p", NaN: "CLICK: (1, 2)", "x": ', "}"),                                                # a fault
    ]
    line = F.element_at(F.array(*[F.concat(F.lit(a), sid, F.lit(b)) for a, b in kinds]), (F.col("event_id") % len(kinds) + 1).cast("int"))
    return audit.audit_lines(events(spark, sf_dir).select(line.alias("value")), bare_numbers=True)


def hard_actions(turns: DataFrame) -> DataFrame:
    """Conversation turns -> actions in unusual notations around their numbers and text."""
    c, t = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    k = (F.col("conv_id") + F.col("turn")) % 7
    cat = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    action = (
        F.when(k == 0, cat(" CLICK: CLICK: (", c, "e1, .", t, ")　"))
        .when(k == 1, cat('TYPE: "', F.col("text"), '"'))
        .when(k == 2, cat(" TYPE: 'say \"", t, "\" twice' "))
        .when(k == 3, cat("SCROLL:(+", c, "., -", t, ".75)"))
        .when(k == 4, cat("LONG_PRESS: ((1_", F.lpad(t, 3, "0"), " , ", c, "E+0)"))
        .when(k == 5, cat("CLICK: (١٢, ３)"))
        .otherwise(cat("INCOMPLETE", F.col("text")))
    )
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("entry_id"), action.alias("raw"))


def q_actions_hard(spark, sf_dir):
    raw = hard_actions(table(spark, sf_dir, "conversations"))
    return parse_actions(raw, "raw").select("entry_id", "action_type", "x", "y", "text")


def q_sft_deduplicated(spark, sf_dir):
    """The first row of each text in generation order, split by the text at an exact size."""
    p = pairs.flatten_pairs(event_pairs(spark, sf_dir))
    order = ("entry_id", "strategy_ord")
    path = scratch_path(spark, "sft-distinct")
    training.sft_text(p, order, drop_duplicates=True, order=order).write.parquet(path)
    return training.split_exact(spark.read.parquet(path), SPLIT_N_EVAL, key="text")


def _shaped(spark, sf_dir, shape):
    p = event_pairs(spark, sf_dir, PairConfig(strategies=(K.SPATIAL,), noise_shape=shape))
    return p.select("entry_id", "chosen", "rejected")


def q_rejections_disc(spark, sf_dir):
    return _shaped(spark, sf_dir, "disc")


def q_rejections_laplace(spark, sf_dir):
    return _shaped(spark, sf_dir, "laplace")


def q_rejections_truncated(spark, sf_dir):
    return _shaped(spark, sf_dir, "truncated")


def q_entries_adapted(spark, sf_dir):
    """Raw annotations of another shape through an adapter of the user's own: one label a
    document, as two messages."""

    def labels_to_entries(labels: DataFrame) -> DataFrame:
        point = F.concat(F.lit("CLICK: ("), F.col("quality").cast("string"), F.lit(", "), F.col("toxic").cast("string"), F.lit(")"))
        said = F.concat(F.lit(" Label document "), F.col("doc_id").cast("string"))
        return labels.select(F.col("doc_id").alias("entry_id"), F.array(message("annotator", said), message("tool", point)).alias("conversations"))

    return _extracted(adapt(table(spark, sf_dir, "labels"), labels_to_entries))


def _arriving(df: DataFrame, spark, run: Callable[[str, str], str]) -> str:
    """``df`` by id in two deliveries of several files each; ``run`` after each of them, the
    second time with the first's checkpoint."""
    folder, out = scratch_path(spark, "arriving"), scratch_path(spark, "arrived")
    late = F.col(df.columns[0]) % 3 == 0
    for part in (~late, late):
        df.filter(part).repartition(4).write.mode("append").parquet(folder)
        run(folder, out)
    return out


def q_train_eval_split_streamed(spark, sf_dir):
    p = pairs.flatten_pairs(event_pairs(spark, sf_dir)).select("entry_id", "strategy_ord", "prompt", "chosen", "rejected")
    out = _arriving(p, spark, lambda folder, out: run_prepare_stream(spark, folder, out, "sft", max_files_per_trigger=3))
    return read_prepared(spark, out)


def q_generation_stats_streamed(spark, sf_dir):
    out = _arriving(table(spark, sf_dir, "events"), spark, lambda folder, out: run_counts_stream(spark, folder, out, events_to_entries, max_files_per_trigger=3))
    return total_counts(spark, out)


def q_audit_streamed(spark, sf_dir):
    path = sinks.write_jsonl(event_pairs(spark, sf_dir), scratch_path(spark, "pairs-arriving"), max_records_per_file=50_000)
    out = run_audit_stream(spark, path, scratch_path(spark, "audit-totals"), max_files_per_trigger=3)
    return latest_totals(spark, out)


QUERIES: dict[str, Query] = {
    "entries_extracted": q_entries_extracted,
    "entries_from_conversations": q_entries_from_conversations,
    "actions_parsed": q_actions_parsed,
    "actions_canonical": q_actions_canonical,
    "prompts_built": q_prompts_built,
    "rejections_spatial": q_rejections_spatial,
    "rejections_logical": q_rejections_logical,
    "pairs_all": q_pairs_all,
    "generation_stats": q_generation_stats,
    "sample_raw_prefix": q_sample_raw_prefix,
    "sample_valid_cap": q_sample_valid_cap,
    "audit_pairs": q_audit_pairs,
    "action_distribution": q_action_distribution,
    "coords_out_of_range": q_coords_out_of_range,
    "sft_text": q_sft_text,
    "dpo_projection": q_dpo_projection,
    "max_samples_prefix": q_max_samples_prefix,
    "train_eval_split": q_train_eval_split,
    "split_exact": q_split_exact,
    "pixels": q_pixels,
    "synthetic_pairs": q_synthetic_pairs,
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "jsonl_audit": q_jsonl_audit,
    "pairs_streamed": q_pairs_streamed,
    "peek": q_peek,
    "entries_json_lines": q_entries_json_lines,
    "entries_json_array": q_entries_json_array,
    "entries_parquet": q_entries_parquet,
    "source_fallback": q_source_fallback,
    "entries_faults": q_entries_faults,
    "pairs_jsonl_faults": q_pairs_jsonl_faults,
    "jsonl_max_samples": q_jsonl_max_samples,
    "jsonl_split_exact": q_jsonl_split_exact,
    "train_eval_split_rows": q_train_eval_split_rows,
    "pairs_table_logical": q_pairs_table_logical,
    "summary_report": q_summary_report,
    "prepared_counts": q_prepared_counts,
    "entries_slice": q_entries_slice,
    "preview": q_preview,
    "rejections_no_noise": q_rejections_no_noise,
    "rejections_custom": q_rejections_custom,
    "audit_uncounted": q_audit_uncounted,
    "audit_bare_numbers": q_audit_bare_numbers,
    "jsonl_ordered": q_jsonl_ordered,
    "pairs_in_batches": q_pairs_in_batches,
    "actions_hard": q_actions_hard,
    "sft_deduplicated": q_sft_deduplicated,
    "rejections_disc": q_rejections_disc,
    "rejections_laplace": q_rejections_laplace,
    "rejections_truncated": q_rejections_truncated,
    "entries_adapted": q_entries_adapted,
    "train_eval_split_streamed": q_train_eval_split_streamed,
    "generation_stats_streamed": q_generation_stats_streamed,
    "audit_streamed": q_audit_streamed,
}
