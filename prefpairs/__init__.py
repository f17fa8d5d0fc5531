"""Preference-pair data engine on Spark: GUI-navigation instruction/action records ->
(prompt, chosen, rejected) pairs, audits and training sets, as DataFrame plans.

Typical use::

    from prefpairs import build_session, read_entries, generate_pairs, write_jsonl, audit_file
    spark = build_session()
    pairs = generate_pairs(read_entries(spark, "data.json", "json-pos"))
    write_jsonl(pairs, "out/pairs.jsonl")
    audit_file(spark, "out/pairs.jsonl").show()
"""

from prefpairs.operators.audit import action_distribution, audit_file, audit_lines, summary
from prefpairs.operators.entries import extract_entries, parse_entries, valid_entries
from prefpairs.operators.pairs import (
    cap_valid,
    flatten_pairs,
    generate_pairs,
    generation_stats,
    pairs_from_parsed,
    raw_prefix,
)
from prefpairs.operators.rejections import register_strategy
from prefpairs.operators.training import dpo_projection, max_samples, sft_text, split_exact, train_eval_split
from prefpairs.schema import ENTRY, PAIR, PairConfig
from prefpairs.session import build_session
from prefpairs.sources.readers import read_entries, read_lines, read_pairs_jsonl, resolve_entries
from prefpairs.sources.sinks import peek, preview, write_jsonl, write_pairs_table

__all__ = [
    "ENTRY",
    "PAIR",
    "PairConfig",
    "action_distribution",
    "audit_file",
    "audit_lines",
    "build_session",
    "cap_valid",
    "dpo_projection",
    "extract_entries",
    "flatten_pairs",
    "generate_pairs",
    "generation_stats",
    "max_samples",
    "pairs_from_parsed",
    "parse_entries",
    "peek",
    "preview",
    "raw_prefix",
    "read_entries",
    "read_lines",
    "read_pairs_jsonl",
    "register_strategy",
    "resolve_entries",
    "sft_text",
    "split_exact",
    "summary",
    "train_eval_split",
    "valid_entries",
    "write_jsonl",
    "write_pairs_table",
]
