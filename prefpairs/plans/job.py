"""End-to-end jobs: generate pairs (source -> pairs -> files -> audit) and prepare
SFT / DPO training sets (pairs -> projection -> repeatable split -> files).

    python -m prefpairs.plans.job generate --source data.json:json-pos --out OUT [--sample N]
    python -m prefpairs.plans.job prepare --pairs OUT/pairs --kind sft --out OUT/sft

All outputs go under one folder that every executor can reach. Pairs are written once
as a keyed Parquet table and the JSON lines are derived from that table, so the parse
and noise run once and later steps read a materialised result instead of recomputing
the lineage.
"""

from __future__ import annotations

import argparse
import json
import os
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from prefpairs import constants as K
from prefpairs.functions.noise import SHAPES
from prefpairs.operators.audit import summary
from prefpairs.operators.entries import parse_entries
from prefpairs.operators.pairs import cap_valid, generation_stats, pairs_from_parsed, raw_prefix
from prefpairs.operators.training import (
    dpo_projection,
    eval_count,
    max_samples,
    sft_text,
    split_exact,
    train_eval_split,
)
from prefpairs.plans.batches import generate_in_batches
from prefpairs.schema import PairConfig
from prefpairs.session import scratch_path
from prefpairs.sources.readers import dataset_candidates, read_pairs_jsonl, resolve_source
from prefpairs.sources.sinks import write_jsonl, write_jsonl_ordered, write_pairs_table


def generate(
    spark: SparkSession,
    sources: list[tuple[str, str]],
    out_dir: str,
    cfg: PairConfig = PairConfig(),
    sample_size: int | None = None,
    single_file: bool = False,
    python_bytes: bool = False,
    python_lane: bool = False,
    synthetic_fallback: int | None = None,
    rows_per_part: int | None = None,
) -> dict:
    """Resolve the first source that exists (or, if asked for, synthetic entries), optionally keep the first
    ``sample_size`` raw entries and at most ``sample_size`` valid ones, write the pair
    table and the JSON lines (with ``rows_per_part`` in generation order, in parts with a
    manifest that many tasks write), and return the audit summary plus generation counters."""
    source = resolve_source(spark, sources, synthetic_fallback, spread_rows=True, head=sample_size or None)
    entries, used = source.entries, source.label
    # A raw prefix of N entries never has more than N valid ones, so the cap on valid
    # entries matters for synthetic entries only, which are not cut to a prefix.
    capped = sample_size if source.synthetic else None
    if sample_size and not source.synthetic:
        entries = raw_prefix(entries, sample_size)
    parsed = parse_entries(entries)
    observed = None
    if not capped:
        # Counters ride along with the write instead of costing a second pass.
        observed = Observation("generation")
        valid = F.col("skip_reason").isNull()
        parsed = parsed.observe(
            observed,
            F.count_if(~valid).alias("skipped_invalid"),
            F.count_if(valid).alias("valid_entries"),
        )
    ok = cap_valid(parsed.filter(F.col("skip_reason").isNull()).drop("skip_reason"), capped)
    table_path = write_pairs_table(pairs_from_parsed(ok, cfg), os.path.join(out_dir, "pairs"))
    pairs = spark.read.parquet(table_path)
    jsonl_path = os.path.join(out_dir, "pairs.jsonl")
    if rows_per_part:
        write_jsonl_ordered(pairs, jsonl_path, rows_per_part=rows_per_part, python_bytes=python_bytes)
    else:
        write_jsonl(pairs.orderBy("entry_id", "strategy_ord") if single_file else pairs, jsonl_path, single_file=single_file, python_bytes=python_bytes)
    report = summary(spark, jsonl_path, cfg.canvas, python_lane).first().asDict()
    if observed is not None:
        got = observed.get
        n_valid = int(got["valid_entries"])
        report.update(
            skipped_invalid=int(got["skipped_invalid"]),
            pairs_spatial=n_valid if K.SPATIAL in cfg.strategies else 0,
            pairs_logical=n_valid if K.LOGICAL in cfg.strategies else 0,
        )
    else:
        report.update(generation_stats(entries, cfg, valid_cap=capped).first().asDict())
    report.update(source=used, pairs_table=table_path)
    return report


def load_pairs(spark: SparkSession, path: str, fmt: str | None = None, positions: bool = False, head: int | None = None) -> tuple[DataFrame, tuple[str, ...]]:
    """Pairs from a Parquet table or from JSON lines, and the columns that give their order.

    ``fmt`` is ``parquet`` or ``jsonl``; by default the path's suffix decides (``.jsonl`` or
    ``.json``, also before a compression suffix). A Parquet table without the generation keys
    is valid and has no order; lines are ordered by ``line_id`` when ``positions`` asks, and only
    the first ``head`` of them are read.
    """
    if fmt is None:
        name = os.path.basename(path.rstrip("/"))
        fmt = "jsonl" if re.search(r"\.jsonl?(\.[a-z0-9]+)?$", name) else "parquet"
    if fmt == "jsonl":
        return read_pairs_jsonl(spark, path, positions=positions, head=head if positions else None), ("line_id",) if positions else ()
    if fmt != "parquet":
        raise ValueError(f"unsupported pair format {fmt!r}")
    df = spark.read.parquet(path)
    keys = ("entry_id", "strategy_ord")
    keyed = set(keys) <= set(df.columns)
    return df.select(*(keys if keyed else ()), "prompt", "chosen", "rejected"), keys if keyed else ()


def prepare(
    spark: SparkSession,
    pairs_path: str,
    out_dir: str,
    kind: str = "sft",
    split_ratio: float = 0.9,
    n_eval: int | None = None,
    limit: int | None = None,
    seed: int = 42,
    exact: bool = False,
    fmt: str | None = None,
    split_by: str | None = None,
    drop_duplicates: bool = False,
) -> dict:
    """SFT (``text``) or DPO (prompt, chosen, rejected) rows with a ``split`` column,
    written as Parquet partitioned by split.

    Keyed input splits by entry (no leak between the two pairs of an entry); input without
    ids splits by the prompt+chosen content, which groups the same way; ``split_by``
    (``entry``, ``pair``, ``line``, ``content``, ``text``) overrides. ``limit`` keeps the first pairs in
    generation order: by the keys of the table, or by the place of the lines. ``exact`` fixes
    the eval size at ``ceil((1 - split_ratio) * rows)`` like a library train/test split.
    ``drop_duplicates`` keeps the first row of each SFT text and splits by the text, so that the
    split does not follow which row that is; the reduced rows are written before they are
    selected from.
    """
    drop_duplicates = drop_duplicates and kind == "sft"
    ordered = bool(limit or exact or n_eval is not None)
    pairs, order = load_pairs(spark, pairs_path, fmt, positions=ordered, head=limit)
    if ordered and not order:
        raise ValueError("a limit or an exact eval size needs rows in an order: a keyed pair table or JSON lines")
    keyed = order == ("entry_id", "strategy_ord")
    if limit and keyed:
        pairs = max_samples(pairs, limit, order)
    key = split_by or ("text" if drop_duplicates else "entry" if keyed else "content")
    keep = (*order, *(("prompt", "chosen") if kind == "sft" and key == "content" else ()))
    rows = sft_text(pairs, keep, drop_duplicates, order) if kind == "sft" else dpo_projection(pairs, keep=order)
    if drop_duplicates:
        path = scratch_path(spark, "sft-distinct")
        rows.write.parquet(path)
        rows = spark.read.parquet(path)
    if exact and n_eval is None:
        n_eval = eval_count(rows.count(), split_ratio)
    if n_eval is not None:
        out = split_exact(rows, n_eval, seed=seed, key=key, tiebreak=order)
    else:
        out = train_eval_split(rows, ratio=split_ratio, seed=seed, key=key)
    if kind == "sft":
        out = out.drop("prompt", "chosen")
    out.write.mode("overwrite").partitionBy("split").parquet(out_dir)
    counts = spark.read.parquet(out_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["split"]: r["n"] for r in counts}


def main(argv: list[str] | None = None) -> None:
    from prefpairs.session import build_session

    ap = argparse.ArgumentParser(prog="prefpairs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("generate")
    g.add_argument(
        "--source",
        action="append",
        default=[],
        help="path:format (parquet, json, json-array, json-pos, json-array-pos); first readable wins",
    )
    g.add_argument("--dataset-root", help="folder tried as data.json, train/, validation/, test/, then whole")
    g.add_argument("--dataset-format", default="parquet", help="format of the split folders")
    g.add_argument("--single-file", action="store_true", help="one JSONL file (small outputs only)")
    g.add_argument("--rows-per-part", type=int, help="JSONL in generation order, in parts of so many lines with a manifest")
    g.add_argument("--batch-size", type=int, help="only write the pair table, in batches of so many entries that a rerun takes up")
    g.add_argument("--python-bytes", action="store_true", help="write lines exactly as json.dumps does")
    g.add_argument("--python-lane", action="store_true", help="audit rejected lines with json.loads")
    g.add_argument("--synthetic", type=int, help="so many synthetic entries if no source exists")
    g.add_argument("--out", required=True)
    g.add_argument("--sample", type=int)
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--noise-std", type=float, default=50.0)
    g.add_argument("--noise-shape", choices=tuple(SHAPES), default="gauss")
    p = sub.add_parser("prepare")
    p.add_argument("--pairs", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--kind", choices=("sft", "dpo"), default="sft")
    p.add_argument("--split-ratio", type=float, default=0.9)
    p.add_argument("--n-eval", type=int)
    p.add_argument("--max-samples", type=int)
    p.add_argument("--exact", action="store_true", help="eval size = ceil((1 - split ratio) * rows)")
    p.add_argument("--format", choices=("parquet", "jsonl"), help="default: by the path's suffix")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--split-by", choices=("entry", "pair", "line", "content", "text"))
    p.add_argument("--drop-duplicates", action="store_true", help="one row of each SFT text")
    a = ap.parse_args(argv)
    spark = build_session()
    if a.cmd == "generate":
        srcs = [tuple(s.rsplit(":", 1)) if ":" in s else (s, "json") for s in a.source]
        if a.dataset_root:
            srcs += dataset_candidates(a.dataset_root, a.dataset_format)
        cfg = PairConfig(seed=a.seed, noise_std=a.noise_std, noise_shape=a.noise_shape)
        if a.batch_size:
            source = resolve_source(spark, srcs, a.synthetic, spread_rows=True, head=a.sample)
            entries = raw_prefix(source.entries, a.sample) if a.sample else source.entries
            res = generate_in_batches(spark, entries, a.out, cfg, a.batch_size)
        else:
            res = generate(spark, srcs, a.out, cfg, a.sample, a.single_file, a.python_bytes, a.python_lane, a.synthetic, a.rows_per_part)
    else:
        res = prepare(
            spark, a.pairs, a.out, a.kind, a.split_ratio, a.n_eval, a.max_samples, a.seed, a.exact, a.format, a.split_by, a.drop_duplicates
        )
    print(json.dumps(res, default=str))


if __name__ == "__main__":
    main()
