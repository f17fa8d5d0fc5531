"""Pair generation: one valid entry -> one row per selected rejection strategy.

The plan is scan -> project (extract, parse) -> filter -> project (prompt, chosen,
strategy inputs such as the noise) -> Generate(inline) -> project (rejected), all in one
stage with no shuffle. The generator only multiplies rows by a constant array of
(strategy_ord, strategy); each pair row then builds its own rejected action, so the
entry is parsed once for all strategies and unread rejections are pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefpairs import constants as K
from prefpairs.operators.entries import parse_entries, valid_entries
from prefpairs.operators.prefix import first_n_predicate, kth_smallest
from prefpairs.operators.rejections import chosen_action, get_strategy
from prefpairs.schema import PairConfig

_WRAPPED = r"(?s)^<image>\nUser: (.*)\nModel:$"


def build_prompt(instruction: Column, unwrap: bool = False) -> Column:
    """``<image>\\nUser: {instruction}\\nModel:``. By default an already wrapped
    instruction is wrapped again, as the original output does; ``unwrap`` strips one
    existing wrapper first."""
    inst = F.regexp_replace(instruction, _WRAPPED, "$1") if unwrap else instruction
    return F.concat(F.lit(K.PROMPT_PREFIX), inst, F.lit(K.PROMPT_SUFFIX))


def pairs_from_parsed(parsed: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """PARSED rows (valid only) -> pair rows.

    Columns: entry_id, strategy_ord (INT, emission order), prompt, chosen, rejected,
    metadata struct<action_type, rejection_strategy, source>, and ``batch`` if the rows have one.
    """
    keep = [c for c in ("batch",) if c in parsed.columns]
    strategies = [(name, get_strategy(name)) for name in cfg.strategies]
    df = parsed.select(
        "entry_id",
        "action_type",
        "x",
        "y",
        "text",
        build_prompt(F.col("instruction"), cfg.unwrap_prompt).alias("prompt"),
        chosen_action().alias("chosen"),
        *keep,
    )
    for _, st in strategies:
        if st.prepare is not None:
            df = st.prepare(df, cfg)
    # The generator only multiplies rows; each pair row then builds its own strategy's
    # rejected action. A consumer that does not read `rejected` (prefix keys, SFT text)
    # lets column pruning drop the noise and the formatting altogether.
    variants = F.array(
        *[
            F.struct(F.lit(i).alias("strategy_ord"), F.lit(name).alias("rejection_strategy"))
            for i, (name, _) in enumerate(strategies)
        ]
    )
    rejected = None
    for i, (_, st) in enumerate(strategies):
        cond = F.col("strategy_ord") == F.lit(i)
        rejected = F.when(cond, st.rejected(cfg)) if rejected is None else rejected.when(cond, st.rejected(cfg))
    out = df.select(*df.columns, F.inline(variants)).select(
        "entry_id", "action_type", "prompt", "chosen", "strategy_ord", "rejection_strategy", rejected.alias("rejected"), *keep
    )
    if cfg.drop_degenerate:
        out = out.filter(F.col("rejected") != F.col("chosen"))
    return out.select(
        "entry_id",
        "strategy_ord",
        "prompt",
        "chosen",
        "rejected",
        F.struct(
            "action_type",
            "rejection_strategy",
            F.lit(cfg.source).alias("source"),
        ).alias("metadata"),
        *keep,
    )


def generate_pairs(entries: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """ENTRY rows -> pair rows (see ``pairs_from_parsed``)."""
    return pairs_from_parsed(valid_entries(entries), cfg)


def flatten_pairs(pairs: DataFrame) -> DataFrame:
    """Pair rows with the metadata struct spread into top-level columns."""
    return pairs.select(
        "entry_id",
        F.col("strategy_ord").cast("bigint").alias("strategy_ord"),
        "prompt",
        "chosen",
        "rejected",
        F.col("metadata.action_type").alias("action_type"),
        F.col("metadata.rejection_strategy").alias("rejection_strategy"),
        F.col("metadata.source").alias("source"),
    )


def raw_prefix(entries: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` raw entries by ``entry_id`` (``None``/0 = all)."""
    if not n:
        return entries
    return entries.filter(first_n_predicate(entries, ["entry_id"], n))


def slice_entries(entries: DataFrame, first_id: int, last_id: int) -> DataFrame:
    """Entries with ``first_id <= entry_id <= last_id`` (batch-by-range processing); the
    predicate reaches the Parquet scan when ids come from a column there."""
    return entries.filter(F.col("entry_id").between(first_id, last_id))


def cap_valid(parsed_valid: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` *valid* entries by ``entry_id`` (applied before pair expansion)."""
    if not n:
        return parsed_valid
    return parsed_valid.filter(first_n_predicate(parsed_valid, ["entry_id"], n))


def generation_stats(
    entries: DataFrame, cfg: PairConfig = PairConfig(), valid_cap: int | None = None
) -> DataFrame:
    """One row: ``skipped_invalid``, ``pairs_spatial``, ``pairs_logical``.

    With ``valid_cap`` the counters stop where the generator stops: at the cap-th
    valid entry (skips after it are not seen).
    """
    parsed = parse_entries(entries).select("entry_id", "skip_reason")
    if valid_cap:
        ok = parsed.filter(F.col("skip_reason").isNull())
        rank = kth_smallest(ok, "entry_id", valid_cap)
        if rank is not None:
            parsed = parsed.filter(F.col("entry_id") <= F.lit(rank.value))
    valid = F.col("skip_reason").isNull()
    per_strategy = {
        name: (F.count_if(valid) if name in cfg.strategies else F.lit(0).cast("bigint"))
        for name in (K.SPATIAL, K.LOGICAL)
    }
    return parsed.agg(
        F.count_if(~valid).alias("skipped_invalid"),
        per_strategy[K.SPATIAL].alias("pairs_spatial"),
        per_strategy[K.LOGICAL].alias("pairs_logical"),
    )


def skip_reasons(entries: DataFrame) -> DataFrame:
    """Entries per outcome (NULL reason = valid)."""
    return parse_entries(entries).groupBy("skip_reason").agg(F.count(F.lit(1)).alias("entries"))
