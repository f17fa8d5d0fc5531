"""Training-set projections and repeatable train/eval splits.

Splits never use ``randomSplit``/``rand``: a row's side is a pure function of
``(seed, key)``, so it survives retries, executor loss and repartitioning. The default
split key is the entry (both pairs of one entry land on the same side, so the duplicated
SFT text cannot leak across the split); ``key="pair"`` splits per pair row as the
original did. Rows without ids (JSON lines) can use ``key="content"``: the two pairs of
an entry share prompt and chosen, so they still land together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefpairs import constants as K
from prefpairs.functions.noise import hash_fraction, keyed_bits48
from prefpairs.operators.prefix import first_n_predicate

SPLIT_SALT = "split"
TRAIN, EVAL = "train", "eval"


def sft_text(pairs: DataFrame, keep: tuple[str, ...] = (), drop_duplicates: bool = False, order: tuple[str, ...] = ()) -> DataFrame:
    """``text = prompt + chosen + <|end_of_turn|>`` (no separator); rejected is unused.

    ``drop_duplicates`` keeps of each text the row that comes first by ``order`` (integral
    columns that tell rows apart), or without an order by the columns kept: a minimum that every
    task takes of its own rows first, so a text that a third of all rows share is one row a task.
    """
    out = pairs.select(*dict.fromkeys([*keep, *order]), F.concat("prompt", "chosen", F.lit(K.END_OF_TURN)).alias("text"))
    if not drop_duplicates:
        return out.select(*keep, "text")
    by = [*order, *(c for c in keep if c not in order)]
    if not by:
        return out.distinct()
    first = out.groupBy("text").agg(F.min(F.struct(*by)).alias("_first"))
    return first.select(*[F.col(f"_first.{c}").alias(c) for c in keep], "text")


def dpo_projection(pairs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly prompt, chosen, rejected (plus ``keep`` columns)."""
    return pairs.select(*keep, "prompt", "chosen", "rejected")


def max_samples(pairs: DataFrame, m: int | None, order: tuple[str, ...] = ("entry_id", "strategy_ord")) -> DataFrame:
    """The first ``m`` pair rows in generation order (``None``/0 = all)."""
    if not m:
        return pairs
    return pairs.filter(first_n_predicate(pairs, list(order), m))


def split_key(key: str = "entry") -> Column:
    if key == "entry":
        return F.col("entry_id")
    if key == "pair":
        return F.concat_ws("-", F.col("entry_id").cast("string"), F.col("strategy_ord").cast("string"))
    if key == "line":  # rows of JSON lines, one by one
        return F.col("line_id")
    if key == "content":  # for rows without ids: both pairs of an entry share prompt+chosen
        return F.sha2(F.concat_ws("\u0001", F.col("prompt"), F.col("chosen")), 256)
    if key == "text":  # of SFT rows: equal texts land together, whichever row stands for them
        return F.sha2(F.col("text"), 256)
    raise ValueError("key must be 'entry', 'pair', 'line', 'content' or 'text'")


def train_eval_split(
    df: DataFrame, ratio: float = K.DEFAULT_SPLIT_RATIO, seed: int = K.DEFAULT_SEED, key: str = "entry"
) -> DataFrame:
    """Adds ``split`` in {train, eval}: train when the keyed fraction is below ``ratio``.
    Sizes are approximate (binomial); see ``split_exact`` for a fixed eval size."""
    frac = hash_fraction(seed, split_key(key), SPLIT_SALT)
    return df.withColumn("split", F.when(frac < F.lit(float(ratio)), F.lit(TRAIN)).otherwise(F.lit(EVAL)))


def eval_count(n_rows: int, ratio: float = K.DEFAULT_SPLIT_RATIO) -> int:
    """Eval rows of a ``train_test_split(test_size=1 - ratio)``: ``ceil(test_size * n)``,
    with ``1 - ratio`` in floating point as the original computes it (20 rows -> 2)."""
    return math.ceil((1.0 - ratio) * n_rows)


def split_exact(
    df: DataFrame,
    n_eval: int,
    seed: int = K.DEFAULT_SEED,
    key: str = "entry",
    tiebreak: tuple[str, ...] = ("entry_id", "strategy_ord"),
) -> DataFrame:
    """Adds ``split`` with exactly ``n_eval`` eval rows: the rows with the largest keyed
    hash (ties by ``tiebreak``). Both sides come from one predicate over the same rows;
    no anti-join and no global sort."""
    rank_col = "_split_rank"
    ranked = df.withColumn(rank_col, F.lit(2**48 - 1) - keyed_bits48(seed, split_key(key), SPLIT_SALT))
    is_eval = first_n_predicate(ranked, [rank_col, *tiebreak], n_eval, head_bounds=(0, 2**48 - 1))
    return ranked.withColumn("split", F.when(is_eval, F.lit(EVAL)).otherwise(F.lit(TRAIN))).drop(rank_col)
