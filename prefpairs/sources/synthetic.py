"""Synthetic entries: row i takes instruction i % 6 and action i % 6 (both fixed lists);
the user message is already prompt-wrapped, as in the original generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefpairs import constants as K
from prefpairs.sources.adapters import message


def _pick(values: tuple[str, ...], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(i, F.lit(len(values))) + 1).cast("int"))


def synthetic_entries_from_ids(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """ENTRY rows for every id of ``ids`` (the id is both entry_id and the list index)."""
    i = F.col(id_col).cast("bigint")
    instruction = _pick(K.SYNTHETIC_INSTRUCTIONS, i)
    user = F.concat(F.lit(K.PROMPT_PREFIX), instruction, F.lit(K.PROMPT_SUFFIX))
    conversations = F.array(message("user", user), message("assistant", _pick(K.SYNTHETIC_ACTIONS, i)))
    return ids.select(i.alias("entry_id"), conversations.alias("conversations"))


def synthetic_entries(spark: SparkSession, n: int, num_partitions: int | None = None) -> DataFrame:
    """``n`` synthetic entries with ids 0..n-1 (the fallback source)."""
    return synthetic_entries_from_ids(spark.range(0, n, 1, num_partitions))
