"""Pair generation in batches that resume.

The entries are dealt to batches of neighbouring ids once and written by batch, so that a
batch reads its own rows only. A batch's pairs go to a folder of their own; when they are
committed, the batch is entered in the ledger by a single small file, whose renaming into place
is the commit. What is not in the ledger does not count: a run that was killed is started again
with the same arguments, takes up the same batches, writes the unfinished ones anew and
leaves the finished ones alone.

Batches are written and entered in at most ``ROUNDS`` rounds of neighbouring batches, a job for
each round, so that the number of jobs does not grow with the number of batches and the batches of a round are
written beside each other. A run of up to ``ROUNDS`` batches writes them one by one; a killed run
loses one round at most.
"""

from __future__ import annotations

import os
import re
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefpairs.operators.entries import parse_entries
from prefpairs.operators.pairs import pairs_from_parsed
from prefpairs.schema import PairConfig
from prefpairs.session import listing_session

PLAN = "batch int, n_entries long, first_id long, last_id long, config string"
LEDGER = "batch int, n_entries long, skipped_invalid long"
PAIRS = (
    "entry_id long, strategy_ord int, prompt string, chosen string, rejected string, "
    "metadata struct<action_type: string, rejection_strategy: string, source: string>, batch int"
)
ROUNDS = 16


#: Tasks that write the staged batches, a slot.
_TASKS_A_SLOT = 4


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A table that is there as a whole or not at all: its file is renamed into place."""
    try:
        found = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found if found.inputFiles() else None


def plan_batches(spark: SparkSession, entries: DataFrame, out_dir: str, cfg: PairConfig, batch_size: int) -> DataFrame:
    """Deal ``entries`` to batches of about ``batch_size`` and write the plan behind them, unless
    an earlier run has done so. Entries of one id stay in one batch."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    path, config = os.path.join(out_dir, "plan"), repr(sorted(asdict(cfg).items()))
    if (plan := _table(spark, path, PLAN)) is None:
        n = max(1, -(-entries.count() // batch_size))
        dealt = entries.repartitionByRange(n, "entry_id").withColumn("batch", F.spark_partition_id())
        staged = os.path.join(out_dir, "entries")
        # A task writes several batches, each whole, as a task a batch costs more than its rows.
        dealt.coalesce(_TASKS_A_SLOT * spark.sparkContext.defaultParallelism).write.mode("overwrite").partitionBy("batch").parquet(staged)
        sizes = spark.read.schema(dealt.schema).parquet(staged).groupBy("batch")
        made = sizes.agg(F.count(F.lit(1)).alias("n_entries"), F.min("entry_id").alias("first_id"), F.max("entry_id").alias("last_id"))
        made.withColumn("config", F.lit(config)).coalesce(1).write.mode("overwrite").parquet(path)
        plan = spark.read.schema(PLAN).parquet(path)
    if plan.filter(F.col("config") != config).limit(1).count():
        raise ValueError("the folder holds batches of another configuration")
    return plan


def ledger(spark: SparkSession, out_dir: str) -> DataFrame:
    """(batch, n_entries, skipped_invalid) of the finished batches."""
    found = _table(spark, os.path.join(out_dir, "ledger"), LEDGER)
    return spark.createDataFrame([], LEDGER) if found is None else found.distinct()


def generate_in_batches(
    spark: SparkSession,
    entries: DataFrame,
    out_dir: str,
    cfg: PairConfig = PairConfig(),
    batch_size: int = 50_000,
    max_batches: int | None = None,
) -> dict:
    """Write the pairs of every batch that is not finished, at most ``max_batches`` of them, and
    return the counts of all finished ones. One small row a batch comes to the driver."""
    spark = listing_session(spark)
    plan = plan_batches(spark, entries, out_dir, cfg, batch_size)
    todo = plan.join(ledger(spark, out_dir), "batch", "left_anti").orderBy("batch").select("batch", "n_entries").collect()[:max_batches]
    staged = spark.read.schema(T.StructType(entries.schema.fields).add("batch", T.IntegerType())).parquet(os.path.join(out_dir, "entries"))
    remains = _folders(spark, out_dir) if todo else set()
    size = max(1, -(-len(todo) // ROUNDS))
    for at in range(0, len(todo), size):
        _write_round(spark, staged, out_dir, cfg, dict(todo[at : at + size]), remains)
    total = ledger(spark, out_dir).agg(F.count(F.lit(1)), F.coalesce(F.sum("n_entries"), F.lit(0)), F.coalesce(F.sum("skipped_invalid"), F.lit(0))).first()
    return {"batches": plan.count(), "finished": total[0], "written": len(todo), "entries": total[1], "skipped_invalid": total[2]}


def _folders(spark: SparkSession, out_dir: str) -> set[int]:
    """The batches that have files of pairs, finished or not."""
    found = _table(spark, os.path.join(out_dir, "pairs"), PAIRS)
    return set() if found is None else {int(m[1]) for f in found.inputFiles() if (m := re.search(r"/batch=([0-9]+)/", f))}


def _write_round(spark: SparkSession, staged: DataFrame, out_dir: str, cfg: PairConfig, planned: dict[int, int], remains: set[int]) -> None:
    """Write the pairs of the batches ``planned`` (batch -> entries), then enter them in the ledger.

    The parsed rows of the round are kept (memory, then disk) while they are counted and their
    pairs are written; a lost block is computed again from the staged entries.
    """
    skipped = F.col("skip_reason").isNotNull()
    parsed = parse_entries(staged.filter(F.col("batch").isin(list(planned))), keep=("batch",)).drop("raw_action").persist()
    try:
        pairs = pairs_from_parsed(parsed.filter(~skipped).drop("skip_reason"), cfg)
        counts = parsed.groupBy("batch").agg(F.count(F.lit(1)), F.count_if(skipped)).collect()
        got = {batch: (n, k) for batch, n, k in counts}
        for batch, n in planned.items():
            if got.get(batch, (0, 0))[0] != n:
                raise RuntimeError(f"batch {batch} has {got.get(batch, (0, 0))[0]} entries where {n} were planned")
        # The round replaces the folders of the batches that have pairs; a batch without any must
        # not be left with what an earlier run wrote.
        for batch in remains & planned.keys():
            spark.createDataFrame([], pairs.drop("batch").schema).write.mode("overwrite").parquet(os.path.join(out_dir, "pairs", f"batch={batch}"))
        pairs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(os.path.join(out_dir, "pairs"))
    finally:
        parsed.unpersist()
    done = spark.createDataFrame([(batch, n, got[batch][1]) for batch, n in planned.items()], LEDGER)
    done.coalesce(1).write.mode("append").parquet(os.path.join(out_dir, "ledger"))


def read_batches(spark: SparkSession, out_dir: str) -> DataFrame:
    """The pairs of the finished batches, with their ``batch``."""
    spark = listing_session(spark)
    try:
        pairs = spark.read.parquet(os.path.join(out_dir, "pairs"))
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # batches without a pair have no file
            raise
        pairs = spark.createDataFrame([], PAIRS)
    return pairs.join(ledger(spark, out_dir).select("batch"), "batch", "left_semi")
