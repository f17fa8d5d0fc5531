"""Training sets and generation counters as files arrive.

The projections and the hash split are functions of a row alone, so a stream splits as a batch
job does. Each micro-batch writes a folder of its own, named by its number: a replay after a
failure writes the same folder again, and a restart goes on with files not seen before. Counters
are kept likewise, one row a batch, and their sums are the totals: no state to restore.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefpairs import constants as K
from prefpairs.operators.pairs import generation_stats
from prefpairs.operators.training import dpo_projection, sft_text, train_eval_split
from prefpairs.schema import PairConfig
from prefpairs.sources.readers import pair_lines_table

#: A batch's folder below the output.
BATCH = "batch_id"


def _run(source: DataFrame, out_path: str, checkpoint: str | None, publish: Callable[[DataFrame, str], None]) -> str:
    root = out_path.rstrip("/")
    query = (
        source.writeStream.foreachBatch(lambda batch, k: publish(batch, f"{root}/{BATCH}={k}"))
        .option("checkpointLocation", checkpoint or root + "-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return out_path


def _stream(spark: SparkSession, folder: str, schema: T.StructType | None, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(folder) if schema is None else reader.schema(schema).parquet(folder)


def run_prepare_stream(
    spark: SparkSession,
    folder: str,
    out_path: str,
    kind: str = "sft",
    split_ratio: float = K.DEFAULT_SPLIT_RATIO,
    seed: int = K.DEFAULT_SEED,
    fmt: str = "parquet",
    split_by: str | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
) -> str:
    """SFT or DPO rows with their split, from every file under ``folder`` not seen before.

    ``fmt`` ``parquet`` reads pair tables with entry_id and strategy_ord and splits by entry,
    ``jsonl`` reads pair lines and splits by content, as ``plans.job.prepare`` does; a line
    that is no pair fails the batch. ``read_prepared`` reads the result. What needs all rows at once (a
    limit, an exact size, one row of each text) is for the batch job.
    """
    if fmt not in ("parquet", "jsonl") or kind not in ("sft", "dpo"):
        raise ValueError("fmt must be 'parquet' or 'jsonl', kind 'sft' or 'dpo'")
    schema = spark.read.parquet(folder).schema if fmt == "parquet" else None
    keep = ("entry_id", "strategy_ord") if fmt == "parquet" else ()
    key = split_by or ("entry" if keep else "content")

    def publish(batch: DataFrame, path: str) -> None:
        pairs = batch
        if fmt == "jsonl":
            stop = F.raise_error(F.concat(F.lit("line is no pair: "), F.col("fault"))).cast("string")
            pairs = pair_lines_table(batch).select(*[F.coalesce(F.when(F.col("fault").isNotNull(), stop), F.col(c)).alias(c) for c in ("prompt", "chosen", "rejected")])
        content = ("prompt", "chosen") if kind == "sft" and key == "content" else ()
        rows = sft_text(pairs, (*keep, *content)) if kind == "sft" else dpo_projection(pairs, keep)
        out = train_eval_split(rows, split_ratio, seed, key).drop(*content)
        out.write.mode("overwrite").partitionBy("split").parquet(path)

    return _run(_stream(spark, folder, schema, max_files_per_trigger), out_path, checkpoint, publish)


def read_prepared(spark: SparkSession, out_path: str) -> DataFrame:
    """The rows of all batches with their split."""
    return spark.read.parquet(out_path).drop(BATCH)


def run_counts_stream(
    spark: SparkSession,
    folder: str,
    out_path: str,
    to_entries: Callable[[DataFrame], DataFrame],
    cfg: PairConfig = PairConfig(),
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
) -> str:
    """Generation counters of every Parquet file of raw records under ``folder`` not seen
    before, one row a batch; ``total_counts`` sums them."""
    schema = spark.read.parquet(folder).schema

    def publish(batch: DataFrame, path: str) -> None:
        generation_stats(to_entries(batch), cfg).write.mode("overwrite").parquet(path)

    return _run(_stream(spark, folder, schema, max_files_per_trigger), out_path, checkpoint, publish)


def total_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """One row: the counters of all batches so far."""
    counts = spark.read.parquet(out_path).drop(BATCH)
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts.columns])
