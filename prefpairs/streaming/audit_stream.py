"""The JSONL audit as a streaming aggregation: running counters over files as they arrive.

The audit is one global aggregate, so its streaming state is nine numbers. Each
micro-batch writes the complete result to a folder of its own, named by the batch, so a
replay writes the same folder again and a crash leaves the totals of the batch before;
the checkpoint records which files were counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefpairs import constants as K
from prefpairs.operators.audit import audit_lines


def run_audit_stream(
    spark: SparkSession,
    folder: str,
    out_path: str,
    checkpoint: str | None = None,
    canvas: tuple[int, int] = K.DEFAULT_CANVAS,
    max_files_per_trigger: int | None = None,
) -> str:
    """Audit every JSONL file under ``folder`` not seen before (``availableNow``) and
    write the running totals, one row per batch, under ``out_path``; ``latest_totals`` reads
    them."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counters = audit_lines(reader.load(folder), "value", canvas, bare_numbers=True)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    query = (
        counters.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint or out_path.rstrip("/") + "-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"audit stream failed: {query.exception()}")
    return out_path


def latest_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """The one row of totals of the last batch under ``out_path``."""
    totals = spark.read.parquet(out_path)
    return totals.orderBy(F.col("batch_id").desc()).limit(1).drop("batch_id")
