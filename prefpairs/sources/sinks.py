"""Sinks: pair JSON lines, the internal pair table, and a peek at the first rows."""

from __future__ import annotations

import functools
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefpairs.session import scratch_path


def jsonl_view(pairs: DataFrame) -> DataFrame:
    """The three on-disk columns in their fixed key order; metadata is dropped."""
    return pairs.select("prompt", "chosen", "rejected")


def _dumps_rows(prompt: pd.Series, chosen: pd.Series, rejected: pd.Series) -> pd.Series:
    keys = ("prompt", "chosen", "rejected")
    return pd.Series([json.dumps(dict(zip(keys, row))) for row in zip(prompt, chosen, rejected)], dtype=object)


@functools.cache
def _dumps_udf():
    # Built on first use: a pandas UDF needs an active session to be created.
    return F.pandas_udf(_dumps_rows, "string")


def python_json_lines(pairs: DataFrame) -> DataFrame:
    """Lines formatted by ``json.dumps`` exactly as the original writes them (", " and
    ": " separators, non-ASCII escaped), in an Arrow-batched pandas UDF."""
    return pairs.select(_dumps_udf()(F.col("prompt"), F.col("chosen"), F.col("rejected")).alias("value"))


def write_jsonl(
    pairs: DataFrame,
    path: str,
    single_file: bool = False,
    python_bytes: bool = False,
    max_records_per_file: int | None = None,
    compression: str | None = None,
) -> str:
    """Write pairs as JSON lines (overwrite; parents are created by the writer).

    Output is a folder of part files written in parallel; ``max_records_per_file``
    bounds their size and ``compression`` (e.g. ``zstd``, ``gzip``) compresses them, and
    both readers here decompress transparently. ``single_file`` funnels all rows through
    one task and is meant for small outputs only. By default Spark writes compact JSON
    (no spaces, non-ASCII kept): equal as JSON to the original, not as bytes.
    ``python_bytes`` writes the original's exact bytes instead, through a vectorised
    Python formatter (slower; use when files are compared byte for byte).
    """
    out = python_json_lines(pairs) if python_bytes else jsonl_view(pairs)
    if single_file:
        out = out.coalesce(1)
    writer = out.write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if compression:
        writer = writer.option("compression", compression)
    if python_bytes:
        writer.text(path)
    else:
        writer.option("ignoreNullFields", "false").json(path)
    return path


#: More bytes than any file has: a scan with splits that long gives every file to one task.
_WHOLE_FILES = str(1 << 50)
#: Rows that a task ranges, sorts and writes as lines.
_ROWS_PER_FILE = 250_000


def write_jsonl_ordered(
    pairs: DataFrame, path: str, order: tuple[str, ...] = ("entry_id", "strategy_ord"), rows_per_part: int = 1_000_000, python_bytes: bool = False
) -> DataFrame:
    """Write pairs as JSON lines in generation order, in parts of about ``rows_per_part`` lines
    that many tasks write, and return the manifest: (part, rows, before, and the first key of each part).

    Part follows part: the files in path order, which is the order of the manifest, are the lines
    of one ordered file. The pairs are written once, ranged by ``order``, equal keys by their
    content, into files of many parts, and each part takes its lines from such a file by their
    numbers: tasks, shuffle blocks and sampled keys follow the rows, not the number of parts. The
    ranged rows are written before the lines, so that a lost executor cannot range them
    otherwise. The manifest stands beside the parts in ``_manifest``, which readers of the lines
    pass over.
    """
    spark = pairs.sparkSession
    keys = [*order, "_tie"]
    table, staged = scratch_path(spark, "keyed-pairs"), scratch_path(spark, "ordered-pairs")
    keyed = pairs.select(*order, F.xxhash64("prompt", "chosen", "rejected").alias("_tie"), "prompt", "chosen", "rejected")
    keyed.write.parquet(table)
    written = spark.read.schema(keyed.schema).parquet(table)
    n = written.count()
    files = max(1, -(-n // _ROWS_PER_FILE), min(-(-n // rows_per_part), spark.sparkContext.defaultParallelism))
    ranged = written.repartitionByRange(files, *keys).sortWithinPartitions(*keys).withColumn("_range", F.spark_partition_id())
    ranged.write.option("maxRecordsPerFile", 0).parquet(staged)  # a range is one file, and its rows are numbered there
    whole = spark.newSession()
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        whole.conf.set(setting, _WHOLE_FILES)
    lines = whole.read.schema(ranged.schema).parquet(staged)
    # A row a range, so windows over all of them are small. A range of _n rows has _k parts.
    ranges = lines.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).withColumn("_k", F.ceil(F.col("_n") / rows_per_part))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(name) for c, name in (("_k", "_part0"), ("_n", "_before"))]
    placed = lines.withColumn("_row", F.col("_metadata.row_index")).join(F.broadcast(ranges.select("_range", "_n", "_k", *sums)), "_range")
    placed = placed.withColumn("_p", F.expr("_row * _k div _n"))
    placed = placed.withColumn("part", F.lpad((F.col("_part0") + F.col("_p")).cast("string"), 7, "0"))
    parts = placed.sortWithinPartitions("part", "_row")
    if python_bytes:
        value = _dumps_udf()(F.col("prompt"), F.col("chosen"), F.col("rejected")).alias("value")
        parts.select("part", value).write.mode("overwrite").partitionBy("part").text(path)
    else:
        parts.select("part", "prompt", "chosen", "rejected").write.mode("overwrite").partitionBy("part").option("ignoreNullFields", "false").json(path)
    first, end = F.expr("(_p * _n + _k - 1) div _k"), F.expr("((_p + 1) * _n + _k - 1) div _k")
    heads = placed.filter(F.col("_row") == first)
    manifest = heads.select("part", (end - F.col("_row")).alias("rows"), (F.col("_before") + F.col("_row")).alias("before"), *order)
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")
    return read_manifest(spark, path, manifest.schema)


def read_manifest(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The manifest of ordered parts, in order."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(f"{path}/_manifest").orderBy("part")


def write_pairs_table(pairs: DataFrame, path: str, max_records_per_file: int | None = None) -> str:
    """Pairs with metadata as Parquet, partitioned by a top-level copy of the strategy so
    a one-strategy read prunes partitions."""
    writer = pairs.withColumn("rejection_strategy", F.col("metadata.rejection_strategy")).write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.partitionBy("rejection_strategy").parquet(path)
    return path


def peek(df: DataFrame, order_cols: list[str], n: int = 3, pretty: bool = True) -> DataFrame:
    """The first ``n`` rows by ``order_cols`` rendered as (pretty) JSON, in order."""
    head = df.orderBy(*order_cols).limit(n)  # a handful of rows: plain top-k
    body = F.to_json(F.struct(*[c for c in df.columns if c not in order_cols]), {"pretty": "true"} if pretty else {})
    return head.select(*order_cols, body.alias("json")).orderBy(*order_cols)


def preview(df: DataFrame, order_cols: list[str], n: int = 1, width: int = 80) -> DataFrame:
    """The first ``n`` rows by ``order_cols`` with every string column cut to ``width``
    characters (whole rows are never materialised on the driver; only these n)."""
    head = df.orderBy(*order_cols).limit(n)
    cols = [
        F.substring(F.col(f.name), 1, width).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name)
        for f in df.schema.fields
    ]
    return head.select(*cols).orderBy(*order_cols)
