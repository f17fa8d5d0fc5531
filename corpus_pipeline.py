"""Corpus pipeline: documents through five stages, each calling one operator of
``prefpairs.llm``.

Each stage takes (spark, docs, sf_dir) and works on every row that its predecessor kept; all
but the last return the columns of documents. ``run`` writes each stage's result as Parquet in
the shared folder and reads it again as the next one's docs, so a lost executor costs the
stage at hand only, and every stage sees rows that no longer change.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefpairs.llm import line_dedup, mixing, pieces, quality, simhash
from prefpairs.llm.common import filter_after, materialize, table

#: Words from which a repeated line goes whatever stands beside it.
LONG_LINE = 50


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose source is not rejected."""
    return quality.quality_filter(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines and later copies of long lines; n_chars
    follows the text. A document of which nothing is left goes, as all of it stands elsewhere."""
    out = line_dedup.line_dedup(docs, long=LONG_LINE)
    left = (F.col("_ld_removed") == 0) | (F.col("_ld_removed") < F.col("_ld_lines"))
    n_chars = F.when(F.col("_ld_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return filter_after(out, left).withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and whether the ids decode to the text again."""
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    out = pieces.encode(docs.select("doc_id", "source", "text"), model, keep=["doc_id", "source"], round_trip=True)
    return out.select("doc_id", "source", F.size("_sp_ids").cast("long").alias("n_tokens"), F.col("_sp_ids").alias("ids"), F.col("_sp_same").alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: The fingerprints and the piece encoding have no SQL form; tests hold run() against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
