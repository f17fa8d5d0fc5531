"""The registered query of each operator: ``opN_<name>(spark, sf_dir)``.

Thin: each applies its operator with production parameters to the whole table and derives
the contract's columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefpairs.llm import line_dedup as ld
from prefpairs.llm import archives, codes, langid, mixing, pieces, pseudonyms, quality, simhash, sketches, spelling, substring, token_counts
from prefpairs.llm.common import materialize, table
from prefpairs.session import scratch_path


#: Key of the registered query; a deployment passes its own.
PSEUDONYM_KEY = b"registered query"
TOKEN_LIMIT = 4096
#: Words from which a repeated line goes whatever stands beside it.
LONG_LINE = 50


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)
    return out.select("doc_id", "text", *(F.col(f"_ps_{k}").alias(f"n_{k}") for k in pseudonyms.KINDS))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ld.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), long=LONG_LINE)
    return out.select("doc_id", F.col("_ld_lines").alias("n_lines"), F.col("_ld_removed").alias("n_removed"), "text")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = archives.through_archives(table(spark, sf_dir, "pages"))
    read = archives.read_warc(spark, path, payload=False).select("type", "record_id", archives.checked_digest().alias("payload_digest"), "refers_to", "head", "payload_bytes")
    out = archives.resolve_revisits(materialize(read, "warc-rows"))
    return out.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("target").alias("refers_to"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    ids = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    out = pieces.decode(pieces.digests(ids).select("doc_id", "_sp_ids", "n_tokens", "ids_sha256"), model)
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("_sp_text", 256).alias("decoded_sha256"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sketches.compare_edits(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.id").alias("component_id"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, ~langid.held_out())
    return langid.identify(docs, model).withColumnRenamed("id", "doc_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_table(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.sampled(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, codebooks = codes.vector_codes(table(spark, sf_dir, "embeddings"))
    digest = F.lit(None if codebooks is None else codes.codebooks_digest(codebooks)).cast("string")
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", digest.alias("codebooks_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spelling.spelling_variants(table(spark, sf_dir, "documents"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A cache of its own: a shared one would make a rerun's work depend on the runs before it.
    tokenizer = token_counts.Tokenizer.read(public_tokenizers.path("piece_bpe_32k.model"))
    out = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer, scratch_path(spark, "token-cache"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_pseudonyms": op1_pii_pseudonyms,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc": op3_warc,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_fingerprints": op5_fingerprints,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_simhash": op7_simhash,
    "op8_language_id": op8_language_id,
    "op9_quality_rules": op9_quality_rules,
    "op10_mixing": op10_mixing,
    "op11_vector_codes": op11_vector_codes,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_counts": op13_token_counts,
}
