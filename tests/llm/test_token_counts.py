"""Token counts against the libraries, and the cache's own properties."""

import collections

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from conftest import SF001
from pyspark.sql import functions as F

from prefpairs.llm import queries, token_counts
from prefpairs.llm.common import table
from prefpairs.llm.token_counts import Tokenizer

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return Tokenizer.read(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def _want(rows, library):
    return collections.Counter((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows)


def _got(rows):
    return collections.Counter((r.id, r.n_bytes, r.n_tokens) for r in rows)


def test_query_matches_library(spark, library):
    rows = [tuple(r) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    out = queries.op13_token_counts(spark, SF001)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    out = out.collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in out) == _want(rows, library)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in out)


def test_odd_rows(spark, tmp_out, awkward, clashing, empty, pieces, library):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    rows += [(30, "<s> </s> <unk> <0x41>"), (31, "a" * 70_000), (32, "▁ ▁▁  two  spaces ")]
    df = awkward.select("doc_id", "text").unionAll(spark.createDataFrame(rows[-3:], "doc_id long, text string"))
    assert _got(token_counts.token_counts(df, pieces, f"{tmp_out}/a").collect()) == _want(rows, library)
    wide = clashing.withColumns({c: F.lit(1) for c in ("digest", "n_tokens", "n_bytes", "cached", "tokenizer", "_digest", "_id", "first")})
    assert _got(token_counts.token_counts(wide, pieces, f"{tmp_out}/b").collect()) == _want(rows[:-3], library)
    assert token_counts.token_counts(empty, pieces, f"{tmp_out}/c").collect() == []


def _stored(spark, cache):
    return spark.read.parquet(cache)


def test_second_run_encodes_misses_only(spark, tmp_out, pieces, library, monkeypatch):
    first = [(k, f"text number {k % 7} of the first run") for k in range(50)]
    more = first + [(99, "a new text"), (98, "a new text"), (97, None), (96, "")]
    schema, cache = "doc_id long, text string", f"{tmp_out}/cache"
    out = token_counts.token_counts(spark.createDataFrame(first, schema), pieces, cache).collect()
    assert _got(out) == _want(first, library) and not any(r.cached for r in out)
    assert _stored(spark, cache).count() == 7
    out = token_counts.token_counts(spark.createDataFrame(more, schema), pieces, cache).collect()
    assert _got(out) == _want(more, library)
    assert {r.id for r in out if not r.cached} == {96, 97, 98, 99}
    assert _stored(spark, cache).count() == 9  # of the empty text and the null one there is one count
    before = _stored(spark, cache).inputFiles()

    def never(tokenizer):
        def run(batches):
            for b in batches:
                if b.num_rows:
                    raise AssertionError("a stored text was encoded")
                yield b

        return run

    monkeypatch.setattr(token_counts, "_count", never)
    out = token_counts.token_counts(spark.createDataFrame(more, schema), pieces, cache).collect()
    assert _got(out) == _want(more, library) and all(r.cached for r in out)
    assert _stored(spark, cache).inputFiles() == before  # nothing is appended either


def test_tokenizers_do_not_share_counts(spark, tmp_out, pieces):
    bytewise = Tokenizer.read(public_tokenizers.path("byte_bpe_50k.json"))
    assert bytewise.version != pieces.version
    texts = ["one text", "Ünïcödé 😀", "", "<|endoftext|> inside"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_counts.token_counts(df, pieces, tmp_out).count()
    out = token_counts.token_counts(df, bytewise, tmp_out).collect()
    assert not any(r.cached for r in out)
    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.id: r.n_tokens for r in out} == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}
    assert _stored(spark, tmp_out).select("tokenizer").distinct().count() == 2


def test_rows_stored_twice_count_once(spark, tmp_out, pieces, library):
    """Two runs that ran at the same time both appended their counts."""
    rows = [(k, f"t {k}") for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    token_counts.token_counts(df, pieces, tmp_out).count()
    twice = _stored(spark, tmp_out).select("digest", "n_tokens", "tokenizer").collect()
    spark.createDataFrame(twice, "digest binary, n_tokens long, tokenizer string").write.mode("append").partitionBy("tokenizer").parquet(tmp_out)
    assert _got(token_counts.token_counts(df, pieces, tmp_out).collect()) == _want(rows, library)


def test_copies_are_encoded_once(spark, tmp_out, pieces):
    """Rows equal in id and text, and rows equal in text alone."""
    rows = [(1, "the same")] * 40 + [(k, "the same") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = token_counts.token_counts(df, pieces, tmp_out).collect()
    assert len(out) == 80 and len({r.n_tokens for r in out}) == 1
    assert _stored(spark, tmp_out).count() == 1
