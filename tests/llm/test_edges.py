"""Every operator and stage on empty tables and on columns with clashing names."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from prefpairs.llm import archives, langid, line_dedup, mixing, pieces, pseudonyms, quality, simhash, sketches, substring

MODEL = pieces.read_model(corpus_pipeline.public_tokenizers.path("piece_bpe_32k.model"))

OPERATORS = {
    "pseudonyms": lambda d: pseudonyms.pseudonymise(d, b"key"),
    "line_dedup": line_dedup.line_dedup,
    "pieces": lambda d: pieces.decode(pieces.encode(d, MODEL), MODEL),
    "sketches": sketches.compare_edits,
    "substring": substring.substring_dedup,
    "simhash": simhash.near_duplicates,
    "keep_one": simhash.keep_one,
    "langid": lambda d: langid.identify(d, langid.fit(d, ~langid.held_out())),
    "quality": quality.quality_table,
    "quality_filter": quality.quality_filter,
    "mixing": mixing.sampled,
    "mix": mixing.mix,
    "archives": lambda d: archives.resolve_revisits(archives.read_warc(d.sparkSession, archives.through_archives(d, "doc_id", "source", "text"))),
}


def _rows(df):
    return collections.Counter(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(empty, name):
    assert OPERATORS[name](empty).collect() == []


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"archives"}))
def test_clashing_columns(awkward, clashing, name):
    plain, wide = OPERATORS[name](awkward), OPERATORS[name](clashing)
    if set(clashing.columns) <= set(wide.columns):  # operators that return their input's columns
        extra = set(clashing.columns) - set(awkward.columns)
        own = [c for c in wide.columns if c not in extra]
        assert own == plain.columns
        wide = wide.select(*own)
    assert _rows(wide) == _rows(plain)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, empty, clashing, awkward, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, empty, "").collect() == []
    out = stage(spark, clashing, "")
    assert out.count() == stage(spark, awkward, "").count()
    if name != "sentencepiece":
        assert out.columns == clashing.columns


def test_archive_rows(awkward):
    """Null and equal payloads, null and odd URLs, repeated rows."""
    path = archives.through_archives(awkward.withColumn("source", F.concat("source", F.lit(" x\ny"))), "doc_id", "source", "text")
    rows = archives.resolve_revisits(archives.read_warc(awkward.sparkSession, path)).collect()
    assert len(rows) == awkward.count()
    assert all(r.found_digest == r.payload_digest for r in rows if r.type == "response")
    texts = collections.defaultdict(list)
    for r in awkward.collect():
        texts[(r.text or "").encode()].append(r.doc_id)
    assert sum(r.type == "response" for r in rows) == len(texts)
    largest = {k: max((i for i in v if i is not None), default=None) for k, v in texts.items()}
    assert {r.target for r in rows if r.type == "revisit"} == {largest[k] for k, v in texts.items() if len(v) > 1}


def test_damaged_archives_fail(spark):
    """A response is only as good as the bytes read back; a revisit has none."""
    kinds = "type string, record_id string, payload_digest string, found_digest string"
    good = spark.createDataFrame([("response", "a", "X", "X"), ("revisit", "b", "X", "EMPTY")], kinds)
    assert [r[0] for r in good.select(archives.checked_digest()).collect()] == ["X", "X"]
    for bad in (("response", "a", "X", "Y"), ("response", "a", None, "Y")):
        with pytest.raises(Exception, match="differs from its header"):
            spark.createDataFrame([bad], kinds).select(archives.checked_digest()).collect()


def test_ids_that_no_text_has(spark):
    """Negative, large and null ids are errors; null and empty lists are the empty text."""
    ids = lambda rows: spark.createDataFrame(rows, "k int, _sp_ids array<int>")
    assert [r._sp_text for r in pieces.decode(ids([(1, None), (2, [])]), MODEL).collect()] == ["", ""]
    for bad in ([-1], [5, 10**6], [5, None]):
        with pytest.raises(Exception, match="out of range|a null id"):
            pieces.decode(ids([(1, bad)]), MODEL).collect()
    many = pieces.encode(spark.createDataFrame([(1, "a b"), (2, None), (3, "\x00 \U0010ffff▁x")], "k int, text string"), MODEL, keep=["k"], round_trip=True)
    assert many.columns == ["k", "_sp_ids", "_sp_same"]
    assert [(r.k, r._sp_same) for r in many.orderBy("k").collect()] == [(1, True), (2, True), (3, False)]  # that mark is the model's own space
