"""Token counts through a cache of digests.

A count depends on a text's content and on the tokenizer alone, so counts are stored in a table
keyed by two digests, that of the normalised content and that of the tokenizer's version, and
found there again in later runs. A run

1. digests every text in the JVM and writes (id, digest, bytes) without the texts,
2. joins the distinct digests to the stored counts of this tokenizer,
3. fetches one text for each digest that has none, encodes it, and appends its count,
4. joins the counts back to the documents by digest.

Texts move once, in step 3, to where they are encoded, dealt by id and digest, so that thousands
of copies of one text do not meet in a task. Partial aggregates see to hot digests in step 2 and
AQE splits them in step 4, a join of two written tables.

The content is normalised only as far as no tokenizer can tell: a null text counts as an empty
one. The tokenizer's version is the digest of its file, its library's name and release, and the
options that change a count. Digests are SHA-256, so texts of equal digest are taken as equal. Runs that
append the same digests at the same time store equal rows, which are read as one.

Defined results: a null text has the empty text's count; equal rows count each; an empty table
gives an empty result and stores nothing; a null id is an id like any other; only the id and the text are read, so
further columns of any name do no harm. Very long texts are encoded whole, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefpairs.llm.common import materialize

#: Bytes of text handed to the library at a time (a longer text goes alone).
CHUNK = 1 << 20
_STORED = "digest binary, n_tokens long, tokenizer string"


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file's bytes and the library that reads it: ``sentencepiece`` or
    ``tokenizers``. Special tokens are never added, and their strings in a text are ordinary text
    where the library's default says so."""

    data: bytes
    library: str

    @classmethod
    def read(cls, path: str) -> Tokenizer:
        with open(path, "rb") as f:
            return cls(f.read(), "sentencepiece" if path.endswith(".model") else "tokenizers")

    @property
    def version(self) -> str:
        release = __import__(self.library).__version__
        return hashlib.sha256(b"\0".join([self.library.encode(), release.encode(), b"no special tokens", self.data])).hexdigest()

    def counter(self):
        """A function from texts to their numbers of tokens."""
        return _counter(self.library, self.data)


@lru_cache(maxsize=2)
def _counter(library: str, data: bytes):
    if library == "sentencepiece":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda texts: [len(ids) for ids in sp.encode(texts, num_threads=1)]
    import tokenizers

    t = tokenizers.Tokenizer.from_buffer(data)
    t.no_truncation()
    t.no_padding()
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if i > lo and held + n > CHUNK:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(texts):
        yield lo, len(texts)


def _count(tokenizer: Tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, done = tokenizer.counter(), set()
        for batch in batches:
            # Rows equal in id and text reach one task; their text is encoded once.
            rows = []
            for i, d in enumerate(batch.column(0).to_pylist()):
                if d not in done:
                    done.add(d)
                    rows.append(i)
            part = batch.take(pa.array(rows, pa.int64()))
            for lo, hi in _chunks(part.column(1)):
                texts = part.column(1).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0).slice(lo, hi - lo), pa.array(count(texts.to_pylist()), pa.int64())], names=["digest", "n_tokens"])

    return run


def stored_counts(spark: SparkSession, cache: str, tokenizer: Tokenizer) -> DataFrame:
    """(digest, n_tokens) of one tokenizer in the cache; none if there is no cache yet."""
    try:
        stored = spark.read.schema(_STORED).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], _STORED)
    return stored.filter(F.col("tokenizer") == tokenizer.version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: Tokenizer, cache: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest, n_bytes, n_tokens, cached) of every document; ``cached``: the count was
    stored before this run. ``cache`` is a folder that all executors share."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(content.cast("binary"), 256))
    keys = materialize(docs.select(F.col(id_col).alias("id"), digest.alias("digest"), F.octet_length(content).cast("long").alias("n_bytes")), "token-keys")
    needed = keys.groupBy("digest").agg(F.min("id").alias("first"))
    known = materialize(needed.join(stored_counts(spark, cache, tokenizer), "digest", "left"), "token-known")
    missing = known.filter("n_tokens IS NULL").select(F.col("digest").alias("_digest"), "first")
    texts = docs.select(F.col(id_col).alias("_id"), digest.alias("digest"), content.alias("text"))
    one = texts.join(missing, F.col("_id").eqNullSafe(F.col("first")) & (F.col("digest") == F.col("_digest")), "left_semi")
    counted = one.select("digest", "text").mapInArrow(_count(tokenizer), "digest binary, n_tokens long")
    # A task that AQE split, or that ran twice, may count a text twice, always alike.
    fresh = materialize(counted, "token-fresh").groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    fresh = materialize(fresh, "token-counted")
    if not fresh.isEmpty():
        fresh.withColumn("tokenizer", F.lit(tokenizer.version)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    hits = known.filter("n_tokens IS NOT NULL").select("digest", "n_tokens", F.lit(True).alias("cached"))
    counts = materialize(hits.unionAll(fresh.select("digest", "n_tokens", F.lit(False).alias("cached"))), "token-counts")
    return keys.join(counts, "digest", "left").select("id", "digest", "n_bytes", "n_tokens", "cached")
