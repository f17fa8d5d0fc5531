"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is lower-cased, every byte that is no letter becomes a space, and its subwords (byte
runs of 3 and 4, word ends included) are hashed to ``BUCKETS`` rows of an embedding table.
The mean of a text's rows goes through a linear softmax. Embeddings and weights are
trained together by stochastic gradient descent in numpy on a bounded sample: about
``SAMPLE`` texts, as many of each language, at least ``FEWEST`` and at most ``MOST``, the first
different ones by a hash of id and text. Every language is learned, so the sample and
the model grow with their number, but not with the documents. A part of the sample is set aside to calibrate: a temperature is fitted to it,
and the rejection threshold is the lowest confidence above which at least
``PRECISION`` of it is right.

As mean and softmax input are linear, tasks receive one score per bucket and language or, of
more than ``DIM`` languages, the embeddings and the softmax weights, whichever is less; whole
texts are scored, in blocks, in a map without a shuffle.

Defined results: ``und``, score 0 and not accepted for a null text, a text without a
letter, or when nothing could be learned; a null id is held out; repeated rows get the same
result; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefpairs.llm.common import materialize

BUCKETS = 1 << 14
DIM = 16
GRAMS = (3, 4)
SAMPLE = 2_400
#: Texts of a language in the sample.
FEWEST, MOST = 20, 1_000
EPOCHS = 12
RATE = 2.0
PRECISION = 0.99
SEED = 42
UNKNOWN = "und"
#: Bytes scored at a time.
BLOCK = 1 << 20

_KEEP = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def _letters(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").lower().encode().translate(_KEEP)


def _grams(buf: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, bucket, whether it counts) of the subword that starts at each byte."""
    for size in GRAMS:
        n = len(buf) - size + 1
        if n <= 0:
            continue
        code, blanks = np.zeros(n, np.uint32), np.zeros(n, np.uint8)
        for j in range(size):
            part = buf[j : j + n]
            code |= part.astype(np.uint32) << np.uint32(8 * j)
            blanks += part == 32
        h = (code * np.uint32(2654435761)) ^ np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        h *= np.uint32(2246822519)
        # A subword has at least two letters or bytes of letters.
        yield size, (h >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32), blanks <= size - 2


def counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, occurrences) of a whole text."""
    data, total = b" " + _letters(text) + b" ", np.zeros(BUCKETS, np.int64)
    for lo in range(0, len(data), BLOCK):
        # Blocks overlap so that each subword starts in exactly one.
        buf = np.frombuffer(data, np.uint8)[lo : lo + BLOCK + max(GRAMS) - 1]
        for _, bucket, counted in _grams(buf):
            total += np.bincount(bucket[:BLOCK][counted[:BLOCK]], minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at.astype(np.int32), total[at].astype(np.int32)


@dataclass
class Model:
    languages: list[str]
    vectors: np.ndarray  # BUCKETS x languages, or BUCKETS x DIM
    weights: np.ndarray | None  # DIM x languages, or None where the vectors are scores
    bias: np.ndarray
    threshold: float

    def probabilities(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        mean = sums / np.maximum(n, 1)[:, None]
        z = (mean if self.weights is None else mean @ self.weights) + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model | None:
    """``rows`` (language, buckets, occurrences) in a fixed order -> model."""
    rows = [r for r in rows if len(r[1])]
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    rng = np.random.default_rng(SEED)
    y = np.array([languages.index(r[0]) for r in rows])
    weights = [(r[2] / r[2].sum()).astype(np.float32) for r in rows]
    order = rng.permutation(len(rows))
    held = order[: len(rows) // 5]
    fit = order[len(rows) // 5 :]
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps, done = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            rate = np.float32(RATE * (1 - done / steps))
            at, w = rows[i][1], weights[i]
            mean = w @ table[at]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= np.float32(0.1) * rate * p
            # Rows move with their share of the text, scaled up as shares are small.
            table[at] -= rate * np.outer(np.sqrt(w), back)
            done += 1
    logits = lambda part: np.array([weights[i] @ (table[rows[i][1]] @ out) + bias for i in part])
    temperature, threshold = 1.0, 0.0
    if len(held):
        z, t = logits(held), y[held]

        def softmax(temp: float) -> np.ndarray:
            e = np.exp((z - z.max(axis=1, keepdims=True)) / temp)
            return e / e.sum(axis=1, keepdims=True)

        grid = np.geomspace(0.1, 20, 60)
        temperature = float(grid[np.argmin([-np.log(softmax(g)[np.arange(len(t)), t] + 1e-9).mean() for g in grid])])
        p = softmax(temperature)
        best, right = p.max(axis=1), p.argmax(axis=1) == t
        down = np.argsort(-best, kind="stable")
        precise = np.flatnonzero(np.cumsum(right[down]) >= PRECISION * np.arange(1, len(down) + 1))
        threshold = float(best[down][precise[-1]]) if len(precise) else 1.0
    out, bias = (out / temperature).astype(np.float32), (bias / temperature).astype(np.float32)
    if len(languages) > DIM:
        return Model(languages, table, out, bias, threshold)
    return Model(languages, table @ out, None, bias, threshold)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("order", pa.int64()), ("buckets", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))])
    for batch in batches:
        got = [counts(t) for t in batch.column("text").to_pylist()]
        arrays = [batch.column("lang"), batch.column("order"), pa.array([g[0] for g in got], schema.field(2).type), pa.array([g[1] for g in got], schema.field(3).type)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def fit(docs: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Train on the rows of ``docs`` where ``usable``: a hash sample of each language."""
    rows = docs.filter(usable & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"), F.xxhash64(F.lit(SEED), id_col, F.xxhash64(text)).alias("order")
    )
    sizes = materialize(rows.groupBy("lang").agg(F.approx_count_distinct("order").alias("size")), "language-sizes")
    take = min(MOST, max(FEWEST, SAMPLE // max(1, sizes.count())))
    # The hash leaves about twice as many different rows of a language as are taken.
    near = rows.join(sizes, "lang").filter(F.pmod("order", F.col("size")) < 2 * take).dropDuplicates(["lang", "order"])
    first = Window.partitionBy("lang").orderBy("order")
    chosen = near.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= take).select("lang", "order", "text")
    featured = chosen.mapInArrow(_featurise, "lang string, order long, buckets array<int>, n array<int>")
    # At most ``take`` rows a language, each of at most BUCKETS pairs of numbers.
    got = featured.toArrow()
    listed = lambda name: [x.values.to_numpy() for x in got.column(name)]
    rows = list(zip(got.column("lang").to_pylist(), got.column("order").to_pylist(), listed("buckets"), listed("n"), strict=True))
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes(), r[3].tobytes()))
    return train([(lang, buckets, n) for lang, _, buckets, n in rows])


def _predict(model: Model):
    schema = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])

    def scored(texts: list[bytes]) -> np.ndarray:
        """Language probabilities of a few texts."""
        data = [b" " + _letters(t) + b" " for t in texts]
        ends = np.cumsum([len(d) for d in data])
        joined = np.frombuffer(b"".join(data), np.uint8)
        sums, n = np.zeros((len(texts), model.vectors.shape[1])), np.zeros(len(texts))
        for lo in range(0, len(joined), BLOCK):
            for _, bucket, counted in _grams(joined[lo : lo + BLOCK + max(GRAMS) - 1]):
                at = np.flatnonzero(counted[:BLOCK])
                # Blanks at both ends keep subwords from crossing texts: one of two
                # texts' ends is a pair of blanks next to each other.
                doc = np.searchsorted(ends, at + lo, side="right")
                n += np.bincount(doc, minlength=len(texts))
                for c in range(sums.shape[1]):
                    sums[:, c] += np.bincount(doc, weights=model.vectors[bucket[at], c], minlength=len(texts))
        return model.probabilities(sums, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            todo, held = [], 0
            for i, t in enumerate(texts):
                if t is not None:
                    todo.append(i)
                    held += len(t)
                if todo and (held >= BLOCK or i == len(texts) - 1):
                    p = scored([texts[k] for k in todo])
                    for k, row in zip(todo, p, strict=True):
                        best[k], score[k] = model.languages[int(row.argmax())], float(row.max())
                    todo, held = [], 0
            accepted = score >= model.threshold
            arrays = [batch.column("id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(score), pa.array(accepted & np.array([b != UNKNOWN for b in best], bool))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, accepted (score at or above the
    calibrated threshold)."""
    letters = F.when(F.col(text).rlike(r"\p{L}"), F.col(text).cast("binary"))
    src = docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), letters.alias("text"))
    if model is None:
        return src.select("id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    return src.mapInArrow(_predict(model), "id long, held_out boolean, lang_pred string, score double, accepted boolean")
