"""Byte-pair encoding over pieces, by a table of each prefix's last token.

A merge-type vocabulary gives every text one encoding, and the encoding of every prefix of
a text has one last token. That token is found without replaying the merges: an automaton
lists the pieces that end at each position, and a piece is the last token of the prefix if
it is compatible with the last token of the shorter prefix before it, that is, if the two
side by side encode to themselves. The table is filled from left to right, and the ids are
read from it backwards. Characters that no piece covers become their bytes' tokens.

The model file follows the SentencePiece format: white space is written as U+2581, a dummy
one is put in front, and a piece continues over no word start, so the table is filled by
segments (between places that no piece spans) and equal segments are encoded once while
they stay in a bounded cache.

Encoding and the test of the round trip are one pass in one worker. Decoding alone needs the
pieces' bytes only and builds neither automaton nor caches.

Defined results: a null or empty text has no ids; null ids decode to the empty text; an id that is
out of range, negative or null is an error; equal rows are encoded each; an empty table gives an
empty result. Working columns are prefixed ``_sp_``; all columns of the input, or those asked for,
are returned, whatever their names.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
#: Segments and pairs remembered by a worker; the oldest half goes when full.
SEGMENTS = 300_000
PAIRS = 500_000
#: Score of the white-space runs, the only pieces that share one.
TIED = -1e9
_BYTE = -1
_INTS = [struct.Struct(f"<{n}i") for n in range(64)]
#: Marks that a segment is cut at, where no piece spans the cut.
MARKS = ".,;:!?\n"


def _parse(proto: bytes):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(proto)
    return m


class Decoder:
    """The bytes that each id stands for."""

    def __init__(self, m):
        self.bytes_of: list[bytes] = []
        for p in m.pieces:
            if p.type == 1:
                self.bytes_of.append(p.piece.replace(SPACE, " ").encode())
            elif p.type == 6:
                self.bytes_of.append(bytes([int(p.piece[3:5], 16)]))
            else:
                self.bytes_of.append(" ⁇ ".encode() if p.type == 2 else b"")

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """Text of ids; bytes that form no UTF-8 become U+FFFD one by one."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.bytes_of)):
            raise ValueError(f"ids out of range: {ids.min()} to {ids.max()}, of {len(self.bytes_of)} pieces")
        text = _decode(b"".join(map(self.bytes_of.__getitem__, ids.tolist())))
        return text[1:] if text[:1] == " " else text


class Model:
    """Pieces, scores and byte tokens of a model file."""

    def __init__(self, proto: bytes):
        m = _parse(proto)
        spec = m.normalizer_spec
        plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        if m.trainer_spec.model_type != 2 or not m.trainer_spec.byte_fallback or not plain:
            raise ValueError("only merge-type models with byte fallback and plain normalisation are supported")
        self.ids: dict[str, int] = {}
        self.score: list[float] = []
        self.decoder = Decoder(m)
        self.byte_ids = [0] * 256
        self.bound = True
        for i, p in enumerate(m.pieces):
            self.score.append(p.score)
            if p.type == 1:
                self.ids[p.piece] = i
                self.bound &= SPACE not in p.piece.lstrip(SPACE) and not re.match(f"{SPACE}{{2,}}[^{SPACE}]", p.piece)
            elif p.type == 6:
                self.byte_ids[int(p.piece[3:5], 16)] = i
            elif p.type not in (2, 3):
                raise ValueError("user-defined pieces are not supported")
        if not self.bound:
            raise ValueError("a piece continues over a word start")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.cut = self._cuts().findall
        self.piece_of = {i: p for p, i in self.ids.items()}
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.segments = _Segments(self)

    def _cuts(self) -> re.Pattern:
        """Segments: cut before white space, before a mark that no piece joins to the
        character in front of it, and after a line break if no piece goes on after one."""
        joined: dict[str, set[str]] = {c: set() for c in MARKS}
        for piece in self.ids:
            for a, b in zip(piece, piece[1:], strict=False):
                if b in joined:
                    joined[b].add(a)
        other = f"[^{SPACE}{re.escape(MARKS)}]*"
        goes_on = "".join(f"|(?<=[{re.escape(''.join(sorted(before)))}]){re.escape(c)}{other}" for c, before in joined.items() if before)
        rest = f"{other}(?:{goes_on[1:]})*" if goes_on else other
        alone = "" if any("\n" in p[:-1] for p in self.ids) else "\n|"
        return re.compile(f"{alone}(?:{SPACE}+|[^{SPACE}]){rest}")

    def merged(self, text: str, until: str | None = None) -> list[str]:
        """Encoding of a short text by its merges: best score first, then leftmost; the
        parts before the merge that makes ``until``, if one does."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if at < 0 or parts[at] + parts[at + 1] == until:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def split(self, a: int) -> tuple[int, int] | None:
        """The two pieces that a piece's last merge joins; None for a single character."""
        if a not in self.splits:
            parts = self.merged(self.piece_of[a], until=self.piece_of[a])
            self.splits[a] = (self.ids[parts[0]], self.ids[parts[1]]) if len(parts) == 2 else None
        return self.splits[a]

    def compatible(self, a: int, b: int) -> bool:
        """Whether two pieces side by side stay as they are.

        The merges are undone from the last: while one piece is still in parts, its part at
        the border must not have a better merge across it. Of equal scores the left merge
        comes first.
        """
        key = a << 20 | b
        if len(self.pairs) >= PAIRS:
            _forget(self.pairs)
        if self.score[a] == TIED or self.score[b] == TIED:
            left, right = self.piece_of[a], self.piece_of[b]
            self.pairs[key] = self.merged(left + right) == [left, right]
            return self.pairs[key]
        least, inner = -math.inf, True  # score that a merge across must beat
        while True:
            across = self.ids.get(self.piece_of[a] + self.piece_of[b])
            if across is not None and (self.score[across] > least or inner and self.score[across] == least):
                self.pairs[key] = False
                return False
            left, right = self.split(a), self.split(b)
            if left is None and right is None:
                self.pairs[key] = True
                return True
            if right is None or left is not None and self.score[a] < self.score[b]:
                least, inner, a = self.score[a], False, left[1]
            else:
                least, inner, b = self.score[b], True, right[0]

    def stands(self, a: int) -> bool:
        """Whether a piece alone encodes to itself."""
        known = self.whole.get(a)
        if known is None:
            known = self.whole[a] = self.merged(self.piece_of[a]) == [self.piece_of[a]]
        return known

    def segment(self, text: str) -> bytes:
        """Ids of one segment, as packed 32-bit integers."""
        n = len(text)
        last = [_BYTE] * (n + 1)  # token that ends the prefix of each length
        size = [1] * (n + 1)
        known = self.pairs.get
        # Matches come by their end, so the shorter prefix is always settled.
        for end, (token, length) in self.automaton.iter(text):
            if last[end + 1] != _BYTE:
                continue
            before = last[end + 1 - length]
            fits = self.stands(token) if before == _BYTE else known(before << 20 | token)
            if fits or fits is None and self.compatible(before, token):
                last[end + 1], size[end + 1] = token, length
        out, at = [], n
        while at:
            token = last[at]
            if token == _BYTE:
                out += [self.byte_ids[x] for x in reversed(text[at - 1].encode())]
            else:
                out.append(token)
            at -= size[at]
        return _INTS[len(out)].pack(*out[::-1]) if len(out) < len(_INTS) else np.array(out[::-1], np.int32).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as packed 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self.segments.__getitem__, self.cut(SPACE + text.replace(" ", SPACE))))

    def decode(self, ids: np.ndarray | list[int]) -> str:
        return self.decoder.decode(ids)


def _decode(data: bytes) -> str:
    out = []
    while True:
        try:
            return "".join([*out, data.decode()])
        except UnicodeDecodeError as e:
            out += [data[: e.start].decode(), "�"]
            data = data[e.start + 1 :]


def _forget(cache: dict) -> None:
    """Drop the older half of a cache."""
    for key in list(cache)[: len(cache) // 2]:
        del cache[key]


class _Segments(dict):
    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, text: str) -> bytes:
        ids = self.model.segment(text)
        if len(text) <= 64:
            if len(self) >= SEGMENTS:
                _forget(self)
            self[text] = ids
        return ids


@lru_cache(maxsize=2)
def _model(proto: bytes) -> Model:
    return Model(proto)


@lru_cache(maxsize=2)
def _decoder(proto: bytes) -> Decoder:
    return Decoder(_parse(proto))


def _offsets(lengths: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


def _encode(proto: bytes, at: int, keep: list[int], round_trip: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(proto)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                texts = [t or "" for t in part.column(at).to_pylist()]
                packed = [np.frombuffer(model.encode(t), np.int32) for t in texts]
                ids = pa.ListArray.from_arrays(_offsets([len(p) for p in packed]), pa.array(np.concatenate([np.empty(0, np.int32), *packed])))
                columns = [*(part.column(k) for k in keep), ids]
                if round_trip:
                    columns.append(pa.array([model.decode(p) == t for p, t in zip(packed, texts, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[*(part.schema.names[k] for k in keep), "_sp_ids", "_sp_same"][: len(columns)])

    return run


def _decoded(proto: bytes, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(proto)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                ids = [x.values if x.is_valid else pa.array([], pa.int32()) for x in part.column(at)]
                if any(x.null_count for x in ids):
                    raise ValueError("a null id")
                texts = [decoder.decode(x.to_numpy()) for x in ids]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "_sp_text"])

    return run


def encode(docs: DataFrame, proto: bytes, text: str = "text", keep: list[str] | None = None, round_trip: bool = False) -> DataFrame:
    """``docs`` (its columns ``keep``, by default all) with ``_sp_ids`` (array of int), the ids
    of the whole text, and with ``round_trip`` also ``_sp_same``: whether they decode to it."""
    at = [docs.columns.index(c) for c in (docs.columns if keep is None else keep)]
    fields = [*(docs.schema.fields[k] for k in at), T.StructField("_sp_ids", T.ArrayType(T.IntegerType()))]
    if round_trip:
        fields.append(T.StructField("_sp_same", T.BooleanType()))
    return docs.mapInArrow(_encode(proto, docs.columns.index(text), at, round_trip), T.StructType(fields))


def decode(docs: DataFrame, proto: bytes, ids: str = "_sp_ids") -> DataFrame:
    """``docs`` with ``_sp_text``: the text of the ids."""
    schema = T.StructType([*docs.schema.fields, T.StructField("_sp_text", T.StringType())])
    return docs.mapInArrow(_decoded(proto, docs.columns.index(ids)), schema)


def read_model(path: str) -> bytes:
    """The model file's bytes, shipped to the tasks with the function (0.5 MB)."""
    with open(path, "rb") as f:
        return f.read()


def digests(docs: DataFrame, ids: str = "_sp_ids") -> DataFrame:
    """``docs`` with n_tokens and ids_sha256 (digest of the decimal ids joined by commas)."""
    return docs.withColumns({"n_tokens": F.size(ids).cast("long"), "ids_sha256": F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256)})
