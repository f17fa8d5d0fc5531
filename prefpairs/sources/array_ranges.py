"""JSON array files read in byte ranges by many tasks.

A range cannot tell by itself whether it starts inside a string or how deep it is nested. A
first scan therefore finds, for every range, how many quotes it holds (odd or even) and by how
much it changes the nesting depth under either assumption; sums over the ranges before it
then give its true start. In the second scan a range yields the records whose opening mark, the
array's bracket or a comma between records, lies in it, and reads on past its end until the last
of them is complete. The table between the scans has one small row a range.

Every element of the array is a record. One that is no object, and what is left of a file that
breaks off or goes on behind its array, is a broken record. A file whose root is no array is
one record. Files are UTF-8, with or without a byte order mark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes scanned at a time.
BLOCK = 4 << 20
#: Bytes and records of a batch of output.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 10_000

#: Suffixes of files that cannot be read from the middle.
COMPRESSED = (".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate", ".xz")

_QUOTE, _ESCAPE, _COMMA, _ARRAY, _OBJECT, _END = b'"\\,[{}'
_BLANK = b" \t\r\n"
_BOM = b"\xef\xbb\xbf"
_MARKS = np.zeros(256, bool)
_MARKS[list(b'",[]{}')] = True
_STEP = np.zeros(256, np.int64)
_STEP[list(b"[{")] = 1
_STEP[list(b"]}")] = -1


def can_open(path: str) -> bool:
    """Whether tasks can read byte ranges of the file: its file system is known to pyarrow."""
    try:
        _open(path).close()
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return False
    return True


def _open(path: str):
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    files, inner = (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)
    return files.open_input_file(inner)


def _blocks(f, lo: int, hi: int) -> Iterator[tuple[int, bytes]]:
    f.seek(lo)
    while lo < hi and (block := f.read(min(BLOCK, hi - lo))):
        yield lo, block
        lo += len(block)


def _escapes_before(f, at: int) -> bool:
    """Whether an odd number of backslashes ends right before ``at``."""
    n = 0
    while at - n > 0:
        take = min(1 << 10, at - n)
        f.seek(at - n - take)
        block = f.read(take)
        run = len(block) - len(block.rstrip(b"\\"))
        n += run
        if run < take:
            break
    return n % 2 == 1


def _marks(block: bytes, odd: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(places of quotes, brackets and commas, their bytes, number of quotes up to and with
    each, whether the block ends in an odd run of backslashes). Escaped quotes are left out."""
    buf = np.frombuffer(block, np.uint8)
    at = np.flatnonzero(_MARKS[buf])
    slashes = np.flatnonzero(buf == _ESCAPE)
    # The first backslash of the run that each one belongs to.
    begins = np.concatenate([[True], np.diff(slashes) != 1]) if len(slashes) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(begins, slashes, 0)) if len(slashes) else slashes
    lengths = slashes - first + 1 + (first == 0) * odd
    before = np.searchsorted(slashes, at) - 1
    run = np.zeros(len(at), np.int64)
    near = before >= 0
    near[near] = slashes[before[near]] == at[near] - 1
    run[near] = lengths[before[near]]
    if len(at) and at[0] == 0:
        run[0] = odd
    at = at[(buf[at] != _QUOTE) | (run % 2 == 0)]
    kind = buf[at]
    if len(slashes) and slashes[-1] == len(buf) - 1:
        ends_odd = bool(lengths[-1] % 2)
    else:
        ends_odd = False
    return at, kind, np.cumsum(kind == _QUOTE), ends_odd


def _range_effect(path: str, lo: int, hi: int) -> tuple[int, int, int, int | None]:
    """(quotes, change of depth if it starts outside a string, the same inside, the root's first
    byte if it is here)."""
    quotes, change, root = 0, [0, 0], None
    with _open(path) as f:
        odd = _escapes_before(f, lo)
        for at, block in _blocks(f, lo, hi):
            if root is None:
                bare = block.lstrip(_BLANK + _BOM)
                root = bare[0] if bare else None
            _, kind, seen, odd = _marks(block, odd)
            inside = (quotes + seen - (kind == _QUOTE)) % 2
            step = _STEP[kind]
            change[0] += int(step[inside == 0].sum())
            change[1] += int(step[inside == 1].sum())
            quotes += int(seen[-1]) if len(seen) else 0
    return quotes, change[0], change[1], root


def _record(text: bytes, opened: int, closed: int | None) -> tuple[bytes, bool] | None:
    """(record, whether it is broken) between two marks; None for none."""
    bare = text.strip(_BLANK)
    if opened in b"]}":
        return (text, True) if bare else None
    if not bare and opened == _ARRAY and closed == b"]"[0]:
        return None
    return text, closed is None or closed == _END or opened == _OBJECT or not bare.startswith(b"{")


def _range_records(path: str, lo: int, hi: int, size: int, inside: bool, depth: int, root: int | None, owns_root: bool) -> Iterator[tuple[bytes, bool]]:
    with _open(path) as f:
        if root != _ARRAY:
            if owns_root:
                yield f.read().removeprefix(_BOM), False
            return
        odd, quotes = _escapes_before(f, lo), int(inside)
        opened, held = None, []
        for at, block in _blocks(f, lo, size):
            if at >= hi and opened is None:
                return
            places, kind, seen, odd = _marks(block, odd)
            outside = ((quotes + seen) % 2 == 0) & (kind != _QUOTE)
            quotes += int(seen[-1]) if len(seen) else 0
            places, kind = places[outside], kind[outside]
            step = _STEP[kind]
            after = depth + np.cumsum(step)
            depth = int(after[-1]) if len(after) else depth
            split = ((kind == _COMMA) & (after == 1)) | ((step == 1) & (after == 1)) | ((step == -1) & (after == 0))
            done = 0
            for place, mark in zip(places[split].tolist(), kind[split].tolist()):
                if opened is not None:
                    held.append(block[done:place])
                    if (got := _record(b"".join(held), opened, mark)) is not None:
                        yield got
                if at + place >= hi:
                    return
                opened, held, done = mark, [], place + 1
            if opened is not None:
                held.append(block[done:])
        if opened is not None and (got := _record(b"".join(held), opened, None)) is not None:
            yield got


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        got = [_range_effect(r["path"], r["start"], r["stop"]) for r in rows]
        own = pa.Table.from_batches([batch])
        for name, values in zip(("quotes", "out_change", "in_change", "root"), zip(*got)):
            own = own.append_column(name, pa.array(values, pa.int64()))
        yield from own.to_batches()


_RECORDS = pa.schema([("value", pa.binary()), ("broken", pa.bool_()), ("_file", pa.string()), ("_block", pa.int64()), ("_mono", pa.int64())])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            rows, held = [], 0
            found = _range_records(r["path"], r["start"], r["stop"], r["size"], r["inside"], r["depth"], r["root"], r["owns_root"])
            for i, (text, broken) in enumerate(found):
                rows.append((text, broken, r["_file"], r["start"], i))
                held += len(text)
                if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORDS.types)], schema=_RECORDS)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORDS.types)], schema=_RECORDS)


def array_records(spark: SparkSession, files: DataFrame, range_bytes: int, tasks: int) -> DataFrame:
    """``files`` (path, _file, length) -> (value, broken, _file, _block, _mono): the records, with
    the start of their range and their number in it."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.filter("length > 0").select("path", "_file", F.col("length").alias("size"), starts.alias("start"))
    ranges = ranges.withColumn("stop", F.least("size", F.col("start") + range_bytes))
    schema = "path string, _file string, size long, start long, stop long, quotes long, out_change long, in_change long, root long"
    # A number of tasks that is asked for is not reduced, small as these rows are.
    seen = ranges.repartition(tasks).mapInArrow(_effects, schema)
    before = Window.partitionBy("_file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside")
    known = seen.select("*", inside, F.first("root", ignorenulls=True).over(whole).alias("_root"))
    known = known.withColumn("_change", F.when(F.col("inside"), F.col("in_change")).otherwise(F.col("out_change")))
    owns = F.col("root").isNotNull() & F.coalesce(F.count("root").over(before) == 0, F.lit(True))
    placed = known.select(
        "path", "_file", "size", "start", "stop", "inside",
        F.coalesce(F.sum("_change").over(before), F.lit(0)).alias("depth"),
        F.col("_root").alias("root"),
        owns.alias("owns_root"),
    )
    found = placed.repartition(tasks).mapInArrow(_records, "value binary, broken boolean, _file string, _block long, _mono long")
    return found.withColumn("value", F.col("value").cast("string"))
