"""Readers: entries (JSON / JSON lines / Parquet), ordered source fallback, pair JSONL as a
table and as raw lines. Every read uses an explicit schema."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefpairs.functions.jsonline import has_key, is_object, is_strict_json, string_field, wrapped_variant
from prefpairs.functions.text import py_strip
from prefpairs.schema import PAIR
from prefpairs.session import listing_session, scratch_path
from prefpairs.sources.adapters import conform
from prefpairs.sources.array_ranges import COMPRESSED, array_records, can_open
from prefpairs.sources.synthetic import synthetic_entries

# Row ids derived from positions: file ordinal in the high bits, row index in the low 40
# bits (up to ~1.1e12 rows per file).
_ROW_BITS = 40
# The table of files, and the directory of their splits, are sent to every task up to so many
# bytes, counted before the join is planned; beyond, they are joined like any other table.
MAX_BROADCAST_BYTES = 128 << 20
# Bytes of a row of either table beside its path.
_ROW_BYTES = 64

# Entries as they come from JSON: fields of any kind, so that a message that is no text is told
# apart from one that is missing, and one odd record does not spoil an array file.
_CORRUPT = "_corrupt_record"
_JSON_ENTRY = f"entry_id variant, conversations variant, {_CORRUPT} string"

MALFORMED_RECORD = "malformed_record"
NON_TEXT_MESSAGE = "non_text_message"


def require_ids(entries: DataFrame) -> DataFrame:
    """Fail the job on a row without ``entry_id``: ids order prefixes and key the noise, so
    rows without one would share it. A malformed record has none to give and passes, as it
    is skipped and counted later."""
    needed = F.col("entry_id").isNull()
    if "fault" in entries.columns:
        needed = needed & F.coalesce(F.col("fault") != MALFORMED_RECORD, F.lit(True))
    return entries.withColumn(
        "entry_id",
        F.when(needed, F.raise_error(F.lit("entry without entry_id")).cast("bigint")).otherwise(F.col("entry_id")),
    )


def spread(df: DataFrame, min_partitions: int | None = None, scan: DataFrame | None = None) -> DataFrame:
    """Redistribute round-robin when the scan yields far fewer partitions than there are
    task slots (e.g. one large Parquet row group), so the per-row parsing, hashing and
    JSON work uses every core. Only a gain of at least 4x pays for the shuffle: inputs
    with more than a quarter as many splits as slots, the normal case on a cluster, are
    returned untouched. Nothing downstream depends on which partition a row lands in (the
    noise is keyed by entry id). ``scan`` is the bare scan below ``df``, whose number of
    partitions is known without running anything; a plan with joins is never asked."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if (df if scan is None else scan).rdd.getNumPartitions() * 4 > target:
        return df
    return df.repartition(target)


def _text_entries(df: DataFrame) -> DataFrame:
    """``_JSON_ENTRY`` rows, their id as a number -> ENTRY rows and ``fault``.

    Only a JSON string is a message's text. A record that cannot be read, and one of whose
    first two messages is a number, an object or the like, keep a row with their fault.
    """
    kind = lambda v: F.schema_of_variant(v)
    text = lambda v: F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
    field = lambda m, name: F.try_variant_get(m, f"$.{name}", "variant")
    listed = df.select(
        "entry_id",
        F.try_variant_get("conversations", "$", "array<variant>").alias("_list"),
        (F.col(_CORRUPT).isNotNull() | ~kind(F.col("conversations")).like("ARRAY%") & (kind(F.col("conversations")) != "VOID")).alias("_bad"),
    )
    conv = F.col("_list")
    odd = lambda i: F.coalesce(~kind(field(F.get(conv, i), "value")).isin("STRING", "VOID"), F.lit(False))
    fault = F.when(F.coalesce("_bad", F.lit(False)), F.lit(MALFORMED_RECORD)).when((F.size(conv) >= 2) & (odd(0) | odd(1)), F.lit(NON_TEXT_MESSAGE))
    messages = F.transform(conv, lambda m: F.struct(text(field(m, "from")).alias("from"), text(field(m, "value")).alias("value")))
    return listed.select("entry_id", messages.alias("conversations"), fault.alias("fault"))


def _parsed_lines(lines: DataFrame) -> DataFrame:
    """Adds the columns of ``_JSON_ENTRY`` to lines in ``value``."""
    parsed = lines.withColumn("_e", F.from_json("value", T._parse_datatype_string(_JSON_ENTRY), {"columnNameOfCorruptRecord": _CORRUPT}))
    # The parser stops after the first value; in brackets, what follows it is an error.
    whole = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]"))).isNotNull()
    corrupt = F.coalesce(F.col(f"_e.{_CORRUPT}"), F.when(~whole, F.col("value")))
    return parsed.withColumns({"entry_id": F.col("_e.entry_id"), "conversations": F.col("_e.conversations"), _CORRUPT: corrupt})


def read_entries_json(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    ids: str = "column",
    spread_rows: bool = False,
    head: int | None = None,
) -> DataFrame:
    """Entries from JSON lines (default) or JSON array files (``multi_line``): ENTRY columns
    and ``fault``.

    ``ids="column"`` takes ``entry_id`` from the records and fails on a readable record
    without one. ``ids="position"`` numbers the records by position instead: file ordinal in
    the high bits, record number within the file (0-based, blank lines skipped) in the low
    40 bits, so prefixes follow file order as a sequential reader would. Array files are
    read in byte ranges by many tasks; an element that is no object, and what is left of an array
    that breaks off, count as malformed records.
    ``head`` keeps the first so many records by position and reads the files they are in.
    """
    if ids not in ("column", "position"):
        raise ValueError("ids must be 'column' or 'position'")
    if head is not None and ids != "position":
        raise ValueError("a head of the files needs ids='position'")
    read = _placed_records if multi_line else _placed_lines
    if ids == "position":
        rows, scan = with_positions(spark, read, path, "_id", head)
    else:
        scan, rows = read(spark, path)
    if not multi_line:
        rows = _parsed_lines(rows)
    if ids == "position":
        rows = rows.withColumn("entry_id", F.col("_id"))
    else:
        rows = rows.withColumn("entry_id", F.try_variant_get("entry_id", "$", "bigint"))
    entries = require_ids(_text_entries(rows))
    # Byte ranges of array files are dealt to the tasks already.
    return spread(entries, scan=scan) if spread_rows and not multi_line else entries


def _normal(path: str) -> str:
    # inputFiles() spells local files "file:///p" where the scan metadata says "file:/p".
    return re.sub(r"^file:/+", "file:///", path)


def _sized_broadcast(df: DataFrame, n_bytes: int) -> DataFrame:
    return F.broadcast(df) if n_bytes <= MAX_BROADCAST_BYTES else df


def _file_ordinals(spark: SparkSession, files: list[str]) -> DataFrame:
    """(normalised file path, ordinal in path order): one row per input file."""
    files = sorted(map(_normal, files))
    ordinals = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "_file string, _ord long")
    return _sized_broadcast(ordinals, sum(map(len, files)) + _ROW_BYTES * len(files))


def _file_path() -> "F.Column":
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")


def _place() -> list["F.Column"]:
    """Where a scan found a row: file, split, and a number that runs on within the split."""
    return [_file_path().alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_mono")]


#: (session, path) -> the bare scan, and its rows that count with their ``_place`` columns.
PlacedScan = Callable[[SparkSession, "str | list[str]"], tuple[DataFrame, DataFrame]]


def _placed_lines(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Lines of text that are not blank."""
    scan = spark.read.text(path)
    return scan, scan.filter(F.length(py_strip(F.col("value"))) > 0).select("value", *_place())


def _placed_records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Records of JSON array files, read in byte ranges as long as the splits of a scan. Files
    that tasks cannot read so are streamed, a task a file."""
    scan = spark.read.format("binaryFile").load(path)
    if not all(can_open(unquote(f)) for f in scan.inputFiles()[:1]) or any(f.endswith(COMPRESSED) for f in scan.inputFiles()):
        scan = spark.read.schema(_JSON_ENTRY).options(multiLine=True, columnNameOfCorruptRecord=_CORRUPT).json(path)
        return scan, scan.select("*", *_place())
    split, tasks = _split_bytes(spark, scan)
    rows = array_records(spark, scan.select("path", _file_path().alias("_file"), "length"), split, tasks)
    parsed = _parsed_lines(rows).withColumn(_CORRUPT, F.coalesce(_CORRUPT, F.when(F.col("broken"), F.col("value"))))
    return scan, parsed.drop("_e", "value", "broken")


def _size(setting: str) -> int:
    number, unit = re.fullmatch(r"([0-9]+)\s*([bkmgt]?)b?", setting.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _split_bytes(spark: SparkSession, listed: DataFrame) -> tuple[int, int]:
    """(bytes of a split, number of splits) of the files ``listed`` as binary ones, as a scan of
    them would be cut in ``spark``."""
    sizes = listed.agg(F.sum("length"), F.count(F.lit(1))).first()
    cost = _size(spark.conf.get("spark.sql.files.openCostInBytes"))
    slots = int(spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism)
    total = (sizes[0] or 0) + sizes[1] * cost
    split = min(_size(spark.conf.get("spark.sql.files.maxPartitionBytes")), max(cost, total // max(slots, 1)))
    return split, max(1, -(-total // split))


def pinned_session(spark: SparkSession, files: list[str]) -> SparkSession:
    """A session with the settings of ``spark`` in which ``files`` are always cut alike.

    How long a split is follows settings and, while the input is small, the number of cores
    at hand when a scan starts. Here the length that holds now is written into the session, so
    that scans made in it agree, however many executors come or go between them.
    """
    split, _ = _split_bytes(spark, spark.read.format("binaryFile").load(files))
    pinned = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            pinned.conf.set(key, value)
    pinned.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    pinned.conf.set("spark.sql.files.minPartitionNum", "1")
    return pinned


def files_of_head(spark: SparkSession, read: PlacedScan, files: list[str], n: int) -> tuple[list[str], int]:
    """(the first files, in path order, that hold the first ``n`` rows; rows of the last one
    that belong to them). Files are counted in batches that double, so about twice as many are
    read as are needed, and none behind; the driver gets one count a file, as it lists them."""
    have = at = 0
    while at < len(files):
        batch = files[at : at + max(1, at)]
        counted = read(spark, [unquote(f) for f in batch])[1].groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
        counts = {r["_file"]: r["n"] for r in counted.collect()}
        for k, f in enumerate(batch):
            own = counts.get(_normal(f), 0)
            if have + own >= n:
                return files[: at + k + 1], n - have
            have += own
        at += len(batch)
    return files, 1 << _ROW_BITS


def with_positions(spark: SparkSession, read: PlacedScan, path: str | list[str], name: str, head: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of ``read`` with ``name``, the bare scan below them): ``name`` is the file's ordinal
    and the row's number within the file. ``head`` keeps the first so many rows in that order.

    Two scans: the first counts the rows of each split and writes a directory of the splits to
    the shared folder (file, start, first number; a row a split). The second numbers its rows from
    the directory, which goes to every task while its counted size allows: no line is shuffled.
    Both scans are made in one pinned session, so they cut the files alike. Should a file be
    changed between them, a row finds no count or a number outside its split's count, and the
    job fails instead of losing or misnumbering rows.
    """
    spark = listing_session(spark)
    files = sorted(read(spark, path)[0].inputFiles())
    if not files:
        scan, rows = read(spark, path)
        return rows.drop("_file", "_block", "_mono").withColumn(name, F.lit(None).cast("bigint")), scan
    last = None
    if head is not None:
        files, last = files_of_head(spark, read, files, max(head, 1))
        path = [unquote(f) for f in files]
    pinned = pinned_session(spark, [unquote(f) for f in files])
    scan, rows = read(pinned, path)
    folder = scratch_path(spark, "split-counts")
    rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_mono0")).write.parquet(folder)
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = pinned.read.parquet(folder)
    offsets = counts.select("_file", "_block", "_n", "_mono0", F.coalesce(F.sum("_n").over(in_file), F.lit(0)).alias("_first"))
    offsets = offsets.join(_file_ordinals(pinned, files), "_file")
    directory = _sized_broadcast(offsets, counts.agg(F.coalesce(F.sum(F.length("_file") + _ROW_BYTES), F.lit(0))).first()[0])
    inside = F.col("_mono") - F.col("_mono0")
    known = F.coalesce((inside >= 0) & (inside < F.col("_n")), F.lit(False))
    position = F.when(known, F.shiftleft(F.col("_ord"), _ROW_BITS) + F.col("_first") + inside).otherwise(
        F.raise_error(F.lit("the files were cut into other splits than when they were counted")).cast("bigint")
    )
    own = [c for c in rows.columns if c not in ("_file", "_block", "_mono")]
    placed = rows.join(directory, ["_file", "_block"], "left").select(*own, position.alias(name))
    if head is not None:
        placed = placed.filter(F.col(name) < ((len(files) - 1) << _ROW_BITS) + last) if head > 0 else placed.filter(F.lit(False))
    return placed, scan


def with_parquet_row_ids(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Add ``entry_id`` from the scan position (file order, then row index).

    One small table of (file path, ordinal) is joined on; it has one row per input file.
    """
    ordinals = _file_ordinals(spark, df.inputFiles())
    pos = df.select("*", _file_path().alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return (
        pos.join(ordinals, "_file", "left")
        .withColumn("entry_id", F.shiftleft(F.col("_ord"), _ROW_BITS) + F.col("_row"))
        .drop("_file", "_ord", "_row")
    )


def read_entries_parquet(spark: SparkSession, path: str | list[str], spread_rows: bool = False) -> DataFrame:
    """Entries from Parquet; without an ``entry_id`` column the scan position is used, with
    one a NULL in it fails the job."""
    df = scan = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if "entry_id" not in df.columns:
        df = with_parquet_row_ids(spark, df)
    entries = require_ids(conform(df))
    return spread(entries, scan=scan) if spread_rows else entries


ENTRY_FORMATS = {
    "json": dict(multi_line=False, ids="column"),          # JSON lines with entry_id
    "json-array": dict(multi_line=True, ids="column"),     # JSON array files with entry_id
    "json-pos": dict(multi_line=False, ids="position"),    # JSON lines, ids from line position
    "json-array-pos": dict(multi_line=True, ids="position"),  # JSON arrays, ids from position
}


def read_entries(
    spark: SparkSession, path: str | list[str], fmt: str = "json", multi_line: bool = False, spread_rows: bool = False, head: int | None = None
) -> DataFrame:
    """Entries in one of: parquet, json, json-array, json-pos, json-array-pos; ``first:`` in
    front reads only the first split of a folder (``first_split``). ``spread_rows``
    redistributes a coarse scan's rows over the task slots. ``head`` keeps the first so many
    entries of the formats with ``-pos`` and reads the files they are in."""
    if fmt.startswith("first:"):
        fmt = fmt.removeprefix("first:")
        files = (spark.read.parquet(path) if fmt == "parquet" else spark.read.text(path)).inputFiles()
        path = first_split(files, str(path))
        if not path:
            raise FileNotFoundError("no files")
    if head is not None and not fmt.endswith("-pos"):
        raise ValueError("a head of the files needs a format with positions")
    if fmt == "parquet":
        return read_entries_parquet(spark, path, spread_rows)
    if fmt in ENTRY_FORMATS:
        opts = dict(ENTRY_FORMATS[fmt])
        opts["multi_line"] = opts["multi_line"] or multi_line
        return read_entries_json(spark, path, **opts, spread_rows=spread_rows, head=head)
    raise ValueError(f"unsupported entry format {fmt!r}")


def first_split(files: list[str], root: str = "") -> list[str]:
    """Of a folder's files those of its first split: train before validation before test, by
    the words of their paths below ``root``; all files if none names a split."""
    below = lambda f: f.rpartition(root.rstrip("/").rpartition("/")[2])[2] if root else f
    named = lambda f, words: any(w in re.split(r"[^a-z]+", below(f).lower()) for w in words)
    for words in (("train", "training"), ("validation", "valid", "val", "dev"), ("test", "testing", "eval")):
        if own := [f for f in files if named(f, words)]:
            return own
    return files


def dataset_candidates(root: str, fmt: str = "parquet", data_file: str = "data.json") -> list[tuple[str, str]]:
    """The generator's source order for a dataset folder: its data file (id-less JSON
    lines), then the ``train``, ``validation`` and ``test`` splits, then the first split
    that the folder's files name."""
    root = root.rstrip("/")
    return [
        (f"{root}/{data_file}", "json-pos"),
        (f"{root}/train", fmt),
        (f"{root}/validation", fmt),
        (f"{root}/test", fmt),
        (root, f"first:{fmt}"),
    ]


@dataclass(frozen=True)
class Source:
    entries: DataFrame
    label: str
    synthetic: bool


_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def resolve_source(
    spark: SparkSession,
    candidates: Iterable[tuple[str, str]],
    synthetic_fallback: int | None = None,
    spread_rows: bool = False,
    head: int | None = None,
) -> Source:
    """First candidate ``(path, format)`` that exists and has files wins.

    Only a missing or empty location moves on to the next candidate; any other fault, such
    as a misspelt format or a wrong schema, fails. Synthetic entries stand in for a missing
    source only when ``synthetic_fallback`` asks for them. ``head`` spares formats with positions
    the reading of what lies behind the first so many entries.
    """
    for path, fmt in candidates:
        try:
            df = read_entries(spark, path, fmt, spread_rows=spread_rows, head=head if fmt.endswith("-pos") else None)
            if df.inputFiles():
                return Source(df, path, False)
        except FileNotFoundError:
            continue
        except AnalysisException as e:
            if e.getCondition() not in _ABSENT:
                raise
    if synthetic_fallback:
        return Source(synthetic_entries(spark, synthetic_fallback), f"synthetic:{synthetic_fallback}", True)
    raise FileNotFoundError("no entry source could be read")


def resolve_entries(
    spark: SparkSession, candidates: Iterable[tuple[str, str]], synthetic_fallback: int | None = 10
) -> tuple[DataFrame, str]:
    """``resolve_source`` as (entries, label), ending in synthetic entries by default."""
    source = resolve_source(spark, candidates, synthetic_fallback)
    return source.entries, source.label


def pair_lines_table(lines: DataFrame) -> DataFrame:
    """Raw lines (``value``) -> prompt, chosen, rejected and ``fault``: NULL for a JSON object
    with all three as strings, else ``json_error``, ``missing_key`` or ``non_text``. Blank
    lines are left out; other columns pass through."""
    keep = [c for c in lines.columns if c != "value"]
    text = lines.filter(F.length(py_strip(F.col("value"))) > 0)
    w = text.select(*keep, "value", wrapped_variant(F.col("value")).alias("_w"))
    keys = PAIR.fieldNames()
    has = [has_key(F.col("_w"), k) for k in keys]
    read = w.select(
        *keep,
        *[string_field(F.col("_w"), k).alias(k) for k in keys],
        F.when(~is_strict_json(F.col("value"), F.col("_w")), F.lit("json_error"))
        .when(~is_object(F.col("_w")) | ~(has[0] & has[1] & has[2]), F.lit("missing_key"))
        .alias("_f"),
    )
    non_text = F.col("prompt").isNull() | F.col("chosen").isNull() | F.col("rejected").isNull()
    return read.select(*keep, *keys, F.coalesce("_f", F.when(non_text, F.lit("non_text"))).alias("fault"))


def read_pairs_jsonl(spark: SparkSession, path: str | list[str], on_fault: str = "raise", positions: bool = False, head: int | None = None) -> DataFrame:
    """Pair JSON lines as a table ``(prompt, chosen, rejected)``; blank lines are ignored by
    this reader, use ``read_lines`` for the audit.

    A line that is no pair of texts fails the read (``on_fault="raise"``), is left out
    (``"drop"``), or stays with its ``fault`` (``"keep"``). ``positions`` adds ``line_id``,
    the place of the line in file order; ``head`` (with it) keeps the first so many lines and
    reads the files they are in.
    """
    if on_fault not in ("raise", "drop", "keep"):
        raise ValueError("on_fault must be 'raise', 'drop' or 'keep'")
    if head is not None and not positions:
        raise ValueError("a head of the files needs positions=True")
    lines = with_positions(spark, _placed_lines, path, "line_id", head)[0] if positions else spark.read.text(path)
    pairs = pair_lines_table(lines)
    if on_fault == "keep":
        return pairs
    if on_fault == "drop":
        # A generator keeps the test above the parse, which is then done once per line.
        return pairs.select("*", F.explode(F.array(F.col("fault").isNull())).alias("_ok")).filter("_ok").drop("_ok", "fault")
    stop = F.raise_error(F.concat(F.lit("line is no pair: "), F.col("fault"))).cast("string")
    checked = F.when(F.col("fault").isNotNull(), stop)
    return pairs.select(*[F.coalesce(checked, F.col(c)).alias(c) if c in PAIR.fieldNames() else F.col(c) for c in pairs.columns if c != "fault"])


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw text lines (column ``value``), blank lines included; splits on \\n, \\r\\n, \\r."""
    return spark.read.text(path)
