"""Legacy archive converter: ARC files of both versions to WARC.

``read_arc`` follows each archive's version block: version 1 records have five header
fields, version 2 ten, and the last field is the declared length that delimits the record.
``convert`` synthesises what WARC asks for and ARC lacks: a record id derived from the
archive's name and the record's place, an ISO timestamp, the record type, and SHA-1 digests of
block and payload. Of the records with equal payloads the one of highest rank becomes the
response and the others revisit it, without their payload.

Archives and WARC files are bounded by bytes (one record at least), written by Spark's own
writers into shared folders and read back as binary files, one file per row; a task holds one
file and one record at a time. The
largest payload group meets only in a partial maximum and in a join that AQE can split.

Defined results: a null payload is empty, and empty payloads are equal like any others;
white space in a URL is percent-encoded, a null URL is ``-``; repeated rows are records of
their own, the later record id wins a tie of rank; a record that is cut short or whose
header does not fit its version is returned by ``read_arc`` with ``error`` set and ends its
archive, and ``convert`` fails on it; a page whose URL begins with ``filedesc://`` is a record
like any other, since only an archive's beginning or a body that lists a version's fields is a
version block; an empty table gives empty archives and an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefpairs.session import scratch_path

# Header definitions of the two versions, and the revisit profile.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

#: Uncompressed bytes by archive and by WARC file, past which the next record begins another.
ARCHIVE_BYTES = 8 << 20
WARC_BYTES = 32 << 20
CRAWL_DATE = "20240102030405"
_BATCH_BYTES = 4 << 20
_GZIP = {"compression": "gzip"}


# --- legacy archives -------------------------------------------------------------------


def version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 archive\n{FIELDS[version]}\n".encode()
    if version == 1:
        return f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n".encode() + body
    return f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(body)}\n".encode() + body


def record_line(name: str, version: int, offset: int, url: str, date: str, mime: str, length: int) -> bytes:
    middle = f"{mime} {length}" if version == 1 else f"{mime} 200 - - {offset} {name} {length}"
    return f"{url} 0.0.0.0 {date} {middle}\n".encode()


def _pack(date: str):
    """Pages -> whole archives, one row each; versions 1 and 2 take turns."""
    schema = pa.schema([("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[bytes] = []
        size, made, name, version = 0, 0, "", 1

        def done() -> pa.RecordBatch:
            # The writer ends the last record's line.
            return pa.RecordBatch.from_arrays([pa.array([b"\n".join(held)], pa.binary())], schema=schema)

        for batch in batches:
            for url, doc in zip(batch.column("url").to_pylist(), batch.column("doc").to_pylist(), strict=True):
                if held and size >= ARCHIVE_BYTES:
                    yield done()
                    held, size = [], 0
                if not held:
                    version, name = 1 + (task + made) % 2, f"pages-{task:05d}-{made:05d}.arc"
                    made += 1
                    held.append(version_block(name, version, date))
                    size = len(held[0]) + 1
                held.append(record_line(name, version, size, url, date, "text/html", len(doc)) + doc)
                size += len(held[-1]) + 1
        if held:
            yield done()

    return run


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html", date: str = CRAWL_DATE) -> None:
    """Legacy archives of ``pages``: each document is an HTTP response that carries the
    row's id in its ``X-Record-Key`` header."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    key = F.coalesce(F.concat(F.lit("X-Record-Key: "), F.col(id_col).cast("string"), F.lit("\r\n")), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), key, F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    clean = F.regexp_replace(F.coalesce(F.col(url), F.lit("-")), r"[\x00-\x20\x7f]+", "%20")
    rows = pages.select(F.when(clean == "", F.lit("-")).otherwise(clean).alias("url"), F.concat(head.cast("binary"), body).alias("doc"))
    packed = rows.mapInArrow(_pack(date), "data binary").select(F.col("data").cast("string").alias("value"))
    packed.write.options(**_GZIP, maxRecordsPerFile=1, lineSep="\n").text(path)


def _open(content: bytes) -> io.BufferedIOBase:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _iso(date: str, fallback: str) -> str:
    """ISO timestamp of 14 digits (fewer are filled up); what is no date gives the fallback."""
    from datetime import datetime

    filled = (date + "00000101000000"[len(date) :])[:14] if len(date) >= 4 else date
    try:
        return datetime.strptime(filled, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return fallback


def _split_http(doc: bytes) -> tuple[bytes, bytes]:
    """(HTTP headers with their blank line, payload); none: all is payload."""
    if not doc.startswith(b"HTTP/"):
        return b"", doc
    end = doc.find(b"\r\n\r\n")
    if end < 0:
        return doc, b""
    return doc[: end + 4], doc[end + 4 :]


def _described(text: str) -> list[str]:
    """Header fields of a version block's own line, of either version."""
    fields = text.split(" ")
    return [text[: -sum(len(x) + 1 for x in fields[-4:])], *fields[-4:]] if len(fields) < 10 else [" ".join(fields[:-9]), *fields[-9:]]


def _is_version_block(block: bytes) -> bool:
    first, _, rest = block.partition(b"\n")
    number = first.split(b" ", 1)[0]
    return number.isdigit() and int(number) in FIELDS and rest.startswith(FIELDS[int(number)].encode())


def arc_records(content: bytes) -> Iterator[dict]:
    """Records of one archive, by its version's header lines and the declared lengths."""
    f = _open(content)
    at, version, name, filed = 0, 0, "-", "1970-01-01T00:00:00Z"
    while True:
        line = f.readline()
        if not line:
            return
        start, at = at, at + len(line)
        if not line.strip():
            continue  # between records
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        error, fields, block = None, [], b""
        described, fits = text.startswith("filedesc://"), True
        if described and not version:
            # The block's second line names the version; its own header follows that version.
            fields = _described(text)
        elif version:
            fields = text.rsplit(" ", len(FIELDS[version].split()) - 1)
            fits = len(fields) == len(FIELDS[version].split())
            if not fits and not described:
                error = "header does not fit the version"
        else:
            error = "no version block"
        if not error and not fields[-1].isdigit():
            error = "no declared length"
        if not error:
            block = f.read(int(fields[-1]))
            at += len(block)
            if len(block) < int(fields[-1]):
                error = "cut short"
        kind = "response"
        # Inside an archive (joined files) a version block is told from a page by its body.
        if not error and described and version and not _is_version_block(block):
            described, error = False, None if fits else "header does not fit the version"
        if not error and described:
            fields = _described(text)
            kind, name = "warcinfo", fields[0][len("filedesc://") :]
            number = block.split(b" ", 1)[0]
            version = int(number) if number.isdigit() and int(number) in FIELDS else 0
            filed = _iso(fields[2], filed)
            error = None if version else "unknown version"
        head, payload = (b"", block) if kind == "warcinfo" else _split_http(block)
        if kind != "warcinfo" and not head:
            kind = "resource"
        yield {
            "kind": kind, "error": error, "version": version, "offset": start, "url": fields[0] if fields else text,
            "date": _iso(fields[2], filed) if len(fields) > 2 else filed, "mime": fields[3] if len(fields) > 3 else "-",
            "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{start}')}>",
            "head": head, "payload": payload, "payload_digest": _sha1(payload), "head_digest": _sha1(head), "block_digest": _sha1(block),
        }
        if error:
            return


_ARC = pa.schema(
    [(c, pa.string()) for c in ("kind", "error")]
    + [("version", pa.int32()), ("offset", pa.int64())]
    + [(c, pa.string()) for c in ("url", "date", "mime", "record_id")]
    + [("head", pa.binary()), ("payload", pa.binary())]
    + [(c, pa.string()) for c in ("payload_digest", "head_digest", "block_digest")]
)


def _rows(parse, schema: pa.Schema, weight: str):
    """Map of binary files to their records, in batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for i in range(batch.num_rows):
                for row in parse(batch.column("content")[i].as_py()):
                    held.append(row)
                    size += 400 + len(row[weight] or b"")
                    if size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    return run


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``: kind (warcinfo for a version block, response,
    resource), error, version, offset, url, date, mime, record_id, head (HTTP headers),
    payload, and digests (bare base32 SHA-1) of payload, head and whole block."""
    kinds = "kind string, error string, version int, offset long, url string, date string, mime string, record_id string, head binary, payload binary, payload_digest string, head_digest string, block_digest string"
    return _files(spark, path).mapInArrow(_rows(arc_records, _ARC, "payload"), kinds)


# --- conversion ------------------------------------------------------------------------


def record_key(head: Column) -> Column:
    """The id that ``write_arc`` put into the HTTP headers."""
    return F.regexp_extract(head.cast("string"), r"(?m)^X-Record-Key: (-?\d+)\r?$", 1).try_cast("long")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """WARC records -> whole files, one row each."""
    schema = pa.schema([("data", pa.binary())])
    held: list[bytes] = []
    size = 0
    for batch in batches:
        for record in batch.column("record").to_pylist():
            if held and size + len(record) > WARC_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(held)], pa.binary())], schema=schema)
                held, size = [], 0
            held.append(record)
            size += len(record) + 4
    if held:
        # The writer ends the last record.
        yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(held)], pa.binary())], schema=schema)


def convert(arc: DataFrame, rank: Column, path: str) -> None:
    """Write the records of ``arc`` as WARC under ``path``; of responses with equal payloads
    that of the highest ``rank`` is written whole, the others revisit it. A record with an error
    fails the job, as what follows it in its archive is lost; a caller that wants the good
    records alone filters ``arc``."""
    fault = F.raise_error(F.concat(F.lit("archive record at "), F.col("offset").cast("string"), F.lit(", "), F.col("url"), F.lit(": "), F.col("error")))
    ranked = arc.withColumn("kind", F.when(F.col("error").isNull(), F.col("kind")).otherwise(fault.cast("string"))).withColumn("rank", rank)
    responses = ranked.filter("kind = 'response'")
    best = responses.groupBy("payload_digest").agg(F.max(F.struct("rank", "record_id", "url", "date")).alias("best"), F.count(F.lit(1)).alias("n"))
    best = best.filter("n > 1").select(F.col("payload_digest").alias("shared"), "best")
    joined = ranked.join(best, (F.col("payload_digest") == F.col("shared")) & (F.col("kind") == "response"), "left")
    revisit = F.col("best").isNotNull() & (F.col("best.record_id") != F.col("record_id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    if_revisit = lambda *parts: F.when(revisit, F.concat(*parts)).otherwise(F.lit(""))
    http = F.col("kind") == "response"
    length = F.octet_length("head") + F.when(revisit, 0).otherwise(F.octet_length("payload"))
    header = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.col("kind"))),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")),
        F.when(F.col("kind") == "warcinfo", line("WARC-Filename", F.regexp_replace("url", "^filedesc://", ""))).otherwise(line("WARC-Target-URI", F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(revisit, F.col("head_digest")).otherwise(F.col("block_digest")))),
        if_revisit(line("WARC-Refers-To", F.col("best.record_id")), line("WARC-Refers-To-Target-URI", F.col("best.url")), line("WARC-Refers-To-Date", F.col("best.date")), F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\n")),
        line("Content-Type", F.when(http, F.lit("application/http; msgtype=response")).otherwise(F.col("mime"))),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
    )
    block = F.concat(F.col("head"), F.when(revisit, F.lit(b"")).otherwise(F.col("payload")))
    records = joined.select(F.concat(header.cast("binary"), block).alias("record"))
    out = records.mapInArrow(_joined, "data binary").select(F.col("data").cast("string").alias("value"))
    out.write.options(**_GZIP, maxRecordsPerFile=1, lineSep="\r\n\r\n").text(path)


def warc_records(content: bytes) -> Iterator[dict]:
    """Records of one WARC file."""
    f = _open(content)
    while True:
        line = f.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should start")
        fields = {}
        while (line := f.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = f.read(int(fields["content-length"]))
        if len(block) < int(fields["content-length"]):
            raise ValueError("WARC record cut short")
        head, payload = _split_http(block)
        yield {
            "type": fields["warc-type"], "record_id": fields["warc-record-id"], "url": fields.get("warc-target-uri"), "date": fields["warc-date"],
            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"), "found_digest": _sha1(payload), "refers_to": fields.get("warc-refers-to"),
            "head": head, "payload_bytes": len(payload), "payload": payload,
        }


_WARC = pa.schema([(c, pa.string()) for c in ("type", "record_id", "url", "date", "payload_digest", "found_digest", "refers_to")] + [("head", pa.binary()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _headers_only(content: bytes) -> Iterator[dict]:
    return ({**row, "payload": None} for row in warc_records(content))


def checked_digest() -> Column:
    """``payload_digest`` of rows of ``read_warc``; a response whose payload read back has
    another digest than its header says is an error, so a damaged archive does not pass."""
    wrong = (F.col("type") == "response") & ~F.col("found_digest").eqNullSafe(F.col("payload_digest"))
    said = F.concat(F.lit("payload digest of "), F.coalesce("record_id", F.lit("a record")), F.lit(" differs from its header"))
    return F.when(wrong, F.raise_error(said)).otherwise(F.col("payload_digest"))


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the WARC files under ``path``; ``found_digest`` and ``payload_bytes`` are of
    the payload as it was read (of a revisit: of its empty one)."""
    kinds = "type string, record_id string, url string, date string, payload_digest string, found_digest string, refers_to string, head binary, payload_bytes long, payload binary"
    return _files(spark, path).mapInArrow(_rows(warc_records if payload else _headers_only, _WARC, "payload"), kinds)


def resolve_revisits(warc: DataFrame) -> DataFrame:
    """Responses and revisits of ``warc`` with ``payload_bytes`` of the full payload and
    ``target``, the key (``record_key``) of the response that a revisit refers to."""
    rows = warc.filter("type in ('response', 'revisit')").withColumn("key", record_key(F.col("head")))
    origin = rows.filter("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("key").alias("target"), F.col("payload_bytes").alias("full_bytes"))
    joined = rows.join(origin, "refers_to", "left")
    return joined.withColumn("payload_bytes", F.coalesce("full_bytes", "payload_bytes")).drop("full_bytes")


def through_archives(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html") -> str:
    """Write ``pages`` as legacy archives, convert them, and return the WARC files' folder."""
    spark = pages.sparkSession
    old, new = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, old, id_col, url, payload)
    convert(read_arc(spark, old), record_key(F.col("head")), new)
    return new
