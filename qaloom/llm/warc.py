"""WARC archives: pages as records with revisits, and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm.shared import slices, text_of

MIN_REVISIT_BYTES = 1000
RECORDS_PER_FILE = 20_000
DATE = "1970-01-01T00:00:00Z"
OUT_BYTES = 4 << 20
_PIECE = 1 << 16

#: a gzip member without content: what the text sink puts between records
EMPTY_MEMBER = b"\x1f\x8b\x08\0\0\0\0\0\0\x03\x03\0\0\0\0\0\0\0\0\0"

VERSION = re.compile(rb"WARC/[0-9]+\.[0-9]+\r?\n")
#: where a member or a record may begin again after damage
START = re.compile(rb"\x1f\x8b\x08|WARC/[0-9]+\.[0-9]+\r?\n")
FIELD = re.compile(rb"([!-9;-~]+):[ \t]*(.*)")
HEADER_END = re.compile(rb"\r?\n\r?\n")
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_field(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def _digest_bytes(value: str) -> bytes | None:
    """The digest of a ``sha1:`` field in base 32 or hex; None for other algorithms."""
    name, _, text = value.partition(":")
    if name.lower() != "sha1":
        return None
    try:
        return bytes.fromhex(text) if len(text) == 40 else base64.b32decode(text.upper())
    except ValueError:
        return b""


def _uri(url: str) -> str:
    """A URL as a header value: control characters and line ends are percent-encoded."""
    return "".join(c if c >= " " and c not in "\x7f\x85  " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit of the record of page ``refers_to``."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    revisit = refers_to is not None
    block = head.encode() + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", _uri(url))] if url is not None else []),
        *([("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")] if revisit else []),
        ("WARC-Payload-Digest", digest_field(sha1)),
        ("WARC-Block-Digest", digest_field(hashlib.sha1(block).digest())),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write every row of ``pages`` as a record of gzip-member archives below ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, those with the
    largest id are responses and the others revisit it; a group without any id has
    responses only. Null html is an empty payload, a null URL leaves its field out, a
    null id is an empty one; repeated rows are all written. Other columns aren't read.

    Digests meet in one aggregate of a digest and an id per row; only digests with copies
    are joined back. The files come from Spark's text sink, which commits whole tasks only
    and writes to any store: a record is one gzip member, and the line separator between
    records is an empty member. A file holds at most ``records_per_file`` records.
    """
    given = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        F.encode(text_of(F.col(f"`{html_col}`")), "UTF-8").alias("payload"),
    ).withColumn("sha1", F.unhex(F.sha1("payload")))
    size = F.octet_length("payload")
    groups = given.where(size >= min_revisit_bytes).groupBy("sha1")
    newest = groups.agg(F.max("id").alias("newest"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = given.join(newest, "sha1", "left").withColumn(
        "refers_to", F.when((size >= min_revisit_bytes) & ~F.col("id").eqNullSafe(F.col("newest")), F.col("newest"))
    )

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "payload"):
                members = []
                for row in part.to_pylist():
                    pack = zlib.compressobj(wbits=31)
                    raw = record(row["id"], row["url"], row["payload"], row["sha1"], row["refers_to"])
                    members.append(pack.compress(raw) + pack.flush())
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["value"])

    packed = marked.select("id", "url", "payload", "sha1", "refers_to").mapInArrow(job, "value binary")
    separator = EMPTY_MEMBER.decode("latin-1")
    (
        packed.select(F.col("value").cast("string"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", separator)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


@dataclass
class Found:
    """A record of an archive, or (with ``error``) a range of bytes that holds none."""

    start: int
    end: int
    error: str | None = None
    fields: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def _parse(data, at: int) -> Found:
    """The record that starts at ``at`` with its version line; ``error`` says which check failed."""

    def bad(reason: str) -> Found:
        return Found(at, at, reason)

    version = VERSION.match(data, at)
    if not version:
        return bad("no version line")
    head_end = HEADER_END.search(data, version.end() - 2)
    if not head_end:
        return bad("unfinished header")
    fields: dict[str, str] = {}
    name = None
    for line in bytes(data[version.end() : head_end.start()]).splitlines():
        m = FIELD.fullmatch(line)
        if m:
            name = m[1].decode("latin-1").lower()
            fields[name] = m[2].decode("utf-8", "replace").strip()
        elif name and line[:1] in (b" ", b"\t"):
            fields[name] += " " + line.decode("utf-8", "replace").strip()
        else:
            return bad("broken header")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or len(length) > 18:
        return bad("no content length")
    end = head_end.end() + int(length)
    if end + 4 > len(data):
        return bad("unfinished block")
    if data[end : end + 4] != b"\r\n\r\n":
        return bad("no end of record")
    block = bytes(data[head_end.end() : end])
    if "warc-block-digest" in fields:
        want = _digest_bytes(fields["warc-block-digest"])
        if want is not None and want != hashlib.sha1(block).digest():
            return bad("block digest")
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        inner = HEADER_END.search(block)
        payload = block[inner.end() :] if inner else b""
    if fields.get("warc-type") == "response" and "warc-payload-digest" in fields:
        want = _digest_bytes(fields["warc-payload-digest"])
        if want is not None and want != hashlib.sha1(payload).digest():
            return bad("payload digest")
    if fields.get("warc-type") == "revisit":
        stated = re.search(rb"^Content-Length: *([0-9]+)\r?$", block, re.MULTILINE | re.IGNORECASE)
        fields["full-length"] = stated[1].decode() if stated else ""
    return Found(at, end + 4, None, fields, payload)


def _member(data: memoryview, at: int) -> tuple[int, bytes, str | None]:
    """End and content of the gzip member at ``at``, or why there is none."""
    unpack = zlib.decompressobj(wbits=31)
    out = []
    end = at
    try:
        while not unpack.eof and end < len(data):
            piece = data[end : end + _PIECE]
            out.append(unpack.decompress(piece))
            end += len(piece)
    except zlib.error:
        return at, b"", "gzip check"
    if not unpack.eof:
        return at, b"", "unfinished member"
    return end - len(unpack.unused_data), b"".join(out), None


def salvage(data: bytes, inside: bool = False) -> Iterator[Found]:
    """All records of an archive file that pass their checks, and the gaps between them.

    The file is gzip members, plain records, or both. Where a check fails (gzip sum and
    length, version line, header, content length, end of record, block and payload
    digests), the next member or version line that starts a valid one is searched for, and
    the bytes before it are one gap with the first reason. Records and gaps cover the
    file without overlap, empty members and records without content included. A
    member's records all have the member's bytes; of a member that passes its own check
    but holds bad records, the good ones are kept and a gap is given out as well.
    """
    view = memoryview(data)
    at, gap, reason = 0, None, ""
    while at < len(data):
        found: list[Found] = []
        if data[at : at + 3] == b"\x1f\x8b\x08" and not inside:
            end, content, error = _member(view, at)
            if error is None and content:
                found = list(salvage(content, True))
                if all(f.error for f in found):
                    error = found[0].error
                for f in found:
                    f.start, f.end = at, end
        else:
            one = _parse(data, at)
            end, error, found = one.end, one.error, [one]
        if error is None:
            if gap is not None:
                yield Found(gap, at, reason)
                gap = None
            yield from found
            at = end
        else:
            if gap is None:
                gap, reason = at, error
            after = START.search(data, at + 1)
            at = after.start() if after else len(data)
    if gap is not None:
        yield Found(gap, len(data), reason)


OUT = (
    "file string, start long, end long, error string, record_type string, record_id string, uri string, "
    "refers_to string, payload binary, payload_bytes long, payload_digest string"
)


def _row(file: str, f: Found) -> tuple:
    if f.error:
        return (file, f.start, f.end, f.error, *[None] * 7)
    get = f.fields.get
    kind = get("warc-type")
    if kind == "revisit":
        stated = _digest_bytes(get("warc-payload-digest", ""))
        n, digest = int(get("full-length") or 0), stated.hex() if stated else None
    else:
        n, digest = len(f.payload), hashlib.sha1(f.payload).hexdigest()
    payload = None if kind == "revisit" else f.payload
    return (file, f.start, f.end, None, kind, get("warc-record-id"), get("warc-target-uri"), get("warc-refers-to"), payload, n, digest)


def read_archive(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """Records and gaps of all archive files below ``path``, columns as in ``OUT``.

    A row with ``error`` is a quarantined range of bytes, ``start`` to ``end`` of ``file``
    (see :func:`salvage`); log it with :func:`log_gaps`. Other rows are records;
    ``payload_bytes`` and the SHA-1 in hex are those of the full payload, which a revisit
    states without holding it. An empty file has no rows. A file is read by one task as a
    whole, up to Spark's 2 GB for a binary cell; records go on in bounded batches.
    """
    names = [c.split()[0] for c in OUT.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.binary(), pa.int64(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file = batch.column("path")[i].as_py()
                rows, held = [], 0
                for f in salvage(batch.column("content")[i].as_py()):
                    rows.append(_row(file, f))
                    held += len(f.payload) + 200
                    if held > OUT_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", files).load(path)
    return found.where("length > 0").select("path", "content").mapInArrow(job, OUT)


def log_gaps(found: DataFrame, path: str) -> None:
    """Append the quarantined byte ranges of :func:`read_archive` to a JSON log."""
    found.where("error IS NOT NULL").select("file", "start", "end", "error").write.mode("append").json(path)


def page_records(found: DataFrame) -> DataFrame:
    """The records of :func:`write_archive`'s pages: ids as numbers, gaps left out."""

    def page(c: str):
        return F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")

    return found.where("error IS NULL").select(
        page("record_id").alias("page_id"), "uri", "payload", "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )


JUDGE_SQL = f"""WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
m AS (SELECT *, CASE WHEN n >= {MIN_REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY h, n) END AS newest FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
  CASE WHEN newest IS DISTINCT FROM page_id AND newest IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN newest IS DISTINCT FROM page_id THEN newest END AS refers_to
FROM m"""
