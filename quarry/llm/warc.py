"""WARC archives: a writer, and a reader that salvages damaged files.

Writing: one record per page, each a gzip member of its own. Of records with
equal payloads the one with the largest page id is a ``response``, the others
are ``revisit`` records that refer to it. The files are written by Spark's
text writer, record bytes as they are, so any file system Spark knows serves;
the line separator is an empty gzip member, which readers skip.

Reading: members and records are checked (gzip sums, version line, declared
lengths, digests). After a failed check the reader searches for the next
member or version line from which a whole record can be read, goes on there,
and logs the bytes between as a quarantined gap. What a damaged member still
inflates to is searched for version lines in the same way: records whose block
digest is right are recovered, before the damage and behind it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import text_chunks

VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
_candidate = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_version = re.compile(rb"WARC/1\.[01]\r\n")
_name = re.compile(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+")
_named = re.compile(_name.pattern + rb":")
_PIECE = 65_536
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
#: Records and bytes per file: bound the file that one reading task holds (by one record more than the bytes).
RECORDS_PER_FILE = 5_000
BYTES_PER_FILE = 16_000_000


#: Digests that can be checked.
_DIGESTS = ("md5", "sha1", "sha256", "sha512")


def _proved(said: str) -> bool:
    """Whether a labelled digest, once it agrees, proves its data."""
    return said.partition(":")[0].lower().replace("-", "") in _DIGESTS


def _agrees(said: str, data: bytes) -> bool:
    """Whether a labelled digest, in base 32 or 16, is that of ``data``; one of
    an unknown algorithm can't be checked and counts as right."""
    name, _, value = said.partition(":")
    name = name.lower().replace("-", "")
    if name not in _DIGESTS:
        return True
    digest = hashlib.new(name, data).digest()
    return value.rstrip("=").upper() == base64.b32encode(digest).decode().rstrip("=") or value.lower() == digest.hex()


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


_own = re.compile(r"<urn:page:(-?\d+|null)>")


def _page_id(uri: str) -> int | None:
    """The page id in a record id of this writer; None in any other."""
    found = _own.fullmatch(uri)
    return None if not found or found[1] == "null" else int(found[1])


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of one record. The payload's length and digest are in the
    header of either kind; a revisit's block is the HTTP head alone."""
    block = HTTP_HEAD.format(len(payload)).encode() + (b"" if revisit else payload)
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"X-Payload-Length: {len(payload)}",
            f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_uri(refers_to)}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE,
                   bytes_per_file: int = BYTES_PER_FILE) -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path``, files of
    at most ``records_per_file`` records that end with the record which reaches
    ``bytes_per_file``.

    Null html is an empty payload; null ids and urls are kept (no target
    line). Payloads of fewer than ``min_bytes`` bytes are never revisits.
    Repeated rows of the page that is the response are responses too. Very
    long pages are written whole; an empty table gives no records. Other
    columns are not read."""
    body = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("body"))
    named = body.withColumn("digest", F.sha1("body"))
    kept = named.groupBy("digest").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
    rows = (named.join(kept.filter(F.col("n") > 1), "digest", "left")
            .withColumn("revisit", F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
                        & (F.octet_length("body") >= min_bytes))
            .select("page_id", "url", "original", "revisit", "body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in text_chunks(batches, "body", 8_000_000):
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "body", "original", "revisit"))
            for row in zip(*columns, strict=True):
                held.append(member(record(*row)))
                size += len(held[-1])
                if size >= bytes_per_file or len(held) >= records_per_file:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])

    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", member(b"").decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", 1).text(path))


class Damaged(ValueError):
    """The bytes at a place are not a whole, sound record."""


def _inflate(data: memoryview, start: int) -> tuple[bytes, int]:
    """(content, end) of the gzip member at ``start``."""
    z, parts, at = zlib.decompressobj(31), [], start
    try:
        while not z.eof:
            if at >= len(data):
                raise Damaged("member is cut off")
            parts.append(z.decompress(data[at:at + _PIECE]))
            at += _PIECE
    except zlib.error as broken:
        raise Damaged(str(broken)) from broken
    return b"".join(parts), min(at, len(data)) - len(z.unused_data)


def _parse(data: bytes | memoryview, start: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record whose version line is at ``start``."""
    size, window = _PIECE, bytes(data[start:start + _PIECE])
    sound = re.match(rb"WARC/1\.[01]\r\n", window)
    while sound and (edge := window.find(b"\r\n\r\n")) < 0 and start + size < len(data):
        # Whatever its length, a header is lines of a name and a value: other bytes are not searched on.
        sound = all(_named.match(line) for line in window.split(b"\r\n")[1:-1])
        size *= 4
        window = bytes(data[start:start + size])
    if not sound or edge < 0:
        raise Damaged("no version line or header end")
    headers: dict[str, str] = {}
    for line in window[:edge].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not _name.fullmatch(name):
            raise Damaged("malformed header line")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdigit():
        raise Damaged("no content length")
    first = start + edge + 4
    end = first + int(headers["content-length"])
    block = bytes(data[first:end])
    if bytes(data[end:end + 4]) != b"\r\n\r\n":
        raise Damaged("record does not end where its length says")
    if (said := headers.get("warc-block-digest")) and not _agrees(said, block):
        raise Damaged("block digest")
    return headers, block, end + 4


def _read(data: memoryview, start: int) -> tuple[list[tuple[dict[str, str], bytes]], int]:
    """The records of the member or the plain record at ``start``, and its end."""
    if data[start:start + 3] != MEMBER:
        headers, block, end = _parse(data, start)
        return [(headers, block)], end
    content, end = _inflate(data, start)
    found, at = [], 0
    while at < len(content):
        headers, block, at = _parse(content, at)
        found.append((headers, block))
    return found, end


def _sound_part(data: memoryview, start: int) -> bytes:
    """What the damaged gzip member at ``start`` inflates to before the first
    error of its coding; all of it where only its sum is wrong."""
    z, parts, at, step = zlib.decompressobj(31), [], start, _PIECE
    while at < len(data) and not z.eof:
        before = z.copy()
        try:
            parts.append(z.decompress(data[at:at + step]))
            at += step
        except zlib.error:
            if step == 1:
                break
            z, step = before, step // 16 or 1
    return b"".join(parts)


def _inside(data: memoryview, start: int) -> list[tuple[dict[str, str], bytes]]:
    """The records of a damaged member, as far as their block digests prove them."""
    if data[start:start + 3] != MEMBER:
        return []
    content = _sound_part(data, start)
    found, at = [], 0
    while (line := _version.search(content, at)) is not None:
        try:
            headers, block, at = _parse(content, line.start())
            if _proved(headers.get("warc-block-digest", "")):
                found.append((headers, block))
        except Damaged:
            at = line.start() + 1
    return found


def salvage(content: bytes) -> Iterator[tuple]:
    """("record", start, end, headers, block) and ("gap", start, end, reason,
    None), in file order. Records in gzip members or plain; the bytes covered
    by records, empty members and gaps are the whole file. A record out of a
    damaged member has the empty range at the member's start, or at the start of
    the gap that the member lies in: its bytes are the gap's."""
    data, at = memoryview(content), 0
    while at < len(content):
        try:
            found, end = _read(data, at)
        except Damaged as broken:
            begin, reason = at, str(broken)
            for headers, block in _inside(data, at):
                yield "record", begin, begin, headers, block
            while True:
                following = _candidate.search(content, at + 1)
                if following is None:
                    yield "gap", begin, len(content), reason, None
                    return
                at = following.start()
                try:
                    found, end = _read(data, at)
                    break
                except Damaged:
                    for headers, block in _inside(data, at):
                        yield "record", begin, begin, headers, block
            yield "gap", begin, at, reason, None
        for headers, block in found:
            yield "record", at, end, headers, block
        at = end


_SCHEMA = ("path string, kind string, start long, end long, reason string, page_id long, url string, record_type string, "
           "payload_bytes long, payload_digest string, refers_to long, record_id string, payload binary")


def _described(headers: dict[str, str], block: bytes) -> tuple:
    """(reason, page_id, url, type, bytes, digest, refers_to, record_id,
    payload); a record whose headers contradict its payload is a gap with that
    reason. Records of other writers have no page_id; of their types all are
    taken, with what their headers say."""
    try:
        kind, name, url = headers["warc-type"], headers["warc-record-id"], headers.get("warc-target-uri")
        page, own = _page_id(name), _own.fullmatch(name)
        said = headers["warc-payload-digest"] if own else headers.get("warc-payload-digest")
        shown = said and said.removeprefix("sha1:")
        if kind == "revisit":
            refers = headers["warc-refers-to"] if own else headers.get("warc-refers-to", "")
            if own and not _own.fullmatch(refers):
                raise ValueError(f"record id {refers!r}")
            size = headers["x-payload-length"] if own else headers.get("x-payload-length", "")
            return None, page, url, kind, int(size) if own or size.isdigit() else None, shown, _page_id(refers), name, None
        http = own or kind in ("response", "request") and headers.get("content-type", "").lower().startswith("application/http")
        head, edge, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
        if own and not edge:
            raise ValueError("no end of the HTTP head")
        if http and not edge:
            payload = b""
        # A digest may be that of the payload without its transfer coding.
        coded = not own and b"\r\ntransfer-encoding:" in head.lower()
        if said and not coded and not _agrees(said, payload):
            raise ValueError("payload digest")
        return None, page, url, kind, len(payload), shown, None, name, payload
    except (KeyError, ValueError) as wrong:
        return (f"unusable record: {wrong}", *[None] * 8)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Everything in the archives under ``path``: rows of kind ``record`` and,
    as quarantine log, rows of kind ``gap`` with their byte range and reason.
    Files are read whole, each by one task; the writer bounds their size. An
    empty file has no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split(" ")[0] for x in _SCHEMA.split(", ")]
        types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split(" ")[1]] for x in _SCHEMA.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                rows: list[tuple] = []
                file = batch.column("path")[i].as_py()
                for kind, start, end, what, block in salvage(batch.column("content")[i].as_py()):
                    reason, *rest = (what, *[None] * 8) if kind == "gap" else _described(what, block)
                    if not with_payload:
                        rest[-1] = None
                    rows.append((file, "record" if reason is None else "gap", start, end, reason, *rest))
                    if len(rows) >= 1_000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, _SCHEMA)
