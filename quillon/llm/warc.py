"""WARC archives: a writer of gzip members and a reader that splits files at any byte."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._store import BROADCAST_IDS, saved

MAGIC = b"\x1f\x8b\x08"
#: Shorter payloads are always stored as responses.
LEAST_REVISIT = 100
#: A writing task begins another file after so many bytes.
FILE_BYTES = 256 << 20
#: Bytes of a file that one step of a reading task owns.
RANGE_BYTES = 8 << 20
_CHUNK = 1 << 20
_ID = re.compile(r"<urn:quillon:page:(-?\d+)>")


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or local path, and the path on it."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _one_line(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; with refers_to a revisit without the payload."""
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        block = f"{head}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
        kind, extra = "response", ""
    else:
        block, kind = f"{head}\r\n".encode(), "revisit"
        extra = f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:quillon:page:{refers_to}>\r\n"
    own = f"<urn:quillon:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"
    uri = f"WARC-Target-URI: {_one_line(url)}\r\n" if url else ""
    top = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {own}\r\nWARC-Date: {date}\r\n{uri}{extra}WARC-Payload-Digest: sha256:{digest}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
    return top.encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """The data as one gzip member; the same bytes each time."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _write(folder: str, date: str, level: int) -> Callable:
    """Rows (page_id, url, html, digest, refers_to) to (file, size), a row for each closed file.

    Each attempt writes under names of its own, and only those that a finished task
    returns are ever read: what a lost executor leaves behind does no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        files.create_dir(root, recursive=True)
        out, name, size = None, "", 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "size": [size]})

        for rows in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                data = member(record(page_id, url, (html or "").encode(), digest, refers_to, date), level)
                out.write(data)
                size += len(data)
                if size >= FILE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return run


def write(pages: DataFrame, folder: str, least: int = LEAST_REVISIT, date: str = "1970-01-01T00:00:00Z", level: int = 6, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per row below ``folder``; (file, size) of the archives, a written table.

    Of rows with equal payloads of at least ``least`` bytes those with the smallest id
    become responses (repeated rows all), the others revisits that refer to it. Digests
    are grouped without the payloads; the revisits' ids then go to the payloads' tasks if
    they are few, else both are shuffled. Null html is an empty payload; a null url is
    left out; a row with a null id is a response. No rows, no files.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    narrow = saved(rows.where((F.octet_length("html") >= least) & F.col("page_id").isNotNull()).select("page_id", "digest"), "payloads")
    # A written table is shuffled for the join by itself, so the rows of a payload that very many pages share can be split over tasks.
    firsts = saved(narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "firsts")
    revisits = saved(narrow.join(firsts, "digest").where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct(), "revisits")
    if revisits.count() <= BROADCAST_IDS // 4:
        revisits = F.broadcast(revisits)
    rows = rows.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")
    return saved(rows.mapInArrow(_write(folder, date, level), "file string, size long"), "archives")


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields (names in lower case) and block of a WARC record; None if it isn't a whole one."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not re.fullmatch(r"WARC/[01]\.\d+", lines[0]):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = fields.get("content-length", "")
    if not length.isdigit() or "warc-type" not in fields or len(rest) < int(length):
        return None
    return fields, rest[: int(length)]


class _Window:
    """Bytes of a file from any position on, read in chunks and kept while needed."""

    def __init__(self, source, size: int, start: int):
        self.source, self.size, self.start, self.data = source, size, start, bytearray()

    def drop(self, to: int) -> None:
        """Forget what lies before position ``to``."""
        del self.data[: to - self.start]
        self.start = to

    def more(self) -> bool:
        at = self.start + len(self.data)
        if at >= self.size:
            return False
        self.source.seek(at)
        self.data += self.source.read(min(_CHUNK, self.size - at))
        return True


def _inflate(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The gzip member that begins at a position, and where it ends; None if none does.

    The first bytes that come out must begin a WARC header, so a chance magic number
    costs a few bytes, not a whole file.
    """
    z, out, pos, seen, step = zlib.decompressobj(31), [], at, 0, 1 << 14
    try:
        while not z.eof:
            part = bytes(window.data[pos - window.start : pos - window.start + step])
            if not part:
                if not window.more():
                    return None
                continue
            out.append(z.decompress(part))
            seen += len(out[-1])
            pos += len(part)
            step = min(2 * step, _CHUNK)
            if seen >= 5 and not b"".join(out[:3])[:5] == b"WARC/":
                return None
        return b"".join(out), pos - len(z.unused_data)
    except zlib.error:
        return None


def records_in(source, size: int, start: int, stop: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, block) of the records that start in [start, stop) of a file.

    The range is searched for the gzip magic; a candidate counts if its member inflates,
    checksum included, and is a whole WARC record. The next record is then expected at
    its end; where none is valid the search goes on. The last one may end beyond stop.
    """
    window, at = _Window(source, size, start), start
    while at < stop:
        found = window.data.find(MAGIC, at - window.start)
        if found < 0:
            at = max(at, window.start + len(window.data) - len(MAGIC) + 1)
            window.drop(at)
            if not window.more():
                return
            continue
        at = window.start + found
        if at >= stop:
            return
        window.drop(at)
        got = _inflate(window, at)
        parsed = parse(got[0]) if got else None
        if parsed:
            yield at, *parsed
            at = got[1]
        else:
            at += 1


def _page(field: str | None) -> int | None:
    found = _ID.fullmatch(field or "")
    return int(found[1]) if found else None


def _read(with_payload: bool) -> Callable:
    names = ["file", "offset", "record_type", "page_id", "url", "refers_to", "payload_bytes", "payload_digest", "stated_digest"] + ["payload"] * with_payload
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for file, size, start in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                files, path = filesystem(file)
                with files.open_input_file(path) as source:
                    out, held = [], 0
                    for offset, fields, block in records_in(source, size, start, min(start + RANGE_BYTES, size)):
                        payload = block.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else None
                        own = None if payload is None else hashlib.sha256(payload).hexdigest()
                        stated = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
                        out.append((file, offset, fields["warc-type"], _page(fields.get("warc-record-id")), fields.get("warc-target-uri"), _page(fields.get("warc-refers-to")), None if payload is None else len(payload), own, stated, payload)[: len(names)])
                        held += len(block)
                        if len(out) >= 2000 or held >= 16 << 20:
                            yield _batch(out, names, types)
                            out, held = [], 0
                    if out:
                        yield _batch(out, names, types)

    return run


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def read(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of archives (file, size): each byte range of RANGE_BYTES is a row, dealt over tasks.

    (file, offset, record_type, page_id, url, refers_to, payload_bytes, payload_digest,
    stated_digest): bytes and digest are of the payload as read, null for records without
    one. Null or empty files give no rows; members that are no whole record are passed over.
    A file that is named twice is read twice. Only file and size are used of ``archives``,
    whatever other columns it has.
    """
    spark: SparkSession = archives.sparkSession
    ranges = archives.where("size > 0").select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(RANGE_BYTES))).alias("start"))
    tasks = max(spark.sparkContext.defaultParallelism, min(ranges.count(), 100_000))
    ranges = ranges.repartition(tasks, "file", "start")
    schema = "file string, offset long, record_type string, page_id long, url string, refers_to long, payload_bytes long, payload_digest string, stated_digest string"
    return ranges.mapInArrow(_read(with_payload), schema + ", payload binary" * with_payload)


def resolved(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), a revisit's payload being that of the record it refers to.

    Several responses with one page_id: the revisit takes the one whose digest it states, and
    repeated ones have equal bytes. A revisit whose response is not there has null bytes and
    digest. Records are returned each, repeated ones too; other columns are ignored.
    """
    records = saved(records.select("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "stated_digest"), "records")
    own = records.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    targets = own.groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated_digest")).agg(F.max("payload_bytes").alias("payload_bytes"))
    targets = saved(targets, "targets")  # for the same reason as in write
    again = records.where("record_type = 'revisit'").select("page_id", "refers_to", "stated_digest", "record_type")
    again = again.join(targets, ["refers_to", "stated_digest"], "left").select("page_id", "payload_bytes", F.when(F.col("payload_bytes").isNotNull(), F.col("stated_digest")).alias("payload_digest"), "record_type", "refers_to")
    return own.unionAll(again)


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), q AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM q
"""
