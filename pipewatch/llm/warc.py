"""WARC archives: one gzip member per record, read back sequentially.

Tasks write archives straight to a folder that all executors see and return a
manifest of the files they finished; a retried task writes new files, and only
files in the manifest count.  Tasks read archives as streams: zlib works
member by member, the record's Content-Length frames its block, and digests
are checked as the bytes go by, so no archive or payload is held whole.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewatch.llm.common import saved
from pipewatch.session import work_dir

#: Payloads of at least so many bytes are written once and revisited.
REVISIT_BYTES = 1000
#: Compressed bytes after which a task starts another archive.
ARCHIVE_BYTES = 64 << 20
#: Compressed bytes read at a time.
CHUNK = 1 << 18
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n"

MANIFEST = "path string, records bigint, bytes bigint"
RECORDS = "page_id bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, target_uri string, problem string"


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file and its path there."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() and c.isascii() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, length: int, digest: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record.  A revisit's block is the response's head alone,
    which tells the length of the payload it stands for."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http if revisit else http + payload
    sha1 = lambda d: "sha1:" + base64.b32encode(d).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Target-URI: {_line(url or '')}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: {sha1(digest)}",
        f"WARC-Block-Digest: {sha1(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + END * 2 + block + END * 2


def planned(pages: DataFrame, at_least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``payload`` (binary) and ``refers_to`` (null for
    responses) for every row of ``pages`` (page_id, url, html).

    Of equal payloads of at least ``at_least`` bytes the largest page_id is the
    response; rows that repeat that id are all responses, and rows without an
    id never are if another row has one.  A null html is an empty payload."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("key", F.sha2("payload", 256))
    big = F.octet_length("payload") >= at_least
    last = saved(rows.where(big).groupBy("key").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("key", "last"), "warc_groups")
    other = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return rows.join(last, "key", "left").select("page_id", "url", "payload", other.alias("refers_to"))


def write_warc(planned_rows: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of :func:`planned` and return the manifest (path,
    records, bytes) as a table.  An empty input writes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = filesystem(folder)
        out, path, count, size, done = None, "", 0, 0, []
        for b in batches:
            for page_id, url, payload, refers_to in zip(*(b.column(i) for i in range(4)), strict=True):
                if out is None:
                    files.create_dir(base, recursive=True)
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out, count, size = files.open_output_stream(path, compression=None), 0, 0
                data, refers = payload.as_py(), refers_to.as_py()
                raw = record(page_id.as_py(), url.as_py(), data, len(data), hashlib.sha1(data).digest(), refers, refers is not None, date)
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                packed = member.compress(raw) + member.flush()
                out.write(packed)
                count, size = count + 1, size + len(packed)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["path", "records", "bytes"])

    return saved(planned_rows.mapInArrow(run, MANIFEST), "warc_manifest")


class Members:
    """The gzip members of a stream in turn.  :meth:`read` gives the next
    bytes of the current member, empty at its end; :meth:`following` moves on
    and tells whether there is another member."""

    def __init__(self, stream):
        self.stream, self.raw, self.inflate = stream, b"", None

    def following(self) -> bool:
        if self.inflate is not None:
            while not self.inflate.eof:
                if not self.read():
                    break
            self.raw = self.inflate.unused_data or self.raw
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
        self.inflate = zlib.decompressobj(31)
        return bool(self.raw)

    def read(self) -> bytes:
        while not self.inflate.eof:
            raw = self.raw or self.stream.read(CHUNK)
            out = self.inflate.decompress(raw, CHUNK)
            if not raw and not out and not self.inflate.eof:
                raise ValueError("archive ends inside a member")
            self.raw = self.inflate.unconsumed_tail or self.inflate.unused_data
            if out:
                return out
        return b""


def _head(members: Members, buffer: bytes) -> tuple[dict[str, str], bytes]:
    """The header lines up to the blank line, and the bytes after it."""
    while END * 2 not in buffer:
        more = members.read()
        if not more:
            raise ValueError("record without a complete header")
        buffer += more
    head, _, rest = buffer.partition(END * 2)
    lines = head.decode("utf-8").split("\r\n")
    named = dict(x.split(": ", 1) for x in lines[1:])
    return {"": lines[0], **{k.lower(): v for k, v in named.items()}}, rest


def _one(members: Members) -> tuple:
    """Read one record: its row, with ``problem`` null if all agrees."""
    head, buffer = _head(members, b"")
    if not head[""].startswith("WARC/"):
        raise ValueError("not a WARC record")
    left = int(head["content-length"])
    block, payload, length = hashlib.sha1(), hashlib.sha1(), 0
    http, inner = b"", None
    while True:
        part = buffer[:left]
        left -= len(part)
        block.update(part)
        if inner is None:
            http += part
            if END * 2 in http:
                lines, _, body = http.partition(END * 2)
                inner = dict(x.lower().split(": ", 1) for x in lines.decode().split("\r\n")[1:])
                payload.update(body)
                length += len(body)
        else:
            payload.update(part)
            length += len(part)
        if not left:
            buffer = buffer[len(part) :]
            break
        buffer = members.read()
        if not buffer:
            raise ValueError("block is shorter than Content-Length")
    while more := members.read():
        buffer += more
    kind = head["warc-type"]
    sha1 = lambda name: base64.b32decode(head[name].removeprefix("sha1:")).hex()
    digest, problem = sha1("warc-payload-digest"), None
    if buffer != END * 2:
        problem = "record does not end after its block"
    elif sha1("warc-block-digest") != block.hexdigest():
        problem = "block digest differs"
    elif inner is None:
        problem = "no response head"
    elif kind == "response" and (digest != payload.hexdigest() or int(inner["content-length"]) != length):
        problem = "payload digest or length differs"
    page, refers = head.get("x-page-id"), head.get("x-refers-to-page")
    size = length if kind == "response" else int((inner or {}).get("content-length", 0))
    return (int(page) if page else None, kind, size, digest, int(refers) if refers else None, head.get("warc-target-uri"), problem)


def read_archive(stream) -> Iterator[tuple]:
    """Rows of one archive, in order."""
    members = Members(stream)
    while members.following():
        yield _one(members)


def read_warc(archives: DataFrame, parts: int | None = None) -> DataFrame:
    """A row per record of the archives in column ``path``: page_id,
    record_type, payload_bytes, payload_digest (lower-case hex), refers_to,
    target_uri and ``problem``, null if framing and digests agree.  A broken
    archive (cut short, not gzip, no header) fails the job.  For a revisit,
    length and digest are those of the payload it stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        for b in batches:
            for path in b.column(0).to_pylist():
                files, p = filesystem(path)
                rows = []
                with files.open_input_stream(p, compression=None) as stream:
                    for row in read_archive(stream):
                        rows.append(row)
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    paths = archives.select("path")
    return paths.repartition(parts or max(1, min(10_000, archives.count()))).mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all ``pages`` to archives and read them back; see :func:`planned`
    and :func:`read_warc`.  A record that does not verify fails the job."""
    folder = folder or work_dir(pages.sparkSession, "llm", "warc_archives")
    found = read_warc(write_warc(planned(pages), folder))
    sound = F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(F.raise_error(F.concat(F.lit("WARC record: "), F.col("problem"))))
    return found.withColumn("record_type", sound)
