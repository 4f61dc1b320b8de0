"""Operator 5: WARC archives, written with an index and read back by it.

Every task writes its rows as one archive: each record is a gzip member of
its own, so a byte range holds a record. The index - file, offset, length,
URL, digest - comes from the same tasks and is saved as a table before
anything is read. Archives get a new name at every attempt and only the
index of the attempt that succeeded names them, so a lost executor or a
repeated task leaves a file that nothing refers to, never a wrong one.

Reading selects index rows, sorts them by file and offset, joins ranges that
lie close together into one read of bounded size, and parses the records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.rows import saved
from recsift.session import checkpoint_dir

MIN_REVISIT_BYTES = 100
# Ranges at most so far apart are read together, up to so many bytes.
MAX_GAP = 64 << 10
MAX_READ = 8 << 20
# Bytes of records that one task reads.
TASK_BYTES = 16 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = ("page_id long, url string, file string, offset long, length long, digest string, "
         "payload_bytes long, record_type string, refers_to long")
_INDEX_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()),
                          ("offset", pa.int64()), ("length", pa.int64()), ("digest", pa.string()),
                          ("payload_bytes", pa.int64()), ("record_type", pa.string()),
                          ("refers_to", pa.int64())])
_READ = ("page_id long, url string, record_type string, refers_to long, payload_digest string, "
         "payload_bytes long, payload binary")
_READ_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                         ("refers_to", pa.int64()), ("payload_digest", pa.string()),
                         ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _plain_uri(uri: str) -> str:
    """Hadoop's names of a file system as Arrow knows them."""
    return re.sub(r"^dbfs:/+", "/dbfs/", re.sub(r"^s3[an]:", "s3:", uri))


def _file_system(uri: str) -> tuple[FileSystem, str]:
    """The file system of a URI, or the local one of a plain path."""
    uri = _plain_uri(uri)
    return FileSystem.from_uri(uri) if re.match(r"[a-z0-9]+:", uri) else (LocalFileSystem(), uri)


def _field(value: object) -> bytes:
    """A header's value on one line."""
    return re.sub(rb"[\r\n]+", b" ", str(value).encode())


def _record_id(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % _field("" if page_id is None else page_id)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool, date: str) -> bytes:
    """One WARC record as a gzip member."""
    body = _HTTP % len(payload) + (b"" if revisit else payload)
    head = [(b"WARC-Type", b"revisit" if revisit else b"response"), (b"WARC-Record-ID", _record_id(page_id)),
            (b"WARC-Date", date.encode()), (b"WARC-Target-URI", _field(url or "")),
            (b"WARC-Payload-Digest", b"sha256:" + digest.encode()),
            (b"Content-Type", b"application/http;msgtype=response")]
    if revisit:
        head += [(b"WARC-Profile", _PROFILE), (b"WARC-Refers-To", _record_id(refers_to))]
    head.append((b"Content-Length", b"%d" % len(body)))
    raw = b"WARC/1.1\r\n" + b"".join(b"%s: %s\r\n" % h for h in head) + b"\r\n" + body + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def parse(member: bytes) -> dict:
    """The fields of :data:`_READ` from a record's gzip member. A revisit has
    the length of the full payload from its stored HTTP header, no payload."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != b"WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(b": ", 1) for line in lines[1:])
    body = rest[:int(fields[b"Content-Length"])]
    if rest[len(body):] != b"\r\n\r\n":
        raise ValueError("WARC record of wrong length")
    http, _, payload = body.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode()
    kind = fields[b"WARC-Type"].decode()
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("WARC payload does not match its digest")

    def page(name: bytes) -> int | None:
        text = fields.get(name, b"<urn:page:>")[10:-1]
        return int(text) if text else None

    return {"page_id": page(b"WARC-Record-ID"), "url": fields[b"WARC-Target-URI"].decode(), "record_type": kind,
            "refers_to": page(b"WARC-Refers-To"), "payload_digest": digest, "payload_bytes": length,
            "payload": payload if kind == "response" else None}


def _write(folder: str, date: str):
    def run(batches):
        out = None
        fs, base = _file_system(folder)
        name = f"{uuid.uuid4()}.warc.gz"
        offset = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
            index = []
            for r in batch.to_pylist():
                payload = (r["html"] or "").encode()
                revisit = r["refers_to"] is not None
                data = record(r["page_id"], r["url"], payload, r["digest"], r["refers_to"], revisit, date)
                out.write(data)
                index.append({"page_id": r["page_id"], "url": r["url"], "file": name, "offset": offset,
                              "length": len(data), "digest": r["digest"], "payload_bytes": len(payload),
                              "record_type": "revisit" if revisit else "response", "refers_to": r["refers_to"]})
                offset += len(data)
            yield pa.RecordBatch.from_pylist(index, schema=_INDEX_ARROW)
        if out is not None:
            out.close()  # the task succeeds only after its archive is complete
    return run


def ranges(rows: list[tuple[str, int, int]], gap: int = MAX_GAP, most: int = MAX_READ) -> Iterator[list[int]]:
    """Positions of sorted ``(file, offset, length)`` rows that one read covers."""
    group: list[int] = []
    for i, (file, offset, length) in enumerate(rows):
        if group:
            first, last = rows[group[0]], rows[group[-1]]
            if file != first[0] or offset - (last[1] + last[2]) > gap or offset + length - first[1] > most:
                yield group
                group = []
        group.append(i)
    if group:
        yield group


def _read(folder: str):
    def run(batches):
        fs, base = _file_system(folder)
        for batch in batches:
            rows = sorted(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            for group in ranges(rows):
                file, start, _ = rows[group[0]]
                stop = max(rows[i][1] + rows[i][2] for i in group)
                with fs.open_input_file(f"{base}/{file}") as source:
                    data = source.read_at(stop - start, start)
                yield pa.RecordBatch.from_pylist(
                    [parse(data[rows[i][1] - start:rows[i][1] - start + rows[i][2]]) for i in group],
                    schema=_READ_ARROW)
    return run


def write_archives(pages: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for every row of ``pages`` (page_id, url, html) to
    archives under ``folder`` and returns the index (:data:`INDEX`), saved.

    Payload: html in UTF-8 (null: empty). Of records with equal payloads of at
    least 100 bytes those with the smallest page_id are responses and the
    others revisit it; smaller ones are all responses. A null page_id is no
    smallest one; if all are null, all are responses. Repeated rows get a
    record each. Other columns are not read. An empty table: no archive.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.sha2(html, 256).alias("digest"))
    large = F.octet_length("html") >= MIN_REVISIT_BYTES
    first = (rows.filter(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("digest", "first"))
    # hot payloads: adaptive execution splits their rows, each meeting one row of `first`
    named = rows.join(first, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()), F.col("first"))
        .alias("refers_to"))
    fs, base = _file_system(folder)
    fs.create_dir(base, recursive=True)
    return saved(named.mapInArrow(_write(folder, date), INDEX))


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Records of the index rows given (:data:`_READ`), each read from its
    byte range; ranges close together are read at once. Tasks are as many as
    the bytes to read ask for, whatever the size of the index."""
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-int(size) // TASK_BYTES))
    wanted = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset") \
        .sortWithinPartitions("file", "offset")
    return wanted.mapInArrow(_read(folder), _READ)


def new_folder(df: DataFrame) -> str:
    """A fresh folder for archives under the shared checkpoint folder."""
    return f"{checkpoint_dir(df.sparkSession)}/warc-{uuid.uuid4()}"
