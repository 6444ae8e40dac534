"""Web archives as a table of chunks: rows (record_id, chunk, data) whose data in order are WARC records."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexloom.llm.store import keep

#: Payload bytes of a chunk.
CHUNK = 1 << 18
#: Payloads of at least so many bytes are stored once; equal ones refer to the first.
LEAST = 100

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_COLUMNS = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _header(page: dict, record: str, body: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {page['record_type']}", f"WARC-Record-ID: <urn:uuid:{record}>", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {(page['url'] or '').translate({13: ' ', 10: ' '})}", f"WARC-Payload-Digest: sha256:{page['payload_digest']}", "Content-Type: application/http; msgtype=response", f"Content-Length: {body}", f"X-Payload-Length: {page['payload_bytes']}"]
    lines += [] if page["page_id"] is None else [f"X-Page-ID: {page['page_id']}"]
    lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {page['refers_to']}"] if page["record_type"] == "revisit" else []
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of each page's record: the headers, the payload in slices that share its memory, the end."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        c = list(zip(*rows, strict=True))
        return pa.record_batch([pa.array(c[0], pa.string()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.binary())], ["record_id", "chunk", "data"])

    for frame in frames:
        rows: list[tuple] = []
        size = 0
        columns = [frame.column(c).to_pylist() for c in _COLUMNS]
        records, payloads = frame.column("record_id").to_pylist(), frame.column("payload")
        for i, record in enumerate(records):
            page = dict(zip(_COLUMNS, (c[i] for c in columns), strict=True))
            payload = payloads[i].as_buffer() if page["record_type"] == "response" else b""
            rows.append((record, 0, _header(page, record, len(_HTTP) + len(payload)) + _HTTP))
            n = 1
            for at in range(0, len(payload), CHUNK):
                rows.append((record, n, memoryview(payload)[at : at + CHUNK]))
                n += 1
                size += CHUNK if at + CHUNK <= len(payload) else len(payload) - at
                if size >= 16 * CHUNK:
                    yield batch(rows)
                    rows, size = [], 0
            rows.append((record, n, b"\r\n\r\n"))
        if rows:
            yield batch(rows)


class _Record:
    """A record whose chunks come one by one: its header, and the payload's digest so far."""

    def __init__(self, record_id: str, first: bytes) -> None:
        head, _, rest = first.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"record {record_id} does not begin with a WARC header")
        self.fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        self.left = int(self.fields["Content-Length"])
        self.http, self.payload, self.digest = b"", 0, hashlib.sha256()
        self.begun = False
        self.add(rest)

    def add(self, data: bytes) -> None:
        data = memoryview(data)[: self.left]
        self.left -= len(data)
        if not self.begun:
            self.http += bytes(data)
            head, end, body = self.http.partition(b"\r\n\r\n")
            if not end:
                return
            self.begun, data = True, body
        self.digest.update(data)
        self.payload += len(data)

    def row(self) -> tuple:
        get = self.fields.get
        revisit = get("WARC-Type") == "revisit"
        said = get("WARC-Payload-Digest", "").removeprefix("sha256:")
        if self.left or not revisit and self.digest.hexdigest() != said:
            raise ValueError(f"record of page {get('X-Page-ID')} is damaged")
        page, refers = get("X-Page-ID"), get("X-Refers-To-Page")
        return (None if page is None else int(page), get("WARC-Target-URI"), int(get("X-Payload-Length")) if revisit else self.payload, said if revisit else self.digest.hexdigest(), get("WARC-Type"), int(refers) if refers else None)


def _read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        c = list(zip(*rows, strict=True))
        return pa.record_batch([pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], list(_COLUMNS))

    last, record = None, None
    for frame in frames:
        rows: list[tuple] = []
        for record_id, data in zip(frame.column("record_id").to_pylist(), frame.column("data"), strict=True):
            if record_id != last:
                if record:
                    rows.append(record.row())
                last, record = record_id, _Record(record_id, data.as_py())
            else:
                record.add(data.as_buffer())
        if rows:
            yield batch(rows)
    if record:
        yield batch([record.row()])


def write_archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The written archive: (record_id, chunk, data), a WARC record per page.

    Of pages with equal payloads of LEAST bytes or more, that with the smallest id is a response and the others revisit it.
    Which payloads recur is a combined aggregate of digests; payloads go through one join on their digest, in which Spark
    can split a digest of very many pages. A null html is empty. Pages of null id revisit one with an id, and are
    responses if there is none. Rows that repeat an id and its payload are responses each. An empty table gives an empty archive.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    source = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    source = source.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    large = source.where(F.col("payload_bytes") >= LEAST).groupBy("payload_digest").agg(F.min("page_id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = source.join(large, "payload_digest", "left")
    revisit = F.col("rep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("rep"))
    records = met.select(F.expr("uuid()").alias("record_id"), "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("rep")).alias("refers_to"))
    return keep(records.mapInArrow(_write, "record_id string, chunk long, data binary"), "warc")


def read_archive(chunks: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of the records of a table of chunks.

    A record's chunks come one after the other, and its digest is carried from one to the next: no record is ever held
    whole. A record whose length or digest is not as its header says ends the read with an error. A page without an id has none
    here, and a null url is an empty one; an empty archive gives an empty result.
    """
    dealt = chunks.repartition("record_id").sortWithinPartitions("record_id", "chunk")
    return dealt.mapInArrow(_read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def export_warc(chunks: DataFrame, path: str) -> int:
    """Write the records to one .warc file at a local path, chunk by chunk; the number of bytes. For archives that one disk can hold."""
    size = 0
    with open(path, "wb") as f:
        for row in chunks.orderBy("record_id", "chunk").toLocalIterator():
            size += f.write(row.data)
    return size
