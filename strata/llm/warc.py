"""WARC records as a table of chunks.

An archive is a table of (record_no, chunk_no, chunks, data, sha1). The data of a record's chunks, joined
in order, are the bytes of one WARC/1.1 record; those of all records are a WARC file. A payload beyond
``CHUNK_BYTES`` spans several rows, which are written and read one at a time: neither side holds more
of a record than a chunk. Each row carries the SHA-1 of the payload up to its end, and the reader works
it out again as it streams, so damage shows at the chunk it sits in.

Records with equal payloads are written once; the others are revisits, which refer to the first.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import attach

CHUNK_BYTES = 64 << 10

#: Bytes of rows gathered before they are handed to Spark.
BATCH_BYTES = 4 << 20

#: Fixed values of the WARC standard.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

ID_PREFIX = "urn:x-page:"

CHUNKS = pa.schema(
    [
        ("record_no", pa.int64()),
        ("chunk_no", pa.int32()),
        ("chunks", pa.int32()),
        ("data", pa.binary()),
        ("sha1", pa.string()),
    ]
)
CHUNKS_SQL = "record_no long, chunk_no int, chunks int, data binary, sha1 string"

RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)
RECORDS_SQL = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _head(page_id, url, kind: str, refers_to, length: int, digest: str, date: str, media: str) -> bytes:
    """The WARC and HTTP header blocks of a record; a revisit's block ends after the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {media}\r\nContent-Length: {length}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(http) + (length if kind == "response" else 0))),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    if kind == "revisit":
        fields += [("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + http


class _Rows:
    """Rows gathered into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, size: int) -> bool:
        self.rows.append(row)
        self.bytes += size + 64
        return self.bytes >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[] for _ in self.schema]
        out = pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        self.rows, self.bytes = [], 0
        return out


def _writer(date: str, media: str, chunk_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record_no = TaskContext.get().partitionId() << 33
        out = _Rows(CHUNKS)
        for batch in batches:
            ids, urls, firsts, digests = (batch.column(n).to_pylist() for n in ("page_id", "url", "first_id", "sha1"))
            payloads = batch.column("payload")
            for i, page_id in enumerate(ids):
                buffer = payloads[i].as_buffer()
                payload = memoryview(buffer) if buffer is not None else memoryview(b"")
                revisit = firsts[i] is not None and firsts[i] != page_id
                kind, refers_to = ("revisit", firsts[i]) if revisit else ("response", None)
                digest = base32(bytes.fromhex(digests[i]))
                head = _head(page_id, urls[i], kind, refers_to, len(payload), digest, date, media)
                body = memoryview(b"") if revisit else payload
                chunks = max(1, -(-len(body) // chunk_bytes))
                running = hashlib.sha1()
                for n in range(chunks):
                    piece = body[n * chunk_bytes : (n + 1) * chunk_bytes]
                    running.update(piece)
                    data = b"".join(((head if n == 0 else b""), piece, (END if n == chunks - 1 else b"")))
                    if out.add((record_no, n, chunks, data, running.hexdigest()), len(data)):
                        yield out.batch()
                record_no += 1
        yield out.batch()

    return write


def write_archive(
    pages: DataFrame,
    path: str,
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    media: str = "text/html; charset=utf-8",
    chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Writes one record per row of (page_id, url, html) to the archive table at ``path``.

    A null html is an empty payload, a null url is left out. Of the rows with equal payloads of at least
    ``least_bytes`` bytes, those with the smallest page_id are responses and the others revisits of it;
    a row without page_id is a revisit unless all of its equals lack one. Rows that repeat the
    smallest page_id are all responses. Columns other than the three are not looked at.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload"))
    firsts = (
        rows.where(F.col("bytes") >= least_bytes)
        .groupBy("sha1", "bytes")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    planned = attach(rows, firsts, ["sha1", "bytes"]).drop("bytes")
    planned.mapInArrow(_writer(date, media, chunk_bytes), CHUNKS_SQL).write.parquet(path)


def _parse(data: memoryview) -> tuple[dict[str, str], int, int]:
    """The header fields of a record, the payload's length as the HTTP header tells, and where it begins.

    ``data`` is the record's first chunk, which holds the whole of both headers, however long its url.
    """
    text = bytes(data)
    end = text.index(END) + len(END)
    lines = text[:end].split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    fields = dict(line.decode().split(": ", 1) for line in lines[1:] if line)
    begin = text.index(END, end) + len(END)
    http = text[end:begin].split(b"\r\n")
    length = next(int(x.split(b":")[1]) for x in http if x.lower().startswith(b"content-length:"))
    stored = int(fields["Content-Length"]) - (begin - end)
    if stored != (length if fields["WARC-Type"] == "response" else 0):
        raise ValueError(f"record {fields['WARC-Record-ID']}: its lengths differ")
    return fields, length, begin


def _id(text: str | None) -> int | None:
    inner = (text or "")[len(ID_PREFIX) + 1 : -1]
    return int(inner) if inner else None


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from chunk rows in order; holds one chunk and the state of one digest."""
    out = _Rows(RECORDS)
    fields, length, seen, running, at = {}, 0, 0, hashlib.sha1(), None
    for batch in batches:
        numbers, places, totals, sums = (batch.column(n).to_pylist() for n in ("record_no", "chunk_no", "chunks", "sha1"))
        data = batch.column("data")
        for i, number in enumerate(numbers):
            view, begin = memoryview(data[i].as_buffer()), 0
            if places[i] == 0:
                fields, length, begin = _parse(view)
                seen, running, at = 0, hashlib.sha1(), (number, -1)
            if (number, places[i] - 1) != at:
                raise ValueError(f"record {number}: chunk {places[i]} follows {at}")
            at = (number, places[i])
            last = places[i] == totals[i] - 1
            if last and bytes(view[-len(END) :]) != END:
                raise ValueError(f"record {number} is cut off")
            piece = view[begin : len(view) - len(END) if last else len(view)]
            running.update(piece)
            seen += len(piece)
            if running.hexdigest() != sums[i]:
                raise ValueError(f"record {number}: chunk {places[i]} is damaged")
            if last:
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and (seen != length or base32(running.digest()) != digest):
                    raise ValueError(f"record {number}: the payload does not fit its header")
                url = fields.get("WARC-Target-URI")
                if url is not None:
                    url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                row = (_id(fields["WARC-Record-ID"]), url, length, digest, kind, _id(fields.get("WARC-Refers-To")))
                if out.add(row, 256 + len(url or "")):
                    yield out.batch()
    yield out.batch()


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive, its payload checked against its digests.

    Records of one chunk are read where they lie; only the chunks of longer ones are brought together,
    in order, and streamed.
    """
    chunks = spark.read.schema(CHUNKS_SQL).parquet(path)
    whole = chunks.where("chunks = 1").mapInArrow(_reader, RECORDS_SQL)
    long = chunks.where("chunks > 1").repartition("record_no").sortWithinPartitions("record_no", "chunk_no")
    return whole.unionByName(long.mapInArrow(_reader, RECORDS_SQL))
