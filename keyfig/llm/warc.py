"""WARC archives written from and read back into a chunked record table.

A payload is a sequence of rows (record, chunk number, bytes) of at most ``CHUNK_BYTES``.  The
writer streams these rows into gzip members, one per record, updating a SHA-1 as chunks pass,
and returns an index of file, offset and length.  The reader takes byte ranges of an archive as
tasks and streams each record back into chunk rows that carry the digest and the byte count so
far; neither side ever holds a whole payload in Python.

Archives lie in the cluster's shared folder; a retried task writes a file of its own, and only
files in the stored index are read.

Defined results: a null payload is empty; a null id is written as an empty one and read back as
null; a null URL gives no target line.  Repeated rows are a record each; those of one id and one
payload have one role; large responses are named by their payload, so that repeated rows share the
name.  Extra columns, whatever their names, are left out.  Payloads under ``REVISIT_BYTES`` are always responses.  A group of equal
payloads without any id is all responses.  An empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from keyfig.llm.common import lookup, shuffle_parts, stored
from keyfig.session import work_path

CHUNK_BYTES = 256 << 10
REVISIT_BYTES = 1000
#: Compressed bytes of an archive that one read task takes.
RANGE_BYTES = 4 << 20
#: Compressed bytes that a read task takes where there are more than the shuffle partitions would.
TASK_BYTES = 32 << 20
#: Chunk bytes of a record batch on its way out of a read task.
BATCH_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"

INDEX = "record_id string, file string, offset long, length long"
CHUNKS = ("page_id string, url string, record_type string, refers_to string, record_id string, "
          "chunk_no long, data binary, bytes_so_far long, sha1_so_far string, last boolean, "
          "payload_bytes long, payload_digest string")


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Per row: id, url, payload bytes, its length and SHA-1, and the record's role."""
    data = F.coalesce(F.encode(F.col(f"`{payload}`"), "UTF-8"), F.lit(b""))
    base = (pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), data.alias("payload"))
            .withColumn("n_bytes", F.octet_length("payload").cast("long"))
            .withColumn("digest", F.when(F.col("n_bytes") >= REVISIT_BYTES, F.sha1("payload"))))
    equal = stored(base.where("digest is not null").groupBy("digest")
                   .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
                   .where("n > 1 and response is not null"), "warc_equal")
    joined = lookup(base, equal, ["digest"], "n")
    revisit = F.col("response").isNotNull() & ~F.col("response").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", "n_bytes", F.coalesce("digest", F.sha1("payload")).alias("digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response")).alias("refers_to"),
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))


def chunked(recs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table: consecutive rows per record, an empty payload has one."""
    last = F.greatest(F.ceil(F.octet_length("payload") / chunk_bytes) - 1, F.lit(0)).cast("int")
    # the numbers are exploded, not the pieces: one piece at a time is cut from the payload
    numbered = recs.select("*", last.alias("last_no"), F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    return numbered.select("page_id", "url", "n_bytes", "digest", "record_type", "refers_to", "last_no", "chunk_no",
                           F.substring(F.col("payload"), F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("data"))


def _line(text: str) -> str:
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def write(table: DataFrame, folder: str) -> DataFrame:
    """Writes a chunk table as one archive per task; returns the stored index of records."""
    names = ["page_id", "url", "n_bytes", "digest", "record_type", "refers_to", "last_no", "chunk_no", "data"]
    sent = table.select(*(F.col(c).cast("string") if c in ("page_id", "refers_to") else F.col(c) for c in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        out, file, index, packer, n = None, "", [], None, 0
        for batch in batches:
            small = batch.select(names[:-1]).to_pylist()
            for row, data in zip(small, batch.column(len(names) - 1), strict=True):
                if out is None:
                    where, path = fs.FileSystem.from_uri(folder)
                    file = f"part-{uuid.uuid4().hex}.warc.gz"
                    where.create_dir(path, recursive=True)
                    out = where.open_output_stream(f"{path}/{file}", compression=None)
                revisit = row["record_type"] == "revisit"
                if row["chunk_no"] == 0:
                    at, seen = out.tell(), hashlib.sha1()
                    # what revisits refer to is named by its payload, so that they need not know where it is
                    named = f"urn:x-payload:{row['digest']}"
                    record = named if not revisit and row["n_bytes"] >= REVISIT_BYTES and row["page_id"] is not None else f"urn:x-record:{file[5:37]}:{n}"
                    packer, n = zlib.compressobj(1, zlib.DEFLATED, 31), n + 1
                    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{record}>", f"WARC-Date: {DATE}",
                            f"X-Page-ID: {'' if row['page_id'] is None else _line(row['page_id'])}", f"X-Payload-Length: {row['n_bytes']}",
                            "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()]
                    if row["url"] is not None:
                        head.append(f"WARC-Target-URI: {_line(row['url'])}")
                    if revisit:
                        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                                 f"WARC-Refers-To: <{named}>", f"X-Refers-To-Page-ID: {_line(row['refers_to'])}"]
                    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if revisit else row['n_bytes']}"]
                    out.write(packer.compress(("\r\n".join(head) + "\r\n\r\n").encode()))
                piece = data.as_buffer()
                seen.update(piece)
                out.write(packer.compress(piece))
                if row["chunk_no"] == row["last_no"]:
                    if not revisit and seen.hexdigest() != row["digest"]:
                        raise ValueError(f"record {record}: the chunks do not add up to the payload's digest")
                    out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                    index.append((record, f"{folder}/{file}", at, out.tell() - at))
                    if len(index) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*index, strict=True)], names=["record_id", "file", "offset", "length"])
                        index = []
        if out is not None:
            out.close()
        if index:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*index, strict=True)], names=["record_id", "file", "offset", "length"])

    return stored(sent.mapInArrow(run, INDEX), "warc_index")


class _Reader:
    """Streams the records of a byte range of an archive into chunk rows."""

    def __init__(self, stream, size: int, chunk_bytes: int):
        self.stream, self.left, self.chunk_bytes = stream, size, chunk_bytes
        self.zip, self.raw, self.buffer, self.ended = None, b"", bytearray(), False

    def fill(self, want: int) -> None:
        """At least ``want`` bytes of the current record into the buffer, if it has as many."""
        while len(self.buffer) < want and not self.ended:
            if not self.raw:
                if not self.left:
                    raise ValueError("the archive ends within a record")
                self.raw = self.stream.read(min(self.chunk_bytes, self.left))
                self.left -= len(self.raw)
            self.buffer += self.zip.decompress(self.raw, max(want, 1 << 16))
            self.raw = self.zip.unconsumed_tail or self.zip.unused_data
            self.ended = self.zip.eof

    def take(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def rows(self) -> Iterator[dict]:
        while self.raw or self.left:
            self.zip, self.ended, want = zlib.decompressobj(31), False, 4096
            self.fill(want)
            while (end := self.buffer.find(b"\r\n\r\n")) < 0 and not self.ended:
                want *= 2
                self.fill(want)
            lines = self.take(end + 4)[:-4].decode().split("\r\n")
            head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            left, done, no, digest = int(head["Content-Length"]), 0, 0, hashlib.sha1()
            revisit = head["WARC-Type"] == "revisit"
            claimed = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            while True:
                n = min(left, self.chunk_bytes)
                self.fill(n)
                data = self.take(n)
                digest.update(data)
                left, done = left - n, done + n
                if not left and not revisit and digest.hexdigest() != claimed:
                    raise ValueError(f"{head['WARC-Record-ID']}: the payload does not have its digest")
                yield {"page_id": _unline(head["X-Page-ID"]) or None, "url": _unline(head["WARC-Target-URI"]) if "WARC-Target-URI" in head else None,
                       "record_type": head["WARC-Type"], "refers_to": _unline(head["X-Refers-To-Page-ID"]) if revisit else None,
                       "record_id": head["WARC-Record-ID"][1:-1], "chunk_no": no, "data": data, "bytes_so_far": done,
                       "sha1_so_far": digest.hexdigest(), "last": not left,
                       "payload_bytes": int(head["X-Payload-Length"]), "payload_digest": claimed}
                no += 1
                if not left:
                    break
            self.fill(4)
            if self.take(4) != b"\r\n\r\n":
                raise ValueError(f"{head['WARC-Record-ID']}: no end of record")
            while not self.ended:  # the member's trailer
                self.fill(1)


def read(spark: SparkSession, index: DataFrame, chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The chunked record table of the archives that an index names."""
    ranges = (index.groupBy("file", F.floor(F.col("offset") / range_bytes).alias("no"))
              .agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop")))
    # a range's row is a few bytes, so the number of tasks is stated: it follows the bytes to read
    size = ranges.agg(F.count("*").alias("n"), F.sum(F.col("stop") - F.col("start")).alias("bytes")).first()
    tasks = min(size["n"], max(shuffle_parts(spark), -(-(size["bytes"] or 0) // TASK_BYTES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        rows, size = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                where, path = fs.FileSystem.from_uri(r["file"])
                with where.open_input_file(path) as stream:
                    stream.seek(r["start"])
                    for row in _Reader(stream, r["stop"] - r["start"], chunk_bytes).rows():
                        rows.append(row)
                        size += len(row["data"])
                        if size >= BATCH_BYTES or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return ranges.select("file", "start", "stop").repartition(max(1, tasks)).mapInArrow(run, CHUNKS)


ARROW = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                   ("record_id", pa.string()), ("chunk_no", pa.int64()), ("data", pa.binary()), ("bytes_so_far", pa.int64()),
                   ("sha1_so_far", pa.string()), ("last", pa.bool_()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def archive(pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Writes a WARC record per row of ``pages``; returns the index."""
    folder = folder or work_path(pages.sparkSession, "llm", "warc")
    return write(chunked(records(pages, **columns)), folder)


def summary(chunks: DataFrame) -> DataFrame:
    """One row per record: length and digest of the full payload, as read back."""
    return (chunks.where("last").select(
        "page_id", "record_id",
        F.when(F.col("record_type") == "response", F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(F.col("record_type") == "response", F.col("sha1_so_far")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to"))
