"""WARC: archives with an index of byte ranges, read back by coalesced ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import delete, fresh_path, integer_id, portions, release, stored, text_batches

#: Smaller payloads are never written as revisits.
MIN_REVISIT_BYTES = 1000
#: An archive file is closed beyond this many bytes.
FILE_BYTES = 32 << 20
#: Ranges closer than GAP are read at once, up to READ_BYTES at a time.
GAP, READ_BYTES = 64 << 10, 8 << 20
DATE = "2024-01-01T00:00:00Z"
ID_SPACE = uuid.UUID("5b6d0f6c-0b8e-4c1e-9d55-3d2b6f0a7c11")

INDEX = "page_id long, url string, payload_digest string, record_type string, refers_to long, file string, offset long, length long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(ID_SPACE, str(page_id))}>"


def _clean(url: str) -> str:
    """A URL on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def write_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. digest: of the full payload, hex."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        lines.append(f"Page-Id: {page_id}")
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page-Id: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 3, mtime=0)


def read_record(member: bytes) -> dict:
    """The fields and payload of a record that begins at member's first byte."""
    raw = zlib.decompressobj(31).decompress(member)
    top, _, rest = raw.partition(b"\r\n\r\n")
    lines = top.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record begins here")
    said = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(said["content-length"])]
    _, _, payload = block.partition(b"\r\n\r\n")
    number = lambda k: int(said[k]) if k in said else None
    kind = said["warc-type"]
    digest = base64.b32decode(said["warc-payload-digest"].removeprefix("sha1:")).hex()
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {said['warc-record-id']} doesn't match its digest")
    return {"page_id": number("page-id"), "url": said.get("warc-target-uri"), "record_type": kind, "refers_to": number("refers-to-page-id"), "payload_digest": digest, "payload_bytes": len(payload) if kind == "response" else None, "payload": payload if kind == "response" else None}


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """pages as (page_id, url, html, digest, refers_to): equal payloads of min_bytes refer to the one with the largest id.

    The table of repeated digests is aggregated on the mappers first; its join with the
    pages splits hot digests as a skewed join.  Null html: empty, and smaller than
    min_bytes.  Null id: never referred to where another row has an id.  Rows that repeat
    the largest id refer to nothing.  Ids that aren't integers: a TypeError.  Empty table: no
    rows.  Other columns aren't read.
    """
    integer_id(pages, id_col)
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    own = own.withColumn("digest", F.sha1("html"))
    large: Column = F.octet_length("html") >= min_bytes
    twice = own.where(large).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "last")
    return own.join(twice, "digest", "left").withColumn("refers_to", F.when(large & (F.col("page_id") != F.col("last")), F.col("last"))).select("page_id", "url", "html", "digest", "refers_to")


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write with_revisits()' rows as archives below folder, which all executors share, and give the index.

    The index is stored as a table before anything reads it.  Each file has a name of its
    own: a task that runs again, or twice at a time, never touches what another attempt
    wrote, and the index has the rows of the one attempt that Spark committed.  Files of
    other attempts stay behind, unnamed by the index, until the folder is deleted.
    """

    text_batches(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get().partitionId()
        out, temp, at, rows = None, "", 0, []

        def close() -> pa.RecordBatch:
            nonlocal out, rows, at
            out.close()
            name = f"{base}/pages-{task:06d}-{uuid.uuid4().hex}.warc.gz"
            store.move(temp, name)
            done = pa.RecordBatch.from_pylist([r | {"file": name} for r in rows], pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
            out, rows, at = None, [], 0
            return done

        for batch in portions(batches, lambda b: b.column(2)):
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    temp = f"{base}/.{uuid.uuid4().hex}.part"
                    out = store.open_output_stream(temp, compression=None)
                member = write_record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers_to)
                out.write(member)
                rows.append({"page_id": page_id, "url": url, "payload_digest": digest, "record_type": "response" if refers_to is None else "revisit", "refers_to": refers_to, "offset": at, "length": len(member)})
                at += len(member)
                if at >= file_bytes:
                    yield close()
        if out is not None:
            yield close()

    return stored(pages.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(write, INDEX), "warc-index")


def read_archives(index: DataFrame, folder: str, gap: int = GAP, read_bytes: int = READ_BYTES) -> DataFrame:
    """Read the records that the index rows name: a row for each, with its payload.

    Rows are dealt out by file and stretch of read_bytes, sorted by offset; neighbouring
    ranges are read at once.  There are as many tasks as the archives' own bytes ask for,
    as the index says nothing of them to Spark.  Empty index: no rows.
    """
    spark = index.sparkSession
    total = index.agg(F.sum("length").alias("total")).first()["total"] or 0
    each = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    tasks = max(1, -(-total // each), min(spark.sparkContext.defaultParallelism, -(-total // (1 << 20))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        name, source, run = None, None, []

        def fetch() -> pa.RecordBatch:
            begin, end = run[0][0], run[-1][1]
            source.seek(begin)
            data = source.read(end - begin)
            return pa.RecordBatch.from_pylist([read_record(data[i - begin : j - begin]) for i, j in run], arrow)

        for batch in batches:
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if run and (file != name or offset > run[-1][1] + gap or offset + length - run[0][0] > read_bytes):
                    yield fetch()
                    run = []
                if file != name:
                    name, source = file, store.open_input_file(file)
                run.append((offset, offset + length))
        if run:
            yield fetch()

    return index.select("file", "offset", "length").repartition(tasks, F.col("file"), F.floor(F.col("offset") / read_bytes)).sortWithinPartitions("file", "offset").mapInArrow(read, RECORD)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages, read every record back, and state each page's payload: (page_id, url, payload_bytes, payload_digest, record_type, refers_to).

    A revisit has no payload of its own: its size comes from the record it refers to, as
    read back.  Null html: an empty payload.  Null url: a record without target.  Null
    page_id: kept, as null.  Repeated rows with the largest page_id of equal payloads are
    all responses.  Empty table: no rows.
    """
    folder = fresh_path(spark, "warc")
    index = write_archives(with_revisits(pages), folder)
    found = stored(read_archives(index, folder).drop("payload"), "warc-read")
    delete(spark, folder)
    release(index)
    sizes = found.where("record_type = 'response' and page_id is not null").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("full_digest")).agg(F.max("payload_bytes").alias("full_bytes"))
    full = found.join(sizes.withColumnRenamed("full_digest", "payload_digest"), ["refers_to", "payload_digest"], "left")
    return full.select("page_id", "url", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
