"""WARC archives: a writer with revisit records, and a sequential reader.

Archives hold one gzip member per record. The reader inflates a member
incrementally in bounded steps, frames the record by its Content-Length, and verifies its
digest; a cut-off member, a wrong length or a wrong digest raises.

Of pages with equal payloads of at least ``min_revisit_bytes`` the one with
the smallest id is written as response and the others as revisits that refer to it.

Writers give each attempt's file its own name. What the tasks report that Spark counts as
done, a line per file, is the manifest: files of failed or repeated attempts are in none and are never read. Executors reach the archives by the file system of the
folder's URI (local, HDFS or an object store, as pyarrow opens it).

Defined cases: a null payload is empty; a null id is written as none, read back as null,
and revisits if another page with the payload has an id, else it is a response; repeated rows with the smallest id are responses all;
a null address is left out; control characters in an address are percent-encoded; an empty table gives an empty archive
and no records; other columns of the pages are not written.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_sync.llm.tables import Scratch

STEP = 1 << 16
#: Fixed value: the profile of revisits that the WARC 1.1 standard names.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, n_records long, n_bytes long"
RECORD = ("record_id string, record_type string, page_id string, target_uri string, warc_date string, payload binary, "
          "payload_bytes long, payload_digest string, refers_to string")


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def plan_records(pages: DataFrame, *, page_id: str = "page_id", payload: str = "html", url: str = "url", min_revisit_bytes: int = 100) -> DataFrame:
    """Rows to write: ``page_id`` (text), ``url``, ``payload`` (null for revisits), ``digest`` (hex SHA-256), ``refers_to`` (text).

    The smallest id per digest is found on digests alone, pre-aggregated; AQE splits the join at a hot digest.
    """
    whole = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{page_id}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), whole.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = rows.filter(F.octet_length("payload") >= min_revisit_bytes).groupBy(F.col("digest").alias("d")).agg(F.min("id").alias("first_id"))
    joined = rows.join(first, F.col("digest") == F.col("d"), "left")
    again = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return joined.select(
        F.col("id").cast("string").alias("page_id"), "url", F.when(~again, F.col("payload")).alias("payload"), "digest",
        F.when(again, F.col("first_id").cast("string")).alias("refers_to"))


def _uri(page_id: str | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else quote(page_id, safe='')}:{digest}>"


def record_bytes(page_id: str | None, url: str | None, payload: bytes | None, digest: str, refers_to: str | None, date: str) -> bytes:
    """One record before compression."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload or b"") if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_uri(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(quote(c) if ord(c) < 33 or c in "%\x7f" else c for c in url))
    if page_id is not None:
        head.append("WARC-Page-ID: " + quote(page_id, safe=""))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_uri(refers_to, digest)}", f"WARC-Profile: {SAME_PAYLOAD}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(rows: DataFrame, folder: str, scratch: Scratch, *, date: str = "2024-01-01T00:00:00Z", level: int = 6,
               most_bytes: int = 1 << 30) -> DataFrame:
    """Write the rows of :func:`plan_records` as ``*.warc.gz`` below ``folder``; the manifest (``file, n_records, n_bytes``).

    A task writes a new file after ``most_bytes``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        sink, name, n_records, n_bytes = None, "", 0, 0
        done = []
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers_to = (batch.column(k)[i].as_py() for k in range(5))
                if sink is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    sink, n_records, n_bytes = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = pack.compress(record_bytes(page_id, url, payload, digest, refers_to, date)) + pack.flush()
                sink.write(member)
                n_records, n_bytes = n_records + 1, n_bytes + len(member)
                if n_bytes >= most_bytes:
                    sink.close()
                    done.append((name, n_records, n_bytes))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((name, n_records, n_bytes))
        columns = list(zip(*done, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
                                         names=["file", "n_records", "n_bytes"])

    written = rows.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, MANIFEST)
    files = [tuple(r) for r in written.collect()]  # a line per file, as Spark's own writers report theirs
    return scratch.write(rows.sparkSession.createDataFrame(files, MANIFEST).coalesce(1), "manifest")


class _Member:
    """The inflated bytes of one gzip member, pulled in bounded steps; ``rest`` is what follows it in the stream."""

    def __init__(self, stream: BinaryIO, raw: bytes):
        self.stream, self.raw, self.inflate, self.held = stream, raw, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        """Inflate a further step; False at the member's end."""
        if self.inflate.eof:
            return False
        raw = self.inflate.unconsumed_tail or self.raw or self.stream.read(STEP)
        if not self.inflate.unconsumed_tail:
            self.raw = b""
        if not raw:
            raise EOFError("the archive ends inside a record")
        self.held += self.inflate.decompress(raw, STEP)
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if not self.more():
                raise ValueError("a record has no end of its headers")
        out = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("a record is shorter than its Content-Length")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def end(self) -> bytes:
        while self.more():
            pass
        if bytes(self.held) != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        return self.inflate.unused_data


def read_records(stream: BinaryIO) -> Iterator[Record]:
    """The records of one archive in order, each framed by its Content-Length and checked against its block digest."""
    raw = stream.read(STEP)
    while raw:
        member = _Member(stream, raw)
        first, *lines = member.until(b"\r\n\r\n").decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        block = member.exactly(int(headers["content-length"]))
        raw = member.end() or stream.read(STEP)
        if "warc-block-digest" in headers and headers["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
            raise ValueError(f"wrong block digest in {headers.get('warc-record-id')}")
        yield Record(headers, block)


def read_warc(manifest: DataFrame, folder: str, *, task_bytes: int = 32 << 20) -> DataFrame:
    """All records of the manifest's files (:data:`RECORD`); one task reads a file from its start to its end,
    and small files together up to about ``task_bytes``.

    Responses carry their payload, its length and its digest as computed
    from what was read (a digest other than the declared one raises);
    revisits carry the declared digest and the id they refer to.
    """
    n_files, n_bytes = manifest.agg(F.count(F.lit(1)), F.sum("n_bytes")).first()
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    n_tasks = max(1, min(n_files, max(2 * cores, -(-(n_bytes or 0) // task_bytes))))

    def one(r: Record) -> tuple:
        h = r.headers
        declared = h["warc-payload-digest"].removeprefix("sha256:")
        payload = r.block.partition(b"\r\n\r\n")[2] if h["warc-type"] == "response" else None
        if payload is not None and hashlib.sha256(payload).hexdigest() != declared:
            raise ValueError(f"wrong payload digest in {h['warc-record-id']}")
        refers = h["warc-refers-to"].strip("<>").split(":")[2] if "warc-refers-to" in h else None
        return (h["warc-record-id"], h["warc-type"], unquote(h["warc-page-id"]) if "warc-page-id" in h else None,
                unquote(h["warc-target-uri"]) if "warc-target-uri" in h else None, h["warc-date"], payload,
                None if payload is None else len(payload), declared, None if refers is None else unquote(refers))

    kinds = [pa.string()] * 5 + [pa.binary(), pa.int64(), pa.string(), pa.string()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for record in read_records(stream):
                        rows.append(one(record))
                        held += len(record.block)
                        if held > 4 << 20 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return manifest.select("file").repartition(n_tasks).mapInArrow(run, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with ``payload_bytes`` of revisits taken from the response they refer to (same digest)."""
    own = records.filter("record_type = 'response'").groupBy(F.col("page_id").alias("__llm_p"), F.col("payload_digest").alias("__llm_d")).agg(F.max("payload_bytes").alias("__llm_n"))
    joined = records.join(own, (F.col("refers_to") == F.col("__llm_p")) & (F.col("payload_digest") == F.col("__llm_d")), "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "__llm_n")).drop("__llm_p", "__llm_d", "__llm_n")
