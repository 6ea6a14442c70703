"""WARC archives with a Zstandard dictionary.

Each task writes one archive (``.warc.zst``): a leading skippable frame
(magic 0x184D2A5D) holds the dictionary built from the archive's own first
records, then every record is a frame of its own, compressed with it, so any
record can be read alone.  Records with equal payloads are found by their
SHA-1; the smallest page id is the response, the others are revisit records
that refer to it and carry no payload.  Digests are grouped first (map-side
combined); the table of repeated payloads is joined back to the pages, by
broadcast while Spark's byte-based check allows it, else by a join on the
digest in which AQE splits hot digests.

Defined results: null or empty html is an empty payload (equal like any
other); rows that repeat the smallest page id of their payload are all
responses; pages with a null id come after all others, and are responses if no
page of their payload has an id; a null url leaves out the target URI; control
characters and blanks in a url are percent-encoded; an empty table gives no
archive; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import read_file, record_batch, task_name, texts_of, write_file, write_scratch
from orderflow.session import scratch_dir

DICTIONARY_FRAME = 0x184D2A5D
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    digest = payload_digest(payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_urn(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%' + chr(39))}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_urn(refers_to, digest)}",
                 f"X-Refers-To-Page-ID: {refers_to}", f"X-Payload-Length: {len(payload)}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    body = (http + b"Content-Length: %d\r\n\r\n" % len(payload) + payload if refers_to is None else http + b"\r\n")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of a record, its lengths and digest verified."""
    head, body = data.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    body = body[:int(headers["Content-Length"])]
    payload = body.split(b"\r\n\r\n", 1)[1]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response" and payload_digest(payload) != digest:
        raise ValueError("payload does not match its digest")
    return {"headers": headers, "payload": payload, "digest": digest}


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the records' own bytes if they are too few to
    train on."""
    try:
        return zstandard.train_dictionary(size, records, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary))


def read_archive(data: bytes):
    """The records of an archive, in order."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME:
        raise ValueError("no leading dictionary frame")
    at = 8 + size
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:at]))
    view, step = memoryview(data), 1 << 14
    while at < len(data):
        frame, parts = press.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("truncated archive")
            piece = view[at:at + step]
            parts.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield parse_record(b"".join(parts))


def with_refers_to(pages: DataFrame, *, id_col: str, url: str, html: str) -> DataFrame:
    """``__payload`` and ``__refers_to`` (null for responses) of every page."""
    rows = pages.select(*[F.col(f"`{c}`") for c in (id_col, url, html)]).withColumn("__payload", F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b""))) \
        .withColumn("__sha1", F.sha1("__payload"))
    first = (rows.groupBy("__sha1").agg(F.min(F.col(f"`{id_col}`")).alias("__first"),
                                        F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    later = ~F.col(f"`{id_col}`").eqNullSafe(F.col("__first"))
    return rows.join(write_scratch(first, "first_payloads"), "__sha1", "left").withColumn(
        "__refers_to", F.when(later, F.col("__first")))


def write_archives(pages: DataFrame, *, id_col: str = "page_id", url: str = "url", html: str = "html",
                   date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write the archives; one row per file: path, n_records, n_bytes."""
    root = scratch_dir(pages.sparkSession, "warc")

    def run(batches):
        path = f"{root}/part-{task_name()}.warc.zst"
        n = 0

        def records():
            nonlocal n
            for batch in batches:
                ids, urls, refs = (batch.column(i).to_pylist() for i in (0, 1, 3))
                for i, u, p, r in zip(ids, urls, texts_of(batch.column(2)), refs):
                    n += 1
                    yield warc_record(i, u, p, r, date)

        source = records()
        first, held = [], 0
        for r in source:
            first.append(r)
            held += len(r)
            if held >= SAMPLE_BYTES:
                break
        if not first:
            return

        def write(out):
            dictionary = build_dictionary(first)
            out.write(dictionary_frame(dictionary))
            press = compressor(dictionary)
            for part in (first, source):
                for r in part:
                    out.write(press.compress(r))

        size = write_file(path, write)
        yield record_batch(path=pa.array([path]), n=pa.array([n], pa.int64()), b=pa.array([size], pa.int64()))

    rows = with_refers_to(pages, id_col=id_col, url=url, html=html).select(
        F.col(f"`{id_col}`").cast("long"), F.col(f"`{url}`").cast("string"), "__payload",
        F.col("__refers_to").cast("long"))
    return write_scratch(rows.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc_manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the archives: page_id, payload_bytes, payload_digest,
    record_type, refers_to and the payload (null for revisits)."""
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for r in read_archive(read_file(path)):
                    h, revisit = r["headers"], r["headers"]["WARC-Type"] == "revisit"
                    rows.append((int(h["X-Page-ID"]) if "X-Page-ID" in h else None,
                                 int(h["X-Payload-Length"]) if revisit else len(r["payload"]), r["digest"],
                                 h["WARC-Type"], int(h["X-Refers-To-Page-ID"]) if revisit else None,
                                 None if revisit else r["payload"]))
                    held += len(r["payload"])
                    if held > 8 << 20:
                        yield table(rows)
                        rows, held = [], 0
                yield table(rows)

    def table(rows):
        cols = list(zip(*rows)) if rows else [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=list("abcdef"))

    tasks = max(1, min(manifest.count(), 4 * manifest.sparkSession.sparkContext.defaultParallelism))
    return manifest.select("path").repartition(tasks).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
             "payload binary")
