"""WARC archives with an index of byte ranges.

Write: each page becomes one record, compressed as a gzip member of its own, in one
``.warc.gz`` file per task; the task emits an index row (file, offset, length, URL,
digest, page_id, record type) per record, stored as a table beside the archives.
Read: selected index rows are dealt by file and offset block, sorted, near ranges are
coalesced into one read, and each record is parsed and its payload digest verified.

Pages with equal payloads of at least ``min_bytes`` keep one response record, that of
the largest page_id; the others are revisit records that name it.

Defined cases: null html is an empty payload; a null URL leaves out the target header;
control characters in a URL are percent-encoded in the header (the index has the URL as
given); null page_ids count as smallest and come back as null; rows that repeat both
page_id and payload give one response (the first written) and revisits to the same
page_id; an empty table gives no files and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 1 << 30
INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string"
RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _b32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record (uncompressed)."""
    kind = "revisit" if revisit else "response"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + (b"\r\n" if revisit else b"Content-Length: %d\r\n\r\n" % len(payload) + payload)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}:{kind}")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields and payload of one uncompressed record; a response's digest is verified."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(field["Content-Length"])]
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = field["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    if payload is not None and (base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != int(field["X-Payload-Length"])):
        raise ValueError("payload does not match its digest")
    number = lambda k: int(field[k]) if k in field else None
    return {"page_id": number("X-Page-ID"), "url": field.get("WARC-Target-URI"), "payload": payload,
            "payload_bytes": int(field["X-Payload-Length"]), "payload_digest": digest,
            "record_type": field["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID")}


def roles(pages: DataFrame) -> DataFrame:
    """(page_id, digest, last): each distinct pair and the largest page_id of its payload. No payload is moved."""
    small = pages.select("page_id", F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")).alias("digest"))
    last = small.groupBy("digest").agg(F.max("page_id").alias("last"))
    return small.distinct().join(last, "digest")


def write(pages: DataFrame, path: str, min_bytes: int = 0, level: int = 1) -> DataFrame:
    """Write the archives under ``path``; returns the stored index."""
    fs, base = C.shared_fs(path)
    fs.create_dir(base, recursive=True)
    rows = pages.select("page_id", "url", "html", F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")).alias("digest"))
    known = roles(pages).select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "last")
    # one shuffle of the payloads, by keys that are near unique; equal pairs meet in one task
    ready = (rows.join(known, rows["page_id"].eqNullSafe(known["_page"]) & (rows["digest"] == known["_digest"]))
             .select("page_id", "url", "html", "digest", "last").sortWithinPartitions("page_id", "digest"))

    def task(batches):
        from pyspark import TaskContext

        fs, base = C.shared_fs(path)
        number, part, at, out, tmp, name, seen = TaskContext.get().partitionId(), 0, 0, None, None, None, None
        for b in C.slices(batches, "html"):
            made = []
            for page, url, html, digest, last in zip(*(C.column(b, c).to_pylist() for c in ("page_id", "url", "html", "digest", "last"))):
                if out is None:
                    name = f"part-{number:05d}-{part:03d}.warc.gz"
                    tmp = f"{base}/.{name}.{uuid.uuid4().hex}"
                    out, at = fs.open_output_stream(tmp), 0
                payload = (html or "").encode("utf-8", "surrogatepass")
                revisit = len(payload) >= min_bytes and (page != last or seen == (page, digest))
                seen = (page, digest)
                d = _b32(digest)
                z = zlib.compressobj(level, zlib.DEFLATED, 31)
                raw = z.compress(record(page, url, payload, d, last, revisit)) + z.flush()
                out.write(raw)
                made.append((name, at, len(raw), page, url, d, "revisit" if revisit else "response"))
                at += len(raw)
                if at >= FILE_BYTES:
                    out.close()
                    C.publish(fs, tmp, f"{base}/{name}")
                    out, part = None, part + 1
            cols = list(zip(*made))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["file", "offset", "length", "page_id", "url", "digest", "record_type"])
        if out is not None:
            out.close()
            C.publish(fs, tmp, f"{base}/{name}")

    return C.stored(ready.mapInArrow(task, INDEX), "warc-index")


def read(index: DataFrame, path: str, gap: int = 1 << 16, most: int = 8 << 20, block: int = 32 << 20) -> DataFrame:
    """Records of the selected index rows: near byte ranges of a file are read together, at most ``most`` bytes at once."""

    def task(batches):
        fs, base = C.shared_fs(path)
        name, f = None, None
        for b in batches:
            files, offs, lens = (C.column(b, c).to_pylist() for c in ("file", "offset", "length"))
            i = 0
            while i < len(files):
                j, end = i + 1, offs[i] + lens[i]
                while j < len(files) and files[j] == files[i] and 0 <= offs[j] - end <= gap and offs[j] + lens[j] - offs[i] <= most:
                    end, j = offs[j] + lens[j], j + 1
                if files[i] != name:
                    name, f = files[i], fs.open_input_file(f"{base}/{files[i]}")
                f.seek(offs[i])
                raw = f.read(end - offs[i])
                got = [parse(zlib.decompress(raw[o - offs[i]:o - offs[i] + n], 31)) for o, n in zip(offs[i:j], lens[i:j])]
                yield pa.RecordBatch.from_pylist(got, schema=SHAPE)
                i = j

    near = index.select("file", "offset", "length").repartition("file", F.floor(F.col("offset") / block)).sortWithinPartitions("file", "offset")
    return near.mapInArrow(task, RECORDS)


SHAPE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def op9_warc(spark, sf_dir):
    path = C.fresh_dir(spark, "warc")
    index = write(C.table(spark, sf_dir, "pages"), path)
    return read(index, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
