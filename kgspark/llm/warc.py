"""Web archives packaged in ZIP files: written as WARC members with an index, read by byte ranges.

An archive holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj``, both stored without
compression by the ZIP, so that a record is a byte range of the file. The reader parses the ZIP's own directories
(ZIP64 included), finds the members, reads the index and fetches ranges; nothing is unpacked to disk.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.session import ensure_checkpoint_dir, write_shared

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
#: An archive is closed once its records reach this; records are fetched in ranges of about RANGE bytes.
ARCHIVE, RANGE = 64 << 20, 4 << 20


# ---------------------------------------------------------------- records


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, which states the payload's length, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one WARC record; a response's length and digest are taken from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    stated = next(int(line[16:]) for line in http.decode().split("\r\n") if line.startswith("Content-Length: "))
    number = lambda name: int(fields[name][10:-1]) if len(fields.get(name, "")) > 11 else None
    return {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": stated if revisit else len(payload),
        "payload_digest": fields["WARC-Payload-Digest"][5:] if revisit else digest(payload), "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"), "payload": None if revisit else payload,
    }


# ---------------------------------------------------------------- ZIP directories


def members(handle, size: int) -> dict[str, tuple[int, int, int]]:
    """Name to (compression method, offset of the local header, stored size) of each entry of the central directory."""
    tail = _range(handle, max(0, size - 65_557 - 20), size)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)  # such bytes inside the comment
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        place = int.from_bytes(tail[at - 12 : at - 4], "little")
        wide = _range(handle, place, place + 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory where its locator points")
        count, length, start = struct.unpack("<QQQ", wide[32:56])
    listing, at, found = _range(handle, start, start + length), 0, {}
    for _ in range(count):
        if listing[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", listing[at + 8 : at + 12])
        packed, unpacked, name_size, extra_size, comment_size = struct.unpack("<IIHHH", listing[at + 20 : at + 34])
        offset = int.from_bytes(listing[at + 42 : at + 46], "little")
        name = listing[at + 46 : at + 46 + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra = listing[at + 46 + name_size : at + 46 + name_size + extra_size]
        wide_values = _zip64(extra)
        # the wide field holds those of the three that did not fit, in this order
        unpacked, packed, offset = (next(wide_values) if v == 0xFFFFFFFF else v for v in (unpacked, packed, offset))
        found[name] = (method, offset, packed)
        at += 46 + name_size + extra_size + comment_size
    return found


def _zip64(extra: bytes) -> Iterator[int]:
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack("<HH", extra[at : at + 4])
        if tag == 1:
            for i in range(at + 4, at + 4 + size - 7, 8):
                yield int.from_bytes(extra[i : i + 8], "little")
        at += 4 + size


def stored_range(handle, member: tuple[int, int, int]) -> tuple[int, int]:
    """Byte range of a stored member's data in the file."""
    method, offset, size = member
    if method != zipfile.ZIP_STORED:
        raise ValueError("a compressed member cannot be read by ranges")
    head = _range(handle, offset, offset + 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header where the directory points")
    name_size, extra_size = struct.unpack("<HH", head[26:30])
    start = offset + 30 + name_size + extra_size
    return start, start + size


def _range(handle, start: int, end: int) -> bytes:
    handle.seek(start)
    return handle.read(end - start)


# ---------------------------------------------------------------- writing


class _Archive:
    """One ZIP file being written: records first, then their index."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        store, path = fs.FileSystem.from_uri(self.path)
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, url: str | None, made: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(made) + packer.flush()
        self.data.write(packed)
        self.lines.append(f"{quote(url or '', safe=':/')} {DATE} {json.dumps({'offset': self.size, 'length': len(packed)})}")
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(sorted(self.lines)))
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return self.path, size, len(self.lines)


def deduplicated(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, revisit, refers_to. Of equal payloads of ``least`` bytes or more the largest page_id is the
    response and the others revisit it; shorter payloads are all responses.

    Rows that repeat the largest id are responses each; so are equal payloads none of which has an id. A null html is an
    empty payload.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("key", F.sha2("payload", 256))
    shared = rows.where(F.length("payload") >= least).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("head"))
    shared = write_shared(shared.where("n > 1 and head is not null").select("key", "head"))
    rows = rows.join(shared, "key", "left")
    revisit = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return rows.select("page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("head")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least: int = 0, archive: int = ARCHIVE) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in ``folder``; return (path, bytes, records), stored.

    Each task writes files of its own under fresh names; those of lost or repeated attempts are in no row of the result.
    ``folder``: a URI that pyarrow opens for writing and all executors share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            columns = [batch.column(name) for name in ("page_id", "url", "payload", "refers_to", "revisit")]
            for i in range(batch.num_rows):
                page_id, url, payload, refers_to, revisit = (c[i].as_py() for c in columns)
                now = now or _Archive(folder)
                now.add(url, record(page_id, url, payload, refers_to, revisit))
                if now.size >= archive:
                    done.append(now.close())
                    now = None
        if now:
            done.append(now.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "bytes", "records"])

    return write_shared(deduplicated(pages, least).mapInArrow(run, "path string, bytes bigint, records bigint"))


# ---------------------------------------------------------------- reading


def locate(archives: DataFrame, span: int = RANGE) -> DataFrame:
    """(path, start, end, offsets): ranges of about ``span`` bytes with the offsets of the records in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows: list[tuple] = []
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as handle:
                    inside = members(handle, handle.size())
                    base, _ = stored_range(handle, inside[DATA])
                    lines = _range(handle, *stored_range(handle, inside[INDEX])).decode().splitlines()
                places = sorted((x["offset"] + base, x["length"]) for x in (json.loads(line.split(" ", 2)[2]) for line in lines))
                for offset, length in places:
                    if not rows or offset + length - rows[-1][1] > span:
                        rows.append((path, offset, 0, []))
                    rows[-1][3].append(offset)
                    rows[-1] = (*rows[-1][:2], offset + length, rows[-1][3])
                types = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["path", "start", "end", "offsets"])

    return archives.select("path").mapInArrow(run, "path string, start bigint, end bigint, offsets array<bigint>")


def read_records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives (path): page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload].

    Archives are located first, then their ranges are dealt out and fetched, so that one large archive is read by many
    tasks. An empty table of archives gives no row.
    """
    types = {
        "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
        "record_type": pa.string(), "refers_to": pa.int64(), **({"payload": pa.binary()} if payloads else {}),
    }
    spelled = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end, offsets in zip(*(batch.column(n).to_pylist() for n in ("path", "start", "end", "offsets"))):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as handle:
                    data = _range(handle, start, end)
                cuts = [o - start for o in offsets] + [end - start]
                found = [parse_record(zlib.decompress(data[a:b], 31)) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in types.items()], names=list(types))

    ranges = locate(archives).repartition(F.col("path"), F.col("start"))
    return ranges.mapInArrow(run, ", ".join(f"{k} {spelled[t]}" for k, t in types.items()))


def new_folder(spark: SparkSession) -> str:
    """A fresh folder below the checkpoint folder, which all executors share, as a URI."""
    folder = f"{ensure_checkpoint_dir(spark)}/archives-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return re.sub(r"^file:/(?!//)", "file:///", folder)


def op9_warc(pages: DataFrame) -> DataFrame:
    archives = write_archives(pages, new_folder(pages.sparkSession))
    return read_records(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
