"""WARC archives, compressed record by record with a dictionary of their own.

A file holds a leading skippable frame with a Zstandard dictionary built from the
records archived in it, then one frame for every record. Of the records with equal
payloads of at least ``MIN_REVISIT`` bytes, the one with the largest page id is the
response; the others are revisits that refer to it and carry no payload, only the
HTTP header with the payload's length and digest.

Defined results: a null html is an empty payload; a null url is left out; a null
page id is left out too, reads back as null, and never is the response of others
while an id is there; rows that repeat the largest page id are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, shared_dir

MIN_REVISIT = 1000
#: Bytes of records in a file (a task holds one file's records), of its dictionary, and zstd's level.
FILE_BYTES, DICTIONARY, LEVEL = 16 << 20, 64 << 10, 3
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the formats: the frame magic that marks a dictionary, and the id space of the record names.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
RECORD_SPACE = 0x6F1C_2A60_5B1D_4E0F << 64

READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _name(page_id: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=RECORD_SPACE | (page_id & (1 << 64) - 1))}>"


def _page(name: str | None) -> int | None:
    if not name:
        return None
    low = uuid.UUID(name[len("<urn:uuid:") : -1]).int & (1 << 64) - 1
    return low - (1 << 64) if low >> 63 else low


def record(page_id: int | None, url: str | None, payload: bytes, size: int, sha1: str, refers_to: int | None) -> bytes:
    """One WARC record. payload is not written if refers_to is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}"]
    head.append(f"WARC-Record-ID: {_name(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}")
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def compress(records: list[bytes], dictionary: int = DICTIONARY, level: int = LEVEL) -> bytes:
    """The file of some records. Too few to build a dictionary from: it has none."""
    trained = None
    if len(records) >= 8:
        try:
            trained = zstandard.train_dictionary(dictionary, records, k=512, d=8)
        except zstandard.ZstdError:
            pass
    out = io.BytesIO()
    if trained:
        frame = zstandard.ZstdCompressor(level=level).compress(trained.as_bytes())
        out.write(DICTIONARY_MAGIC + len(frame).to_bytes(4, "little") + frame)
    one = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
    for r in records:
        out.write(one.compress(r))
    return out.getvalue()


def records(data: bytes, expected: int | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a file, one in memory at a time. It raises if the
    file ends before ``expected`` records: a frame that is cut short yields nothing."""
    trained, at, n = None, 0, 0
    if data[:4] == DICTIONARY_MAGIC:
        at = 8 + int.from_bytes(data[4:8], "little")
        trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:at]))
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=trained).stream_reader(memoryview(data)[at:], read_across_frames=True))
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record starts with {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[key] = value
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n" or len(block) != int(head["Content-Length"]):
            raise ValueError("a record is cut short")
        n += 1
        yield head, block
    if expected is not None and n != expected:
        raise ValueError(f"{n} records of {expected}")


def write_archives(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archives under path; returns (path, records, bytes), a row for every complete file.

    Only digests are grouped to find repeats. A file that a lost task left behind is in
    no row, so a reader of the rows never meets it.
    """
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    rows = rows.withColumn("size", F.octet_length("html").cast("long")).withColumn("sha1", F.sha1("html"))
    again = rows.filter(F.col("size") >= MIN_REVISIT).groupBy("sha1", "size").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
    again = again.filter("n > 1 and newest is not null").select("sha1", "size", "newest")
    rows = rows.join(again, ["sha1", "size"], "left")
    refers = F.when(F.coalesce(F.col("page_id") != F.col("newest"), F.col("newest").isNotNull()), F.col("newest"))
    rows = rows.select("page_id", "url", F.when(refers.isNull(), F.col("html")).otherwise(F.lit(b"")).alias("html"), "size", "sha1", refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        held: list[bytes] = []

        def close() -> pa.RecordBatch:
            name, data = f"{root}/{uuid.uuid4().hex}.warc.zst", compress(held)
            with store.open_output_stream(name) as f:
                f.write(data)
            out = pa.RecordBatch.from_pydict({"path": [name], "records": [len(held)], "bytes": [len(data)]})
            held.clear()
            return out

        size = 0
        for b in batches:
            for r in zip(*b.columns, strict=True):
                held.append(record(*(x.as_py() for x in r)))
                size += len(held[-1])
                if size >= file_bytes:
                    yield close()
                    size = 0
        if held:
            yield close()

    return materialize(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-files")


def read_archives(spark: SparkSession, files: DataFrame, path: str) -> DataFrame:
    """READ_SCHEMA: the records of the files that write_archives returned. Lengths and
    digests of responses are taken from the payload, and must equal the header's."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(path)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        for b in batches:
            for name, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_input_stream(name) as f:
                    data = f.read()
                out: list[tuple] = []
                held = 0
                for head, block in records(data, n):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    sha1 = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    kind = head["WARC-Type"]
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != sha1):
                        raise ValueError(f"{name}: a payload differs from its digest")
                    page = head.get("WARC-Page-ID")
                    out.append((int(page) if page is not None else None, size, sha1, kind, _page(head.get("WARC-Refers-To")), head.get("WARC-Target-URI"), payload if kind == "response" else None))
                    held += len(block)
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    n = files.count()
    dealt = files.select("path", "records").repartition(max(1, min(n, 10_000)), "path")
    return dealt.mapInArrow(read, READ_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """pages written to new archives in the shared folder and read back."""
    path = shared_dir(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, write_archives(pages, path), path)
