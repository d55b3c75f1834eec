"""WARC archives with a shared Zstandard dictionary.

Every page becomes one record whose payload is its html in UTF-8 (null: empty).
Of the records with equal payloads of at least ``MIN_REVISIT`` bytes, the one with
the smallest page_id is the *response*; the others are *revisit* records that
name it and carry no payload.  Smaller payloads are always responses.  (Pages
without an id revisit a page that has one; among themselves all are responses.  A
row that repeats the response's page_id is a response again.)

A dictionary is trained on at most ``SAMPLE_RECORDS`` payloads chosen by a hash of
their digest, and embedded in every archive as a leading skippable frame (magic
0x184D2A5D), which a reader of the format loads before the records; each record is
a Zstandard frame of its own, so any record can be read from its offset alone.  With
too few payloads to train on, archives have no dictionary frame.

A very long payload is one record.  An empty table gives no archive and an empty result; columns
other than page_id, url and html are not read.

Tasks write archives of about ``ARCHIVE_BYTES`` under names of their own; the ones
named in the manifest, committed once per successful task, are the result.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.llm.session_tables import broadcast_if_small, written
from aurum.llm.training import first_by_hash
from aurum.session import scratch_path

MIN_REVISIT = 100
SAMPLE_RECORDS = 1000
SAMPLE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 16
LEVEL = 3
_FRAME = struct.Struct("<II")
_SKIPPABLE = 0x184D2A5D
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_MANIFEST = "file string, records bigint, bytes bigint"


def record_id(page_id: int | None, digest: str) -> str:
    name = f"page:{page_id}" if page_id is not None else f"digest:{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _clean(value: str) -> str:
    """A header value without control characters (they are percent-encoded)."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """One record; ``original`` is the page that a revisit refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Type", "response" if original is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Date", _DATE), ("WARC-Target-URI", _clean(url or f"urn:page:{page_id}")),
            ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    body = http
    if original is None:
        body += payload
    else:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(original, digest)), ("X-Refers-To-Page", str(original))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


class ArchiveWriter:
    def __init__(self, folder: str, dictionary: bytes, level: int = LEVEL):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.dictionary = dictionary
        loaded = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.zip = zstandard.ZstdCompressor(level=level, dict_data=loaded)
        self.out, self.name, self.records, self.bytes = None, "", 0, 0

    def add(self, rec: bytes) -> None:
        if self.out is None:
            self.name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.zst"
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            if self.dictionary:
                self.out.write(_FRAME.pack(_SKIPPABLE, len(self.dictionary)) + self.dictionary)
            info = b"software: dictionary-compressed archive writer\r\n"
            self.out.write(self.zip.compress(
                b"WARC/1.1\r\nWARC-Type: warcinfo\r\n" + f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {_DATE}\r\n".encode()
                + f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info + b"\r\n\r\n"))
        self.out.write(self.zip.compress(rec))
        self.records += 1
        self.bytes += len(rec)

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            yield self.name, self.records, self.bytes
        self.out, self.records, self.bytes = None, 0, 0


def frames(f, context: zstandard.ZstdDecompressor, ahead: bytes = b"") -> Iterator[bytes]:
    """The decompressed frames of a stream, one after the other; a cut frame is an error."""
    while True:
        ahead = ahead or f.read(CHUNK)
        if not ahead:
            return
        frame, parts = context.decompressobj(), []
        while not frame.eof:
            if not ahead:
                raise ValueError("the last frame is cut off")
            parts.append(frame.decompress(ahead))
            ahead = frame.unused_data if frame.eof else f.read(CHUNK)
        yield b"".join(parts)


def read_archive(folder: str, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record."""
    fs, base = pafs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
        start = f.read(_FRAME.size)
        magic, size = _FRAME.unpack(start)
        loaded = None
        if magic == _SKIPPABLE:
            loaded, start = zstandard.ZstdCompressionDict(f.read(size)), b""
        for rec in frames(f, zstandard.ZstdDecompressor(dict_data=loaded), start):
            head, _, block = rec.partition(b"\r\n\r\n")
            lines = head.decode("utf-8").split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            if lines[0] != "WARC/1.1" or len(block) != int(fields["Content-Length"]) + 4:
                raise ValueError(f"{name}: not a record: {lines[0][:40]!r}")
            yield fields, block[:-4]


# ------------------------------------------------------------ Spark
def originals(pages: DataFrame) -> DataFrame:
    """(digest, original) of payloads that occur more than once and are long enough."""
    payload = F.coalesce("html", F.lit(""))
    seen = pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n"))
    many = (seen.filter(F.col("n") >= MIN_REVISIT).groupBy("digest")
                .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("c")))
    return written(many.filter("c > 1").select(F.col("digest").alias("_digest"), "original"), "warc-originals")


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded choice of payloads, the same on every run."""
    able = (pages.select("html", F.xxhash64("html").alias("h"), F.octet_length("html").alias("n"))
                 .filter(F.length("html") > 0))
    last = first_by_hash(able.select("h", "n").distinct(), SAMPLE_RECORDS, "h")           # narrow rows only
    last = written(last, "warc-sample")
    keep, size = [], 0
    for r in last.orderBy("h", "n").collect():                     # at most SAMPLE_RECORDS hashes and lengths
        if size + r.n <= SAMPLE_BYTES:
            keep.append(r.h)
            size += r.n
    last = last.filter(F.col("h").isin(keep) & (F.col("n") <= SAMPLE_BYTES))
    sample = able.join(F.broadcast(last), ["h", "n"]).dropDuplicates(["h"]).orderBy("h").select("html").toLocalIterator()
    chosen = [r.html.encode("utf-8") for r in sample]              # at most SAMPLE_BYTES
    if len(chosen) < 16 or size < 8 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, size // 8), chosen, level=LEVEL).as_bytes()
    except zstandard.ZstdError:          # payloads without anything in common
        return b""


def write_warc(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives; returns the written manifest (file, records, bytes)."""
    shared = pages.sparkSession.sparkContext.broadcast(train_dictionary(pages))      # at most DICTIONARY_BYTES

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows = ArchiveWriter(folder, shared.value), []
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "html", "digest", "original")]
            for i in range(batch.num_rows):
                page, url, html, digest, original = (c[i].as_py() for c in cols)
                first = original is None or page == original
                out.add(record(page, url, (html or "").encode("utf-8"), digest, None if first else original))
                if out.bytes >= archive_bytes:
                    rows += out.close()
        rows += out.close()
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows)], names=["file", "records", "bytes"])

    keyed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
                         F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"))
    known = broadcast_if_small(originals(pages))
    joined = keyed.join(known, F.col("digest") == F.col("_digest"), "left").drop("_digest")
    return written(joined.mapInArrow(write, _MANIFEST), "warc-manifest")


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record, from the archives: page_id, payload_bytes, payload_digest,
    record_type, refers_to.  Response payloads are hashed again and must agree."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for file, records in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                rows = []
                for head, block in read_archive(folder, file):
                    kind = head["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rsplit(b"Content-Length: ", 1)[1])
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{file}: payload of {head['WARC-Record-ID']} does not match its digest")
                    page, refers = head.get("X-Page-Id"), head.get("X-Refers-To-Page")
                    rows.append((None if page is None else int(page), size, digest, kind, None if refers is None else int(refers)))
                if len(rows) != records:
                    raise ValueError(f"{file}: {len(rows)} records, the manifest has {records}")
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return manifest.select("file", "records").repartition(F.col("file")).mapInArrow(
        read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Writes archives into the shared folder and reads them back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    return read_warc(spark, folder, write_warc(pages, folder))
