"""WARC archives as seekable Zstandard bundles.

Records are written in independent Zstandard frames of about ``frame_bytes``; a
bundle is closed at about ``bundle_bytes`` and ends with two skippable frames that
every Zstandard reader passes over: the record index (record id -> frame, offset
in the frame, length; an id that repeats has several) and the seek table in the public seekable format. One
record is read back from a file by reading its footer, its index and its frame alone.

Of records with equal payloads of at least ``least`` bytes the one with the
smallest id is a response, the others revisit it.

Defined cases: a null html is an empty payload; a null url has no target line, line breaks in a url are percent-encoded;
rows that share the smallest id of their payload are all responses; a row with a
null id is always a response and is never referred to; a payload of any length is one record, in a frame of
its own size; an empty table gives no bundle; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.scratch import Scratch

LEAST = 100                  # shorter payloads are never revisits
FRAME_BYTES = 256 << 10      # records of a frame, uncompressed
BUNDLE_BYTES = 8 << 20       # compressed; bounds what a task holds
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the seekable Zstandard format and of WARC 1.1.
SEEK_SKIPPABLE, INDEX_SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"

RECORDS = "bundle string, record_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string"


def plan(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """(id, url, html, digest, size, refers_to): refers_to is set on revisits."""
    text = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), text.alias("html"),
                        F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    firsts = rows.where(F.col("size") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1 AND first IS NOT NULL").select(F.col("digest").alias("d"), "first")
    rows = rows.join(firsts, F.col("digest") == F.col("d"), "left")
    return rows.select("id", "url", "html", "digest", "size", F.when(F.col("id") > F.col("first"), F.col("first")).alias("refers_to"))


def _record(rid, url, payload: bytes, digest: str, refers) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <{rid}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers is not None:
        head += [f"WARC-Refers-To: <{refers}>", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _urn(value) -> str:
    return URN + ("" if value is None else quote(str(value), safe=""))


class _Bundle:
    def __init__(self, frame_bytes: int):
        self.frame_bytes, self.press = frame_bytes, zstandard.ZstdCompressor(level=3)
        self.frames, self.sizes, self.index, self.open, self.raw, self.size = [], [], [], [], 0, 0

    def add(self, rid: str, record: bytes) -> None:
        self.index.append((rid, len(self.sizes), self.raw, len(record)))
        self.open.append(record)
        self.raw += len(record)
        if self.raw >= self.frame_bytes:
            self.cut()

    def cut(self) -> None:
        if self.open:
            frame = self.press.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.raw))
            self.open, self.raw, self.size = [], 0, self.size + len(frame)

    def close(self) -> bytes:
        self.cut()
        lines = "".join(f"{rid} {frame} {at} {length}\n" for rid, frame, at, length in self.index)
        index = self.press.compress(lines.encode())
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEK_MAGIC)
        return b"".join([*self.frames, struct.pack("<II", INDEX_SKIPPABLE, len(index)), index, struct.pack("<II", SEEK_SKIPPABLE, len(table)), table])


def bundles(planned: DataFrame, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """(bundle, content): one row per bundle, named by its content."""

    def row(bundle):
        content = bundle.close()
        return pa.record_batch([pa.array([hashlib.sha256(content).hexdigest()[:32]]), pa.array([content], pa.binary())], names=["bundle", "content"])

    def write(batches):
        bundle = _Bundle(frame_bytes)
        for batch in batches:
            for rid, url, html, digest, refers in zip(*(batch.column(k) for k in range(5))):
                rid, refers = _urn(rid.as_py()), refers.as_py()
                payload = html.as_buffer().to_pybytes()
                bundle.add(rid, _record(rid, url.as_py(), payload, digest.as_py(), None if refers is None else _urn(refers)))
                if bundle.size >= bundle_bytes:
                    yield row(bundle)
                    bundle = _Bundle(frame_bytes)
        if bundle.index:
            yield row(bundle)

    return planned.select("id", "url", "html", "digest", "refers_to").mapInArrow(write, "bundle string, content binary")


class Bytes:
    """A bundle in memory, read by byte range as a file is."""

    def __init__(self, content: bytes):
        self.content = content

    def size(self) -> int:
        return len(self.content)

    def read_at(self, n: int, at: int) -> bytes:
        return self.content[at:at + n]


def seek_table(bundle) -> tuple[list[tuple[int, int, int]], dict[str, list[tuple[int, int, int]]]]:
    """Frames as (start, compressed size, size); record id -> its records as (frame, offset in it, length): pages may repeat
    an id, and those without one share theirs. ``bundle`` is a bundle's bytes, or a file with ``size()`` and ``read_at(n, at)``, of
    which the footer and the index alone are read."""
    file = Bytes(bundle) if isinstance(bundle, (bytes, memoryview)) else bundle
    end = file.size()
    count, _, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
    if magic != SEEK_MAGIC:
        raise ValueError("not a seekable bundle")
    table = file.read_at(8 * count, end - 9 - 8 * count)
    frames, at = [], 0
    for packed, size in struct.iter_unpack("<II", table):
        frames.append((at, packed, size))
        at += packed
    kind, length = struct.unpack("<II", file.read_at(8, at))
    if kind != INDEX_SKIPPABLE:
        raise ValueError("no record index")
    index: dict[str, list[tuple[int, int, int]]] = {}
    for line in zstandard.ZstdDecompressor().decompress(file.read_at(length, at + 8)).decode().splitlines():
        rid, frame, start, size = line.split(" ")
        index.setdefault(rid, []).append((int(frame), int(start), int(size)))
    return frames, index


def read_frame(bundle, frame: tuple[int, int, int]) -> bytes:
    file = Bytes(bundle) if isinstance(bundle, (bytes, memoryview)) else bundle
    at, packed, size = frame
    return zstandard.ZstdDecompressor().decompress(file.read_at(packed, at), max_output_size=size)


def lookup(bundle, record_id: str) -> list[bytes]:
    """The records of that id, from their frames alone; none where the bundle has no such id."""
    file = Bytes(bundle) if isinstance(bundle, (bytes, memoryview)) else bundle
    frames, index = seek_table(file)
    return [read_frame(file, frames[frame])[at:at + length] for frame, at, length in index.get(record_id, [])]


def lookup_file(path: str, record_id: str) -> list[bytes]:
    """``lookup`` in a file of ``save_files``: its footer, its index and the frames of the records are read by byte range, nothing else."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as file:
        return lookup(file, record_id)


def parse(data: bytes):
    """(headers, block) of each record in a frame."""
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at)
        lines = data[at:cut].decode().split("\r\n")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        yield head, data[cut + 4:cut + 4 + size]
        at = cut + 4 + size + 4


def read(archives: DataFrame) -> DataFrame:
    """A row per record, from the archives alone; digests of responses are taken from the payload read."""

    def unpack(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from _records(name, Bytes(content.as_py()))

    return archives.select("bundle", "content").mapInArrow(unpack, RECORDS)


def _bare(urn):
    return None if urn is None or urn[1:-1] == URN else unquote(urn[1 + len(URN):-1])


def _records(name: str, bundle):
    """Rows of one bundle, a batch per frame."""
    for frame in seek_table(bundle)[0]:
        rows = []
        for head, block in parse(read_frame(bundle, frame)):
            http, _, payload = block.partition(b"\r\n\r\n")
            digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
            size = int(http.rpartition(b"Content-Length: ")[2])
            if head["WARC-Type"] == "response":
                digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
            rows.append((name, _bare(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), head["WARC-Type"], _bare(head.get("WARC-Refers-To")), size, digest))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), [pa.string()] * 5 + [pa.int64(), pa.string()])], names=[x.split()[0] for x in RECORDS.split(", ")])


def save_files(archives: DataFrame, folder: str) -> DataFrame:
    """Write every bundle as ``<folder>/<bundle>.warc.zst`` on a store pyarrow can open; returns the
    paths. A bundle is named by its content, so a task that runs again writes the same file."""

    def put(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                with store.open_output_stream(f"{base}/{name}.warc.zst", compression=None) as out:
                    out.write(content.as_buffer())
                yield pa.record_batch([pa.array([f"{folder}/{name}.warc.zst"])], names=["path"])

    return archives.select("bundle", "content").mapInArrow(put, "path string")


def read_files(paths: DataFrame) -> DataFrame:
    """A row per record of the files ``paths`` (path), as ``read`` gives for bundles; a task holds a frame at a time."""

    def unpack(batches):
        from pyarrow import fs

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as file:
                    yield from _records(path.rpartition("/")[2].removesuffix(".warc.zst"), file)

    return paths.select("path").mapInArrow(unpack, RECORDS)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archives = Scratch(spark, "warc").write(bundles(plan(pages)))
    kind = pages.schema["page_id"].dataType
    return read(archives).select(F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(p.h) AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h
"""
