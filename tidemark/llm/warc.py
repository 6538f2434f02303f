"""WARC archives of pages: written as whole-file gzip, normalised, and read back by offset.

``write_archives`` puts one record per page into archives that are a single gzip stream, as some
tools write them. ``normalise`` inflates such a stream once, record by record, rewrites every
record as a gzip member of its own and writes a sidecar index (JSON lines with offset, length
and the record's headers), so that any record can be read without the ones before it.
``read_records`` does that, a range of an archive at a time. An archive that ends before its last
gzip member does is refused; zero bytes after the last member are padding.

An archive closes at ``ARCHIVE_BYTES`` of records, so a task never holds more than one record
and its buffers. Files go to the shared folder under names of their own; only names that reached
a checkpoint are read, so a task that runs twice does no harm.

Equal payloads of at least ``REVISIT_BYTES`` bytes are stored once, with the smallest page_id;
the others are revisit records without payload. Defined cases: a null html is an empty payload,
a null url gives no target header, line breaks in urls are percent-encoded; a null page_id counts
as larger than any; rows that repeat the smallest id of a payload are all responses; an empty
table gives no archive; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import math
import posixpath
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import durable, scratch_path, written
from tidemark.sinks.folders import qualified

ARCHIVE_BYTES = 64 << 20
REVISIT_BYTES = 100
RANGE_BYTES = 8 << 20
LEVEL = 4
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = (
    "archive string, offset long, length long, record_id string, record_type string, refers_to string, "
    "digest string, target string")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a qualified path; folders with ``file:`` are shared mounts."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _id(page_id) -> str:
    return "" if page_id is None or pd.isna(page_id) else str(int(page_id))


def record(page_id, url: str | None, payload: bytes, digest: str, first_id) -> bytes:
    """One record; a page whose payload stands under another id becomes a revisit."""
    revisit = not pd.isna(first_id) and _id(first_id) != _id(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{_id(page_id)}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{_id(first_id)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines) if name}


class _Output:
    """A file of the store that is written in pieces."""

    def __init__(self, folder: str, suffix: str):
        store, place = file_system(folder)
        store.create_dir(place, recursive=True)
        self.name = f"{folder}/{uuid.uuid4().hex}{suffix}"
        self.stream = store.open_output_stream(posixpath.join(place, posixpath.basename(self.name)), compression=None)
        self.at = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.stream.close()


def _writer(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = packer = None
        size = count = 0

        def close() -> pa.RecordBatch:
            out.write(packer.flush())
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([out.name]), pa.array([count], pa.int64())], ["archive", "records"])

        for batch in batches:
            columns = [batch.column(k) for k in range(5)]
            for values in zip(*columns):
                page_id, url, html, digest, first_id = (v.as_py() for v in values)
                if out is None:
                    out, size, count = _Output(folder, ".warc.gz"), 0, 0
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = record(page_id, url, (html or "").encode(), digest, first_id)
                out.write(packer.compress(data))
                size, count = size + len(data), count + 1
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return run


def write_archives(pages: DataFrame) -> DataFrame:
    """(archive, records) of archives that hold a record per page, each one gzip stream."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(payload, 256).alias("digest"))
    firsts = (
        rows.where(F.octet_length(payload) >= REVISIT_BYTES)
        .groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("pages"))
        .where("pages > 1").select("digest", "first_id"))
    joined = rows.join(written(firsts, "payloads"), "digest", "left")
    folder = qualified(pages.sparkSession, scratch_path(pages.sparkSession, "archives"))
    return durable(joined.select("page_id", "url", "html", "digest", "first_id").mapInArrow(
        _writer(folder), "archive string, records long"))


def stream_records(source) -> Iterator[tuple[bytes, bytes]]:
    """(header block, content block) of each record of a gzip stream, inflated once in pieces.

    A stream that ends before its last member does is refused, even where a record ends.
    """
    inflate, rest, members = None, b"", 0
    held = bytearray()

    def more() -> bool:
        nonlocal inflate, rest, members
        data, rest = rest or source.read(CHUNK), b""
        if inflate is None:  # between members; zero bytes there are padding
            while data and not (data := data.lstrip(b"\0")):
                data = source.read(CHUNK)
            if not data:
                if not members:
                    raise ValueError("the archive holds no gzip member")
                return False
            inflate, members = zlib.decompressobj(31), members + 1
        out = inflate.decompress(data, CHUNK)
        if inflate.eof:
            inflate, rest = None, inflate.unused_data
        elif not data and not out:
            raise ValueError("the archive ends inside a gzip member")
        else:
            rest = inflate.unconsumed_tail
        held.extend(out)
        return True

    searched = 0
    while True:
        end = held.find(b"\r\n\r\n", max(0, searched - 3))
        if end < 0:
            searched = len(held)
            if not more():
                if held.strip():
                    raise ValueError("the archive ends inside a record")
                return
            continue
        head = bytes(held[: end + 4])
        size = int(headers(head)["content-length"])
        while len(held) < end + 8 + size:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield head, bytes(held[end + 4 : end + 4 + size])
        del held[: end + 8 + size]
        searched = 0


def normalise_archive(path: str, folder: str) -> tuple[str, int]:
    """Rewrite one archive with a member per record; gives the sidecar index and the records."""
    store, place = file_system(path)
    out, index, count = _Output(folder, ".warc.gz"), _Output(folder + "/index", ".json"), 0
    with store.open_input_stream(place, compression=None) as source:
        for head, block in stream_records(source):
            packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            member = packer.compress(head + block + b"\r\n\r\n") + packer.flush()
            said = headers(head)
            line = {
                "archive": out.name, "offset": out.at, "length": len(member), "record_id": said.get("warc-record-id"),
                "record_type": said.get("warc-type"), "refers_to": said.get("warc-refers-to"),
                "digest": said.get("warc-payload-digest"), "target": said.get("warc-target-uri")}
            index.write((json.dumps(line) + "\n").encode())
            out.write(member)
            count += 1
    out.close()
    index.close()
    return index.name, count


def _normaliser(folder: str):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["archive"]:
                yield pd.DataFrame([normalise_archive(path, folder)], columns=["sidecar", "records"])

    return run


def normalise(archives: DataFrame) -> DataFrame:
    """The index (one row per record) of the normalised form of the archives in ``archive``."""
    spark = archives.sparkSession
    folder = qualified(spark, scratch_path(spark, "normalised"))
    tasks = max(1, archives.count())
    done = durable(archives.select("archive").repartition(tasks).mapInPandas(
        _normaliser(folder), "sidecar string, records long"))
    if done.isEmpty():
        return spark.createDataFrame([], INDEX_SCHEMA)
    # A sidecar that a lost task left is not in the checkpoint and so is not read.
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    rows = spark.read.schema(INDEX_SCHEMA).json(f"{folder}/index").withColumn("__sidecar", name)
    known = done.select(F.element_at(F.split("sidecar", "/"), -1).alias("__sidecar"))
    return rows.join(known, "__sidecar", "left_semi").drop("__sidecar")


def read_member(file, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Headers and content block of the record at an offset of an open archive."""
    raw = zlib.decompress(file.read_at(length, offset), 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    said = headers(head)
    return said, rest[: int(said["content-length"])]


def _number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _described(file, offset: int, length: int) -> tuple:
    said, block = read_member(file, offset, length)
    http, _, payload = block.partition(b"\r\n\r\n")
    page = _number(said["warc-record-id"])
    if said["warc-type"] == "revisit":
        size = int(headers(http)["content-length"])
        return page, size, said["warc-payload-digest"].removeprefix("sha256:"), "revisit", _number(said["warc-refers-to"])
    return page, len(payload), hashlib.sha256(payload).hexdigest(), "response", None


def _reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    at = file = None
    for batch in batches:
        rows = []
        for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
            if archive != at:
                if file is not None:
                    file.close()
                store, place = file_system(archive)
                at, file = archive, store.open_input_file(place)
            rows.append(_described(file, offset, length))
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
    if file is not None:
        file.close()


def read_records(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every indexed record.

    Records are dealt by ranges of ``RANGE_BYTES`` of their archives, so the work follows the bytes to be
    read and not the small index, and a task opens an archive once for a range.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    span = F.floor(F.col("offset") / RANGE_BYTES)
    dealt = index.select("archive", "offset", "length").repartition(max(1, math.ceil(total / RANGE_BYTES)), "archive", span)
    return dealt.sortWithinPartitions("archive", "offset").mapInArrow(
        _reader, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, normalise the archives, and read every record back by its offset."""
    return read_records(normalise(write_archives(pages)))


SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= {REVISIT_BYTES} GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""
