import gzip
import hashlib
import io
import os
import zlib

import pytest
from llm_data import prose, rows_of

from tidemark.llm import warc

PAGES = "page_id long, url string, html string, digest string"
HTML = [
    "", None, "short", "short", "x" * 99, "x" * 99, "y" * 100, "y" * 100, "é" * 50, "é" * 50, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 9,
    prose(1, 400_000), prose(1, 400_000), "\r\n\r\n" * 40,
]


def pages(spark):
    rows = [(20 - i, f"http://a.org/{i}\r\nX: y" if i % 2 else None, h, "clash") for i, h in enumerate(HTML)]
    return spark.createDataFrame(rows, PAGES)


def expected():
    ids = {}
    for i, h in enumerate(HTML):
        ids.setdefault(h or "", []).append(20 - i)
    out = []
    for i, h in enumerate(HTML):
        raw, first = (h or "").encode(), min(ids[h or ""])
        again = len(raw) >= 100 and first != 20 - i
        out.append((20 - i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("archive_bytes", [64 << 20, 200])
def test_round_trip(spark, archive_bytes, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive_bytes)
    assert rows_of(warc.archive_round_trip(pages(spark))) == expected()


def test_normalised_archive_has_a_member_per_record(spark):
    archives = warc.write_archives(pages(spark))
    for row in archives.collect():
        raw = open(warc.file_system(row.archive)[1], "rb").read()
        one = zlib.decompressobj(31)
        one.decompress(raw)
        assert one.eof and not one.unused_data  # a single stream
    index = warc.normalise(archives).collect()
    assert len(index) == len(HTML)
    for name in {r.archive for r in index}:
        path = warc.file_system(name)[1]
        mine = sorted((r.offset, r.length) for r in index if r.archive == name)
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))]
        assert sum(n for _, n in mine) == os.path.getsize(path)
        assert gzip.open(path).read().count(b"WARC-Record-ID") == len(mine)


def test_null_and_repeated_ids(spark):
    same = "z" * 200
    rows = [(None, None, same, ""), (4, None, same, ""), (4, None, same, ""), (9, None, same, ""), (None, None, "a" * 300, "")]
    got = rows_of(warc.archive_round_trip(spark.createDataFrame(rows, PAGES)), "page_id", "record_type", "refers_to")
    assert got == sorted([
        (None, "revisit", 4), (4, "response", None), (4, "response", None), (9, "revisit", 4), (None, "response", None)], key=repr)


@pytest.mark.parametrize("members", [1, 3])
def test_stream_is_cut_anywhere(members, monkeypatch):
    records = [warc.record(i, "http://x", bytes([65 + i]) * (3000 * i), "d", None) for i in range(9)]
    parts = [b"".join(records[k::members]) for k in range(members)]
    data = b"".join(gzip.compress(p) for p in parts)
    for chunk in (1, 7, 1000):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        got = [h + b + b"\r\n\r\n" for h, b in warc.stream_records(io.BytesIO(data))]
        assert got == [r for k in range(members) for r in records[k::members]]


@pytest.mark.parametrize("members", [1, 3])
def test_a_cut_at_any_byte_fails(members):
    records = [warc.record(i, "http://x", bytes([65 + i]) * 50, "d", None) for i in range(3)]
    parts = [b"".join(records)] if members == 1 else records
    data = b"".join(gzip.compress(p) for p in parts)
    whole = {sum(len(gzip.compress(p)) for p in parts[:k]) for k in range(1, len(parts) + 1)}
    for end in range(len(data)):
        if end not in whole:
            with pytest.raises(ValueError):
                list(warc.stream_records(io.BytesIO(data[:end])))


def test_padding_after_members(monkeypatch):
    records = [warc.record(i, None, bytes([65 + i]) * 5000, "d", None) for i in range(4)]
    data = b"".join(gzip.compress(r) + b"\0" * 700 for r in records)
    for chunk in (1, 64, 1 << 20):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        assert [h + b + b"\r\n\r\n" for h, b in warc.stream_records(io.BytesIO(data))] == records


def test_archives_are_read_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 500)
    index = warc.normalise(warc.write_archives(pages(spark)))
    rows = warc.read_records(index)
    assert rows.rdd.getNumPartitions() > 10
    assert rows_of(rows) == expected()


def test_cut_off_archive_fails():
    data = gzip.compress(warc.record(1, None, b"x" * 5000, "d", None)[:-2000])
    with pytest.raises(ValueError):
        list(warc.stream_records(io.BytesIO(data)))
