import hashlib

import pytest
import zstandard

from holdwright.llm import warc


def expected(rows):
    newest = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= 1000:
            newest[h] = max(p, newest.get(h, p))
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        other = newest.get(h) if len(b) >= 1000 else None
        refers = other if other is not None and other != p else None
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    back = warc.round_trip(pages)
    assert got(back) == expected(rows)
    assert sorted((r.page_id, r.url, bytes(r.payload).decode()) for r in back.collect()) == sorted(rows)


def test_odd(spark):
    big, edge = "<p>é</p>" * 400, "x" * 1000
    rows = [
        (1, "http://a/1", big), (9, "http://a/9", big), (9, "http://a/9", big), (None, None, big), (2, "http://a/\r\nWARC-Type: x", edge), (3, None, edge),
        (4, "u", "x" * 999), (5, "u", "x" * 999), (6, "u", None), (7, "u", ""), (-8, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", "y" * 2000), (None, "u", "y" * 2000),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, sha1 string, size int")
    assert got(warc.round_trip(df)) == expected(rows)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_file_has_a_dictionary_and_one_frame_a_record(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    records = [warc.record(r.page_id, r.url, r.html.encode(), len(r.html.encode()), hashlib.sha1(r.html.encode()).hexdigest(), None) for r in pages]
    data = warc.compress(records)
    assert data[:4] == warc.DICTIONARY_MAGIC
    assert len(list(warc.records(data, len(records)))) == len(records)
    plain = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in records)
    assert len(data) < plain
    with pytest.raises(ValueError):
        list(warc.records(data[:-9], len(records)))
