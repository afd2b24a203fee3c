from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest

from skerry.llm import warc


def expected(rows):
    best = {}
    for page, html in rows:
        body = (html or "").encode()
        if body not in best or best[body] is None or (page is not None and page > best[body]):
            best[body] = page
    out, seen = [], set()
    for page, html in rows:
        body = (html or "").encode()
        first = page == best[body] and body not in seen
        if first:
            seen.add(body)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "response" if first else "revisit", None if first else best[body]))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [7, 16_384])
def test_round_trip(spark, tmp_path, chunk):
    rows = [(1, "<p>eins</p>"), (2, "<p>eins</p>"), (3, None), (4, ""), (5, "ä" * 50_000), (6, "ä" * 50_000)]
    rows += [(7, "twice"), (7, "twice"), (7, "other"), (None, "no id"), (8, "WARC/1.1\r\n\r\nx\r\n\r\n"), (None, "<p>eins</p>")]
    pages = spark.createDataFrame([(p, None if p == 2 else f"http://x/{p}\r\n", h, "c") for p, h in rows], "page_id long, url string, html string, size string")
    got = sorted((tuple(r) for r in warc.archive_pages(pages, f"file://{tmp_path}/a", chunk=chunk).collect()), key=str)
    assert got == expected(rows)


def test_payload_comes_back_in_chunks(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "0123456789" * 10), (2, "u", "")], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, f"file://{tmp_path}/b")
    rows = warc.read_archives(manifest, 30, with_data=True).orderBy("page_id", "chunk_no").collect()
    assert [len(r["data"]) for r in rows] == [30, 30, 30, 10, 0]
    assert b"".join(r["data"] for r in rows) == b"0123456789" * 10
    assert [r["payload_bytes"] for r in rows] == [30, 60, 90, 100, 0]


def test_threshold_and_empty(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    rows = warc.archive_pages(pages, f"file://{tmp_path}/c", least_bytes=3).collect()
    assert {r["record_type"] for r in rows} == {"response"}
    assert warc.archive_pages(pages.limit(0), f"file://{tmp_path}/d").count() == 0


def test_broken_archive_is_an_error():
    sink = io.BytesIO()
    writer = warc.ArchiveWriter(sink)
    writer.begin(1, "u", hashlib.sha1(b"abc").hexdigest(), 3, 1, 0)
    writer.chunk(b"ab")
    writer.end()
    with pytest.raises(ValueError):
        list(warc.stream_records(gzip.GzipFile(fileobj=io.BytesIO(sink.getvalue()))))
