import base64
import gzip
import hashlib
from collections import Counter

import pytest

from tripwire.llm import warc_chunks as w

PAGES = [
    (3, "http://a/x y\r\nInjected: 1", "<p>é😀</p>\r\n\r\nWARC/1.1\r\n"), (1, None, "same"), (2, "http://b/", "same"), (5, "http://c", None),
    (4, "http://d", ""), (None, "http://e", "same"), (6, "http://f", "z" * 500_000 + "é"), (7, "http://g", "z" * 500_000 + "é"),
    (8, "http://h", "twice"), (8, "http://h", "twice"), (None, None, "only here"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "?") for p in PAGES], "page_id long, url string, html string, payload string")


def brute(rows):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        own = page == first.get(html or "")
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if own else "revisit", None if own else first.get(html or "")))
    return Counter(out)


def test_round_trip(pages):
    files = w.archive_pages(pages)
    assert Counter(map(tuple, w.page_totals(w.read_chunks(files)).collect())) == brute(PAGES)


def test_chunks_are_small_and_make_up_the_payload(pages):
    rows = w.read_chunks(w.archive_pages(pages)).filter("page_id = 6").orderBy("chunk_no").collect()
    assert len(rows) == 8 and max(len(r.data) for r in rows) <= w.CHUNK
    digest = hashlib.sha1()
    for r in rows:
        digest.update(r.data)
        assert r.payload_digest == w.base32(digest.digest())
    assert b"".join(r.data for r in rows).decode() == PAGES[6][2] and [r.last for r in rows] == [False] * 7 + [True]


def test_archives_are_plain_warc(pages):
    files = [r.file.removeprefix("file://") for r in w.archive_pages(pages).collect()]
    text = b"".join(gzip.open(f).read() for f in files)
    heads = [x for x in text.split(b"WARC/1.1\r\n") if x.startswith(b"WARC-Type")]
    kinds = Counter(h.split(b"\r\n")[0] for h in heads)
    assert kinds[b"WARC-Type: response"] == 7 and kinds[b"WARC-Type: revisit"] == 4
    assert b"\r\nInjected: 1" not in text


def test_small_payloads_are_all_responses(pages):
    rows = w.page_totals(w.read_chunks(w.archive_pages(pages, least_bytes=10))).collect()
    assert sorted(r.page_id for r in rows if r.record_type == "revisit") == [7]


def test_files_roll_over_and_hold_everything(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    files = w.archive_pages(pages)
    got = Counter(map(tuple, w.page_totals(w.read_chunks(files, keep_data=False)).collect()))
    assert got == brute([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_no_pages(pages):
    files = w.archive_pages(pages.limit(0))
    assert files.count() == 0 and w.read_chunks(files).collect() == []


def test_a_cut_off_archive_is_an_error(pages, tmp_path, spark):
    name = w.archive_pages(pages).first().file.removeprefix("file://")
    (tmp_path / "cut.warc.gz").write_bytes(open(name, "rb").read()[:-40])
    with open(tmp_path / "cut.warc.gz", "rb") as stream, pytest.raises(EOFError):
        list(w._chunks_of(stream, False))
