import gzip
import hashlib
import random

import pytest

from salesloom.llm import warc


def test_records_round_trip_in_any_chunks():
    rng = random.Random(1)
    blocks = [rng.randbytes(n) for n in (0, 1, 5000, 200_000)]
    archive = b"".join(warc.member([("WARC-Type", "resource"), ("WARC-Record-ID", f"<urn:x:{k}>")], b) for k, b in enumerate(blocks))
    for size in (1, 7, 1000, len(archive)):
        if size == 1 and len(archive) > 300_000:
            continue
        chunks = (archive[i : i + size] for i in range(0, len(archive), size))
        assert [r.block for r in warc.read_records(chunks)] == blocks
    assert gzip.decompress(archive).count(b"WARC/1.1\r\n") == 4


def broken():
    good = warc.page_member("1", "http://x/", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    text = gzip.decompress(good)
    yield good[:-3]
    yield gzip.compress(text.replace(b"payload\r", b"paylaod\r"))
    yield gzip.compress(text.replace(b"Content-Length: 8", b"Content-Length: 9"))
    yield gzip.compress(text + b"more")
    yield gzip.compress(b"no record at all\r\n\r\n")
    yield good + b"junk"


@pytest.mark.parametrize("archive", broken())
def test_broken_archives_are_errors(archive):
    with pytest.raises(warc.WarcError):
        list(warc.read_records([archive]))


def test_pages_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    big, other = "<p>é</p>" * 200, "<p>x</p>" * 300
    rows = [(k, f"http://h/{k} ü\n", big) for k in range(12)] + [(k, None, other) for k in (50, 40)]
    rows += [(60, "u", "small"), (61, "u", "small"), (62, "u", None), (None, "u", big), (11, "u", big), (63, "u", "y" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "d", "p") for r in rows], "page_id long, url string, html string, digest string, payload string")
    folder = warc.write_archives(pages)
    found = [
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
        for r in warc.read_archives(spark, folder).collect()
    ]
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        last = max((p for p, _, h in rows if h == html and p is not None), default=None)
        revisit = len(data) >= 1000 and page != last
        name = None if page is None else str(page)
        expected.append((name, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", str(last) if revisit else None))
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    payloads = {r.page_id: r.payload for r in warc.read_archives(spark, folder).where("record_type = 'response'").collect()}
    assert payloads["60"] == b"small" and payloads["11"].decode() == big


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(pages)).collect() == []
