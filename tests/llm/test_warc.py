"""Archives: round trip, revisits, selected byte ranges."""

import base64
import gzip
import hashlib

import pytest

from shopsight.llm import warc

PAGES = [
    (1, "http://a/", "<p>same</p>"),
    (2, "http://b/", "<p>same</p>"),
    (3, None, "<p>é😀</p>\r\n\r\nWARC/1.1\r\n"),
    (4, "http://c/\r\nX: y", ""),
    (5, "http://d/", None),
    (6, "http://e/", "z" * 300_000),
    (7, "http://f/", "<p>other</p>"),
    (7, "http://f/", "<p>other</p>"),
    (None, "http://g/", "<p>same</p>"),
    (None, "http://h/", "<p>alone</p>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, 1, "x") for p in PAGES], "page_id long, url string, html string, offset int, digest string")


def _expected(revisit_from):
    out = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        same = [j for j, _, other in PAGES if (other or "") == (html or "") and j is not None]
        stored = max(same, default=None)
        refers = stored if len(body) >= revisit_from and stored != i else None
        own = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i or 0, len(body), own, "response" if refers is None else "revisit", refers, None if refers is not None else body))
    return sorted(out, key=repr)


@pytest.mark.parametrize("revisit_from", [0, 1, 12])
def test_round_trip(pages, revisit_from):
    rows = warc.read(warc.write(pages, revisit_from)).collect()
    got = [
        (r["page_id"] or 0, r["payload_bytes"], r["digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"]))
        for r in rows
    ]
    assert sorted(got, key=repr) == _expected(revisit_from)


def test_selected_records_and_plain_gzip(pages):
    index = warc.write(pages)
    some = index.filter("page_id in (2, 6)")
    assert sorted(r["page_id"] for r in warc.read(some).collect()) == [2, 6]
    files = {r["file"].removeprefix("file:") for r in index.collect()}
    whole = b"".join(gzip.open(f).read() for f in files)
    assert whole.count(b"WARC-Type: ") == len(PAGES)
    assert b"WARC-Refers-To: " + warc._record_id(2, warc.digest(b"<p>same</p>")).encode() in whole


def test_ranges_are_read_together(monkeypatch):
    monkeypatch.setattr(warc, "GAP", 10)
    monkeypatch.setattr(warc, "READ", 100)
    reads = list(warc.coalesced([(0, 30), (30, 30), (65, 20), (200, 90), (290, 5), (295, 50)]))
    assert [(a, b) for a, b, _ in reads] == [(0, 85), (200, 295), (295, 345)]
    assert sum(len(r) for _, _, r in reads) == 6


def test_damage_is_noticed():
    member, _ = warc._member(1, "u", b"payload", None, "1970-01-01T00:00:00Z")
    broken = gzip.compress(gzip.decompress(member).replace(b"payload", b"paylord"))
    with pytest.raises(ValueError):
        warc._parse(broken)


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(none)).count() == 0
