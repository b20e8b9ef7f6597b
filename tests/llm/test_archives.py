"""ARC to WARC: headers, lengths, duplicates and the round trip."""

import gzip
import hashlib
import zlib

import pytest
from llm_fixtures import SF0001

from caldim.llm import archives as A
from caldim.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, length string, digest string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)


def plain(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        f = first.get(b)
        revisit = f is not None and f != i
        out.append((-1 if i is None else i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def test_round_trip_of_odd_pages(spark):
    big, text = "é" * 60 + "<p>", "x" * 100
    rows = [(k, f"http://a/{k}", big) for k in (9, 4, 6)] + [(1, None, None), (2, "http://b c\n/é", ""), (3, "http://c", "WARC/1.1\r\n\r\nURL 1\n")]
    rows += [(10, "http://d", "\r\n\r\n" + text), (11, "http://d", "\r\n\r\n" + text), (12, "http://e", "y" * 99), (13, "http://e", "y" * 99)]
    rows += [(None, "http://f", big), (14, "http://g", text), (14, "http://g", text), (15, "http://h", "\n" * 300 + "z" * 300_000), (16, "u", "a\x00b\x85 c" * 40)]
    got = A.round_trip(made(spark, rows)).collect()
    assert sorted((tuple(-1 if k == 0 and v is None else v for k, v in enumerate(r)) for r in got), key=str) == plain(rows)
    assert A.round_trip(made(spark, rows).limit(0)).count() == 0


def test_files_are_split_and_whole(spark, scratch):
    rows = [(k, f"http://a/{k}", f"page {k} " * 20) for k in range(25)]
    A.write_arc(made(spark, rows).coalesce(1), scratch, 2, records=10)
    old = A.read_arc(spark, [scratch])
    assert len(old.inputFiles()) == 3
    assert {(r.page_id, r.url, r.payload) for r in old.collect()} == {(i, u, h) for i, u, h in rows}


def test_parse_versions():
    """Header lines of both versions, as other writers leave them."""
    doc = b"HTTP/1.0 200 OK\r\n\r\n<p>hi</p>"
    one = A.version_block(1).encode() + b"\n" + f"http://x/ 1.2.3.4 20010203040506 text/html {len(doc)}\n".encode() + doc + b"\n"
    two = A.version_block(2).encode() + f"\nhttp://x/ 1.2.3.4 2001 text/html 200 - - 77 f.arc {len(doc)}\n".encode() + doc + b"\n"
    assert list(A.parse_arc(one)) == [("http://x/", "1.2.3.4", "20010203040506", "text/html", doc)]
    assert list(A.parse_arc(two)) == [("http://x/", "1.2.3.4", "2001", "text/html", doc)]
    assert A._content("f", gzip.compress(one) + gzip.compress(two)) == one + two
    assert list(A.parse_arc(b"")) == []
    with pytest.raises(ValueError):
        list(A.parse_arc(A.version_block(1).encode() + b"\nhttp://x/ 1 2\n"))
    with pytest.raises(ValueError):
        list(A.parse_arc(one[:-10]))


def test_synthesised_headers():
    assert A.iso("20010203040506") == "2001-02-03T04:05:06Z" and A.iso("2001") == "2001-01-01T00:00:00Z"
    a, b = A.record_id("record", "f", 1), A.record_id("record", "f", 2)
    assert a != b and a == A.record_id("record", "f", 1) and a.startswith("<urn:uuid:")
    record = A.warc("response", a, A.iso("2001"), [("Page-Id", 1)], "application/http", "é".encode())
    (head, block), = A.parse_warc(record)
    assert head["Content-Length"] == "2" and block == "é".encode() and head["WARC-Record-ID"] == a
    assert head["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()


def test_members():
    """Every record is a member of its own, whatever its length."""
    for n in (0, 1, 100, (1 << 24) - 1, 1 << 24, (1 << 24) + 7):
        body = bytes(n)
        raw = A.member(body) + b"\0"
        assert A._content("f", raw) == body and gzip.decompress(raw) == body


def test_ids_are_unique_and_revisits_name_their_first(spark, scratch):
    """Repeated rows too; each record can be read by the offset of its member."""
    big = "same payload " * 20
    rows = [(k, f"http://a/{k}", big) for k in range(30)] + [(3, "http://a/3", big)] * 4 + [(40, "http://b", "own " * 50)] * 3 + [(None, "http://c", big)]
    A.write_arc(made(spark, rows).repartition(3), f"{scratch}/arc", 1, records=7)
    A.convert(spark, [f"{scratch}/arc"], f"{scratch}/warc", per_file=5)
    heads, n_files = [], 0
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{scratch}/warc").collect():
        raw, at = bytes(r.content), 0
        n_files += 1
        while at < len(raw):
            d = zlib.decompressobj(31)
            (head, block), = A.parse_warc(d.decompress(raw[at:]))
            assert head["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
            heads.append(head)
            at = len(raw) - len(d.unused_data)
    ids = [h["WARC-Record-ID"] for h in heads]
    assert len(set(ids)) == len(ids) == len(rows) + sum(h["WARC-Type"] == "warcinfo" for h in heads) and n_files > 3
    first = [h for h in heads if h.get("Page-Id") == "0"]
    again = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert len(first) == 1 and len(again) == 29 + 4 + 1
    for h in again:
        assert h["WARC-Refers-To"] == first[0]["WARC-Record-ID"] and h["WARC-Refers-To-Target-URI"] == "http://a/0"
        assert h["WARC-Refers-To-Date"] == first[0]["WARC-Date"] and h["Refers-To-Page-Id"] == "0"


def test_hot_and_other_payloads_meet_alike(spark, monkeypatch):
    monkeypatch.setattr(A, "FEW", 3)
    rows = [(k, f"http://a/{k}", f"payload {k % 7} " * 30 if k < 14 else "hot " * 60) for k in range(40)]
    assert sorted((tuple(r) for r in A.round_trip(made(spark, rows)).collect()), key=str) == plain(rows)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/pages.parquet").select("page_id", "url", "html").collect()]
    got = QUERIES["op9_arc_to_warc"](spark, SF0001).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)
