import gzip
import hashlib
import io

import pytest

from txnwatch.llm import warc as W


def brute(rows):
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` from the statement."""
    payloads = [(i, (html or "").encode()) for i, html in rows]
    out = []
    for i, payload in payloads:
        same = [j for j, other in payloads if other == payload and j is not None]
        first = min(same) if same and len(payload) >= 100 else i
        sha = hashlib.sha256(payload).hexdigest()
        out.append((i, len(payload), sha, "response" if first == i else "revisit", None if first == i else first))
    return sorted(out, key=str)


PAGES = "page_id long, url string, html string"


def test_pages(spark, frame):
    big = "<p>é</p>" * 30
    rows = [(1, big), (2, big), (3, "x" * 99), (4, "x" * 99), (5, "x" * 100), (6, "x" * 100), (7, None), (8, ""),
            (9, "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (10, "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (0, big), (11, "é" * 300_000)]
    pages = frame([(i, f"http://x/{i}?a b%20\r\n" if i % 2 else None, html) for i, html in rows], PAGES)
    got = W.archived(pages.repartition(3)).collect()
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=str) == brute(rows)
    assert all(r["digest_ok"] for r in got)
    assert {r["page_id"]: r["url"] for r in got} == {i: f"http://x/{i}?a b%20\r\n" if i % 2 else None for i, _ in rows}
    assert W.archived(pages.limit(0)).count() == 0


def test_ties_and_nulls(spark, frame):
    html = "y" * 200
    rows = [(3, None, html), (3, None, html), (5, None, html), (None, None, html), (None, None, "z" * 200), (None, None, "z" * 200)]
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in W.archived(frame(rows, PAGES)).collect()), key=str)
    want = [(3, "response", None, 200)] * 2 + [(5, "revisit", 3, 200), (None, "revisit", 3, 200)] + [(None, "response", None, 200)] * 2
    assert got == sorted(want, key=str)


def test_payloads_come_back(spark, frame, monkeypatch):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 2000)  # many archives
    rows = [(i, None, f"<html>{i}</html>" * (i % 40)) for i in range(200)]
    archives = W.write_archives(frame(rows, PAGES))
    assert archives.count() > 1
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in W.read_archives(archives, payloads=True).collect()}
    assert got == {i: html for i, _, html in rows}


def one(payload=b"hello" * 40):
    return W.page_record(7, "http://a/", payload, hashlib.sha256(payload).hexdigest(), None)


def test_members_are_plain_gzip():
    text = gzip.decompress(one())
    head, block = text.split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\n") and f"Content-Length: {len(block) - 4}".encode() in head
    assert block.endswith(b"hello\r\n\r\n")
    two = list(W.read_records(io.BytesIO(one() + one(b""))))
    assert [r["payload_bytes"] for r in two] == [200, 0]


def test_small_pieces_read_the_same(monkeypatch):
    want = list(W.read_records(io.BytesIO(one() + one()), payloads=True))
    monkeypatch.setattr(W, "PIECE", 3)
    assert list(W.read_records(io.BytesIO(one() + one()), payloads=True)) == want


def test_damage_is_seen():
    whole = gzip.decompress(one())
    changed = W.zlib_member(whole.replace(b"hellohello", b"hellOhello", 1))
    assert [r["digest_ok"] for r in W.read_records(io.BytesIO(changed))] == [False]
    for bad in (whole[:-30], whole + b"more", whole.replace(b"WARC/1.1", b"WARC/0.1")):
        with pytest.raises(ValueError):
            list(W.read_records(io.BytesIO(W.zlib_member(bad))))
    with pytest.raises(ValueError):
        list(W.read_records(io.BytesIO(one()[:-20])))
