"""Archives with long headers, repeated page ids and junk that looks like members."""

import hashlib
import time
import zlib

import pytest

from loomspan.llm import warc


def put(path, data):
    path.write_bytes(data)
    return f"file://{path}"


def one(k, url="http://x", text=None):
    body = (text or f"page {k} " * 30).encode()
    return warc.record(k, url, body, None, hashlib.sha1(body).hexdigest())


@pytest.mark.parametrize("packed", [True, False])
def test_long_urls_are_kept(spark, packed, tmp_path):
    rows = [(1, "http://a", "x"), (2, "http://b/" + "u" * 1_000_000, "y" * 2000), (3, "http://c/" + "é" * 300_000, "z"), (4, "http://d", "y" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    out = warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}", packed=packed)).collect()
    assert sorted((r.page_id, r.url, r.record_type, r.refers_to) for r in out) == [(i, u, "revisit" if i == 2 else "response", 4 if i == 2 else None) for i, u, _ in rows]


def test_one_response_of_a_repeated_page_id(spark, tmp_path):
    text = "t" * 1500
    rows = [(5, "http://a", text), (5, "http://b", text), (5, None, text), (2, "http://z", text), (None, "http://n", text)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}")).collect()
    assert [(r.page_id, r.url) for r in out if r.record_type == "response"] == [(5, "http://b")]
    assert {r.refers_to for r in out if r.record_type == "revisit"} == {5} and len(out) == 5


@pytest.mark.parametrize("junk", [b"\x1f\x8b\x08" * 200_000, b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03" * 60_000, b"\x1f\x8b\x08\x08aaaaaa" * 60_000, b"WARC/1.1\r\nA: b\r\n" * 40_000, b"WARC/1.1" * 80_000])
def test_junk_of_marks_is_passed_in_time(junk, tmp_path):
    sound = [warc.member(one(1)), warc.member(one(2)), one(3)]
    path = put(tmp_path / "x.warc.gz", sound[0] + junk + sound[1] + sound[2])
    began = time.time()
    parts = list(warc.salvage(path))
    assert time.time() - began < 60
    assert [p.fields["warc-record-id"] for p in parts if p.kind == "record"] == [f"<urn:page:{k}>" for k in (1, 2, 3)]
    gaps = [(p.at, p.bytes) for p in parts if p.kind == "gap"]
    assert gaps == [(len(sound[0]), len(junk))]


def test_members_with_names_are_read(tmp_path):
    data = one(7)
    raw = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = raw.compress(data) + raw.flush() + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")
    head = b"\x1f\x8b\x08\x1e\0\0\0\0\0\xff" + (4).to_bytes(2, "little") + b"ab\0c" + b"name\0" + b"comment\0"
    head += (zlib.crc32(head) & 0xFFFF).to_bytes(2, "little")
    parts = list(warc.salvage(put(tmp_path / "n.warc.gz", head + body + warc.member(one(8)))))
    assert [p.fields["warc-record-id"] for p in parts] == ["<urn:page:7>", "<urn:page:8>"]


def test_tears_keep_what_came_before(tmp_path):
    records = [one(k, text="".join(chr(97 + (i * i * k) % 23) for i in range(4000))) for k in range(1, 30)]
    whole = bytearray(warc.member(b"".join(records)))
    whole[len(whole) // 2] ^= 0xFF
    parts = list(warc.salvage(put(tmp_path / "t.warc.gz", bytes(whole) + warc.member(one(99)))))
    found = [p.fields["warc-record-id"] for p in parts if p.kind == "record"]
    assert found[:5] == [f"<urn:page:{k}>" for k in range(1, 6)] and found[-1] == "<urn:page:99>"
