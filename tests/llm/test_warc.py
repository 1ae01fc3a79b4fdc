"""WARC archives: what is written is read back; records of any stream are found where the index says."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
from pathlib import Path

import pytest
from pyspark.errors import PythonException

from cardloom.llm import warc
from cardloom.llm.common import shared_folder

HOSTILE = ["\r\n\r\n", "\r\n", "\r", "\n", "WARC/1.1\r\nContent-Length: 5\r\n\r\n", "x", "é😀", "\r\n\r", "HTTP/1.1 200 OK\r\n\r\n"]


def table(spark, rows):
    full = [(*r, "z", "z", "z") for r in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, id string, payload string, `of` string").repartition(3)


def round_trip(spark, pages, **kw):
    place = shared_folder(spark)
    warc.write_archives(pages, f"{place}/raw", **kw)
    index = warc.normalise(spark, f"{place}/raw", f"{place}/members")
    return place.removeprefix("file:"), index, warc.read_records(index, f"{place}/members")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least=0):
    out = []
    for i, url, html in rows:
        body = (html or "").encode()
        group = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        keep = max(group, default=None)
        revisit = len(body) >= least and keep is not None and i != keep
        out.append((None if i is None else str(i), url, len(body), digest(html), "revisit" if revisit else "response",
                    str(keep) if revisit else None, b"" if revisit else body))
    return sorted(out, key=repr)


def found(read):
    return sorted(((r.id, r.url, r.http_bytes, r.digest, r.type, r.refers_to, bytes(r.payload)) for r in read.collect()), key=repr)


@pytest.fixture(scope="module")
def odd_pages():
    rng = random.Random(2)
    rows = [(i, f"http://h.example/{i}?a=b c", "".join(rng.choice(HOSTILE) for _ in range(rng.randrange(40)))) for i in range(200)]
    # ends of records across the buffers of a reader
    rows += [(300 + i, "u", "a" * (65536 - 700 + 7 * i) + "\r\n\r\n" * 9 + "\r\n\r") for i in range(60)]
    rows += [(i, "u", "copy") for i in range(400, 430)] + [(429, "u", "copy"), (None, "u", "copy"), (None, None, "only null"), (None, None, "only null"),
             (500, None, None), (501, "", ""), (502, "tab", "  "), (503, "u", "y" * 5_000_000), (-7, "u", "<p>minus</p>")]
    return rows


def test_round_trip(spark, odd_pages):
    place, index, read = round_trip(spark, table(spark, odd_pages))
    assert found(read) == expected(odd_pages)
    for path in sorted(Path(place, "raw").glob("*.gz")):
        raw = gzip.decompress(path.read_bytes())
        assert raw == b"" or raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    # every record is a member of its own, one behind the other, and nothing else is in the file
    members = {}
    for r in index.collect():
        members.setdefault(r.archive, []).append((r.record, r.offset, r.length))
    for archive, spans in members.items():
        data, end = Path(place, "members", archive).read_bytes(), 0
        for n, (record, offset, length) in enumerate(sorted(spans)):
            assert (record, offset) == (n, end)
            assert gzip.decompress(data[offset:offset + length]).startswith(b"WARC/1.1\r\n")
            end += length
        assert end == len(data)


def test_small_payloads_are_not_revisited(spark, odd_pages):
    rows = [r for r in odd_pages if r[0] is not None and r[0] >= 400]
    assert found(round_trip(spark, table(spark, rows), revisit_bytes=4)[2]) == expected(rows, 4)
    assert found(round_trip(spark, table(spark, rows), revisit_bytes=5)[2]) == expected(rows, 5)


def test_addresses_lose_line_ends(spark):
    read = round_trip(spark, table(spark, [(1, "http://a\r\nWARC-Type: x\t", "t")]))[2]
    assert [(r.type, r.url) for r in read.collect()] == [("response", "http://aWARC-Type: x")]


def test_empty_table(spark):
    place, index, read = round_trip(spark, table(spark, []))
    assert index.count() == read.count() == 0


def test_foreign_streams(spark, tmp_path):
    """Records of other kinds, several members, folded and odd-cased headers; broken files are refused."""
    record = lambda head, block: b"WARC/1.0\r\n" + head + b"content-length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    info = record(b"WARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\n", b"software: x\r\n\r\n\r\n")
    other = record(b"warc-type: resource\r\nWARC-Record-ID: <urn:uuid:2>\r\nWARC-Target-URI: http://a\r\n b\r\n", b"")
    Path(tmp_path, "a.warc.gz").write_bytes(gzip.compress(info + other + info))
    Path(tmp_path, "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(other) + gzip.compress(other))
    target = f"{shared_folder(spark)}/out"
    index = warc.normalise(spark, str(tmp_path), target)
    got = sorted((r.archive[0], r.record, r.type, r.id, r.url) for r in index.collect())
    i, o = ("warcinfo", "urn:uuid:1", None), ("resource", "urn:uuid:2", "http://a b")
    assert got == [("a", 0, *i), ("a", 1, *o), ("a", 2, *i), ("b", 0, *i), ("b", 1, *o), ("b", 2, *o)]
    data = {(r.archive, r.record): Path(target.removeprefix("file:"), r.archive).read_bytes()[r.offset:r.offset + r.length] for r in index.collect()}
    assert {gzip.decompress(d) for d in data.values()} == {info, other}
    one = warc.read_records(index.filter("type = 'resource' AND record = 1"), target).collect()
    assert len(one) == 2 and all(bytes(r.payload) == b"" and r.http_bytes is None for r in one)
    for name, raw in (("cut", info + other[:-40]), ("junk", b"hello\r\n\r\n" + info)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "x.warc.gz").write_bytes(gzip.compress(raw))
        with pytest.raises(PythonException, match="x.warc.gz"):
            warc.normalise(spark, str(folder), f"{target}-{name}")


def test_records_in_any_pieces():
    stream = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(b), b) for b in (b"", b"\r\n\r\n", b"ab\r\n", b"WARC/1.1\r\n\r\n"))
    want = [b"", b"\r\n\r\n", b"ab\r\n", b"WARC/1.1\r\n\r\n"]
    for size in (1, 2, 3, 7, 1000):
        records, got = warc.Records("x"), []
        for i in range(0, len(stream), size):
            got += [w[len(w) - int(f["content-length"]):] for f, w in records.feed(stream[i:i + size])]
        records.end()
        assert got == want


def test_query(run, duck):
    rows = duck.execute("SELECT page_id, url, html FROM pages").fetchall()
    got = run("op11_warc", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == {int(i): (n, d, t, None if r is None else int(r)) for i, _, n, d, t, r, _ in expected(rows)}
