import hashlib

import pytest

from riskframe.llm import archives
from riskframe.session import scratch_path

V1 = (b"filedesc://old.arc 0.0.0.0 19960923142103 text/plain 70\n1 0 Somebody\nURL IP-address Archive-date Content-type Archive-length\n\n"
      b"\nhttp://a.example/x y 1.2.3.4 19961104142103 text/html 37\nHTTP/1.0 200 OK\nA: b\n\n<html>hi</html>"
      b"\ndns:a.example 1.2.3.4 199611041421 text/dns 5\n1.2.3")


def test_version_1():
    a, b, c = archives.read_arc(V1)
    assert a["URL"].startswith("filedesc:") and a["block"].startswith(b"1 0 Somebody")
    assert b["URL"] == "http://a.example/x y" and b["IP-address"] == "1.2.3.4" and not b["truncated"]
    assert archives.http_parts(b["block"])[1] == b"<html>hi</html>"
    assert c["block"] == b"1.2.3" and archives.iso_date(c["Archive-date"]) == "1996-11-04T14:21:00Z"


def test_version_2_round_trip_and_damage():
    records = [("http://x/1", "9.9.9.9", "text/html", 404, b"HTTP/1.1 404 No\r\n\r\n\n\nbody\n"), ("http://x/2", "-", "image/png", 200, b"")]
    image = archives.arc_image(2, "new.arc", records)
    got = list(archives.read_arc(image))
    assert [(r["URL"], r["IP-address"], r["Content-type"], int(r["Result-code"]), r["block"]) for r in got[1:]] == records
    assert image[got[1]["offset"]:].startswith(b"http://x/1")
    cut = list(archives.read_arc(image[: got[1]["offset"] + 70]))
    assert cut[-1]["truncated"]
    assert "error" in list(archives.read_arc(image + b"\nnot a header\n"))[-1]
    assert list(archives.read_arc(b"")) == []


@pytest.mark.parametrize("date,iso", [("19960923142103", "1996-09-23T14:21:03Z"), ("1996", "1996-01-01T00:00:00Z"), ("199612", "1996-12-01T00:00:00Z"),
                                      ("", "1970-01-01T00:00:00Z"), ("soon", "1970-01-01T00:00:00Z"), ("123456789012345", "1970-01-01T00:00:00Z")])
def test_dates(date, iso):
    assert archives.iso_date(date) == iso


def test_types_of_records(spark):
    got = {r.url: r for r in archives.arc_to_warc(spark.createDataFrame([("old.arc", V1, "x"), ("none", None, "y"), ("empty", b"", "z")], "path string, content binary, url string")).collect()}
    assert {u: r.record_type for u, r in got.items()} == {"filedesc://old.arc": "warcinfo", "http://a.example/x y": "response", "dns:a.example": "resource"}
    r = got["http://a.example/x y"]
    assert r.payload_digest == hashlib.sha256(b"<html>hi</html>").hexdigest() and r.record_id.startswith("<urn:uuid:") and r.warc_date == "1996-11-04T14:21:03Z"


def test_pages_round_trip(spark):
    long = "x" * 100
    rows = [(5, "http://a/ b", long), (3, "http://c", long), (None, "u", long), (3, "http://c", long), (7, None, "x" * 99), (8, "u", "x" * 99), (9, "u", None), (10, "u", ""),
            (11, "u", "é" * 50 + "\r\n\r\nHTTP/1.1\n\0"), (12, "u", "é" * 50 + "\r\n\r\nHTTP/1.1\n\0"), (13, "u", "y" * 3_000_000)]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], "page_id long, url string, html string, payload string, first_id long").repartition(3)
    path = scratch_path(spark, "test-warc")
    archives.write_warc(archives.mark_revisits(archives.arc_to_warc(archives.pages_to_arc(df))), path)
    back = archives.read_warc(spark, path).where("record_type IN ('response', 'revisit')").collect()
    assert all(r.digest_ok for r in back)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str)
    expected, first = [], {}
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        again = len(data) >= 100 and data in first
        if not again:
            first.setdefault(data, page)
        expected.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None))
    assert got == sorted(expected, key=str)
    ids = {r.record_id: r for r in back}
    assert len(ids) == len(rows) and all(ids[r.refers_to_id].page_id == r.refers_to for r in back if r.record_type == "revisit")


def test_no_pages(spark):
    path = scratch_path(spark, "test-warc")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    archives.write_warc(archives.mark_revisits(archives.arc_to_warc(archives.pages_to_arc(empty))), path)
    assert archives.read_warc(spark, path).count() == 0
