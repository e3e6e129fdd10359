import base64
import hashlib

import pytest

from pacekit.llm.arc import parse_arc, version_block
from pacekit.llm.warc import convert_pages, iso_date, parse_warc
from tests.llm.helpers import clashing

SCHEMA = "page_id long, url string, html string"


def b32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_arc_versions_and_declared_lengths():
    body = b"HTTP/1.1 200 OK\r\n\r\nline\n\nhttp://fake 1.1.1.1 20200101000000 text/html 5\nabc"
    one = version_block(1, "x.arc").encode() + b"\nhttp://a/b c 1.2.3.4 20200102030405 text/html %d\n" % len(body) + body + b"\n"
    (at, h, got), = parse_arc(one)
    assert bytes(got) == body and h["URL"] == "http://a/b c" and h["Archive-date"] == "20200102030405"
    two = version_block(2, "x.arc").encode() + b"\nhttp://a 1.2.3.4 20200102 text/html 404 - - 77 x.arc %d\n" % len(body) + body
    (_, h, got), = parse_arc(two)
    assert h["Result-code"] == "404" and h["Offset"] == "77" and bytes(got) == body
    assert iso_date("20200102") == "2020-01-02T00:00:00Z"
    with pytest.raises(ValueError):
        list(parse_arc(one[:-10]))
    with pytest.raises(ValueError):
        list(parse_arc(b"http://a 1.2.3.4 20200102 text/html 0\n"))


def test_warc_length_rules():
    rec = b"WARC/1.1\r\nContent-Length: 7\r\n\r\na\r\n\r\nbc\r\n\r\n"
    assert [b for _, b in parse_warc(rec + rec)] == [b"a\r\n\r\nbc"] * 2
    with pytest.raises(ValueError):
        list(parse_warc(rec[:-3]))


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_round_trip_matches_brute_force(spark, min_bytes):
    html = ["<p>é\r\n\r\nWARC/1.1\n\nx</p>", "same", "same", "same", "", None, "", "a\r\nb", "x" * 200_000, "same "]
    pages = [(i * 2 + 3, f"http://h/{i}?q=a b\n%", h) for i, h in enumerate(html)]
    pages += [(5000 - i, None, f"big {i % 40}") for i in range(300)] + [(7, "http://h/2", "same"), (None, "u", "same"), (None, "u", None)]
    df = clashing(spark.createDataFrame(pages, SCHEMA))
    got = convert_pages(df, min_bytes=min_bytes, file_bytes=100_000).collect()
    assert len(got) == len(pages)
    want = []
    groups = {}
    for i, _, h in pages:
        groups.setdefault(h or "", []).append(i)
    for h, ids in groups.items():
        ids = sorted(ids, key=lambda x: (x is None, x or 0))
        for n, i in enumerate(ids):
            again = n > 0 and len(h.encode()) >= min_bytes
            want.append((i is None, i or 0, len(h.encode()), b32(h), "revisit" if again else "response",
                         (ids[0] if ids[0] is not None else -1) if again else -1))
    assert sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type,
                   -1 if r.refers_to is None else r.refers_to) for r in got) == sorted(want)
    assert len({r.record_id for r in got}) == len(got)
    page = {r.record_id: r.page_id for r in got if r.record_type == "response"}
    assert all(page[r.refers_to_record] == r.refers_to for r in got if r.record_type == "revisit")


def test_escaped_urls_stay_and_responses_refer_to_nothing(spark):
    urls = ["http://h/a%20b", "http://h/a b\t%41", "", None]
    got = convert_pages(spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], SCHEMA)).collect()
    assert {r.page_id: r.url for r in got} == {0: "http://h/a%20b", 1: "http://h/a%20b%09%41", 2: "-", 3: "-"}
    assert {(r.record_type, r.refers_to_record, r.refers_to) for r in got} == {("response", None, None)}


def test_empty_table(spark):
    assert convert_pages(spark.createDataFrame([], SCHEMA)).count() == 0
