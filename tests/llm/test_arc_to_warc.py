import base64
import hashlib
import random
import re

import pytest

from tasador.llm import arc_to_warc as A
from tasador.llm.common import shared_path

SCHEMA = "page_id long, url string, html string, digest int, page int"


def brute(rows):
    newest = {}
    for page, _, html, *_ in rows:
        h = html or ""
        if page is not None:
            newest[h] = max(newest.get(h, page), page)
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        top = newest.get(html or "")
        kind = "response" if page == top else "revisit"
        out.append((page, kind, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), None if kind == "response" else top, data if kind == "response" else None))
    return sorted(out, key=str)


def test_round_trip_with_separators_in_payloads(spark):
    rng = random.Random(3)
    parts = ["\r\n", "\r\n\r\n", "\r", "\n", "WARC/1.0\r\n", "a", "é", "", "Content-Length: 5", "<p>x</p>"]
    rows = [(i, f"http://h/{i} x", "".join(rng.choices(parts, k=rng.randrange(0, 9))), 1, 2) for i in range(400)]
    rows += [(None, None, "lonely", 1, 2), (7, "u", rows[7][2], 1, 2), (500, None, None, 1, 2), (501, "v", "", 1, 2), (502, "w", "long " * 200_000, 1, 2), (503, "w", "long " * 200_000, 1, 2)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = A.pages_to_warc(pages, shared_path(spark, "warc"), per_archive=7)
    got = sorted(((r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got.collect()), key=str)
    assert got == brute(rows)


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = A.pages_to_warc(pages, shared_path(spark, "warc"), min_payload=3)
    assert {r.page_id: r.record_type for r in got.collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert A.pages_to_warc(pages, shared_path(spark, "warc")).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_versions_of_the_header_line(version):
    data = A.write_arc("a.arc", version, "20010203040506", [(5, "http://x/a b", b"hi\n\nthere"), (None, None, b"")])
    block, one, two = A.parse_arc(data)
    assert block[0]["url"] == "filedesc://a.arc" and block[2].startswith(f"{version} 0 ".encode())
    assert one[0]["url"] == "http://x/a%20b" and one[0]["date"] == "20010203040506"
    assert A.split_http(one[2])[1] == b"hi\n\nthere" and int(one[0]["length"]) == len(one[2])
    assert A.http_field(one[2], "X-Page-Id") == 5 and A.http_field(two[2], "X-Page-Id") is None
    assert two[0]["url"] == "-" and data[two[1] : two[1] + 2] == b"- "
    assert A.warc_date("20010203040506") == "2001-02-03T04:05:06Z" and A.warc_date("1999") == "1999-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        list(A.parse_arc(data[:-3]))


def test_record_ids_differ_and_block_digests_hold(spark):
    path = shared_path(spark, "warc")
    pages = spark.createDataFrame([(i, "u", f"p{i % 3}") for i in range(9)], "page_id long, url string, html string")
    A.pages_to_warc(pages, path)
    text = A.END.join(r.value for r in spark.read.option("lineSep", A.END).text(path).collect())
    assert len(set(re.findall(r"WARC-Record-ID: (\S+)", text))) == 9
    assert len(re.findall(r"WARC-Type: revisit", text)) == 6
