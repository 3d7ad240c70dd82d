import base64
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from ferrule.llm import warc

KIND = "page_id long, url string, html string, digest string, offset int"


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=300), st.one_of(st.none(), st.text(max_size=30)), st.booleans())
def test_records_come_back(payload, url, revisit):
    fields, http, back = warc.parsed(warc.record(5, url, payload, warc.digest_of(payload), 9 if revisit else None))
    assert fields["warc-type"] == ("revisit" if revisit else "response") and int(http["content-length"]) == len(payload)
    assert back == (b"" if revisit else payload) and ("warc-target-uri" in fields) == (url is not None)


def test_ranges():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 200_000, 10), ("b", 0, 10), ("b", 15, 5)]
    assert list(warc.ranges(rows)) == [(0, 2), (2, 3), (3, 5)]
    assert list(warc.ranges(rows, most=15)) == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5)]
    assert list(warc.ranges([])) == []


def test_write_and_read(spark):
    rows = [(1, "u", "a"), (2, "u", "a"), (5, None, "a"), (3, "v", None), (4, "v", ""), (6, "w", "ß" * 5000), (6, "w", "ß" * 5000), (None, "z", "ß" * 5000), (7, "x\r\ny", "b"), (None, None, None)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND)
    index = warc.write(pages, archive_bytes=300)
    assert index.count() == len(rows) and index.select("archive").distinct().count() > 1
    got = warc.read(index).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    refers = {1: 5, 2: 5, 3: 4, None: None}
    assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest) for r in got) == sorted((p or 0, len((h or "").encode()), digest(h)) for p, _, h in rows)
    assert all(r.refers_to == refers.get(r.page_id) for r in got if r.page_id)
    assert sorted(r.refers_to for r in got if r.page_id is None) == [4, 6]
    assert all(bytes(r.payload).decode() == "ß" * 5000 for r in got if r.page_id == 6)
    some = warc.read(index.where("page_id = 7")).collect()
    assert [(r.page_id, bytes(r.payload)) for r in some] == [(7, b"b")]


def test_nothing(spark):
    index = warc.write(spark.createDataFrame([], KIND))
    assert index.count() == 0 and warc.read(index).count() == 0
