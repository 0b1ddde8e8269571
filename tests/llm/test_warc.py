import base64
import hashlib

import pytest

from millrace.llm import warc
from millrace.llm.queries import op8_warc


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def expected(rows, least=0):
    latest = {}
    for page_id, _, html in rows:
        b = (html or "").encode()
        if len(b) >= least and page_id is not None:
            latest[b] = max(latest.get(b, -1), page_id)
    out = []
    for page_id, _, html in rows:
        b = (html or "").encode()
        top = latest.get(b)
        first = top is None or top == page_id
        out.append((page_id, len(b), digest(b), "response" if first else "revisit", None if first else top))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


ODD = [
    (1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "u v\r\nX: y", ""), (5, "é", "é漢😀\r\n\r\nWARC/1.1\r\n\r\n" * 400), (6, "long", "abc é" * 50_000),
    (7, "long", "abc é" * 50_000), (7, "twice", "same"), (7, "twice", "same"), (8, "z", "same"), (None, "n", "<p>x</p>"), (None, "n", "alone"), (9, "r", "0\r\n\r\n"), (10, "big", "q" * 70_000), (10, "big", "q" * 70_000),
]


@pytest.mark.parametrize("compression", ["gzip", "none"])
@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, tmp_path, compression, least):
    df = spark.createDataFrame([(*r, 5) for r in ODD], "page_id long, url string, html string, payload int")
    path = str(tmp_path / "w")
    warc.write(df, path, revisit_from=least, segment_bytes=1000, chunk_bytes=300, pack_bytes=5000, compression=compression)
    back = warc.read(spark, path)
    assert got(back) == expected(ODD, least)
    texts = {(r.page_id, r.payload_digest): bytes(r.payload) for r in back.filter("record_type = 'response'").collect()}
    assert all(digest(v) == k[1] for k, v in texts.items())
    assert back.filter("problem IS NOT NULL").count() == 0


def test_lost_segment_is_reported(spark, tmp_path):
    records = list(warc.records(1, "u", b"x" * 5000, None, 1000, 300))
    (tmp_path / "a.warc").write_bytes(b"".join(r + warc.END for r in records[:2] + records[3:]))
    (row,) = warc.read(spark, str(tmp_path)).collect()
    assert row.problem == "a segment is missing" and row.payload is None


def test_segments_in_any_order_and_file(spark, tmp_path):
    records = list(warc.records(1, "u", b"x" * 5000, None, 1000, 300))
    for k, r in enumerate(reversed(records)):
        (tmp_path / f"{k}.warc").write_bytes(r + warc.END)
    (row,) = warc.read(spark, str(tmp_path)).collect()
    assert bytes(row.payload) == b"x" * 5000 and row.problem is None


def test_empty_table(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    assert warc.read(spark, str(tmp_path / "e")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert got(op8_warc(spark, sf)) == expected(rows)
