import base64
import hashlib
import heapq
import random
import uuid

import pytest

from hourglass.llm.common import shared_dir
from hourglass.llm.warc import archive_pages, loser_tree_merge, mark_revisits, write_archives

PAGES = "page_id long, url string, html string, ts string"
HTML = ["", None, "<p>a</p>", "<p>a</p>", "x\r\n\r\nWARC/1.0\r\n\r\n", "é" * 5000, "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "a\n" * 40_000, "\r\n\r\n", " "]
URLS = [None, "http://b.com/x y", "http://A.com/1#f", "http://a.com/1", "http://a.com/2?q=\r\nInjected: x", "nope", "http://c.a.com/", "http://ä.com/", "", "http://a.com/1"]


def brute(rows):
    keep = {}
    for i, _, h in rows:
        keep[h or ""] = max(keep.get(h or "", i), i)
    return sorted((i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
                   "response" if keep[h or ""] == i else "revisit", None if keep[h or ""] == i else keep[h or ""]) for i, _, h in rows)


def digest_rows(index):
    return sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in index.collect())


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_round_trip_and_order(spark, size):
    rows = [(i, u, h) for i, (u, h) in enumerate(zip(URLS * 3, (HTML * 3), strict=True))]
    df = spark.createDataFrame([(*r, "clash") for r in rows], PAGES).repartition(4)
    index = archive_pages(df, archive_bytes=size)
    assert digest_rows(index) == brute(rows)
    order = [(r["url_key"], r["ts"], r["page_id"]) for r in index.collect()]
    assert order == sorted(order)


def test_uncompressed_archives_hold_records_at_their_offsets(spark):
    from hourglass.llm.warc import read_index

    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    df = spark.createDataFrame([(i, u, h, "") for i, (u, h) in enumerate(zip(URLS, HTML, strict=True))], PAGES)
    write_archives(mark_revisits(df), path, compression="none")
    for r in read_index(spark, path).collect():
        with open(r["archive"].removeprefix("file:"), "rb") as f:
            f.seek(r["offset"])
            record = f.read(r["length"])
        assert record.startswith(b"WARC/1.0\r\n") and record.endswith(b"\r\n\r\n")
        assert f"<urn:page:{r['page_id']}>".encode() in record


def test_null_keys_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "u", "h", ""), (None, "u", "k", ""), (3, "u", "h", ""), (3, "u", "h", "")], PAGES)
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in archive_pages(df).collect())
    assert got == [(0, "response", 0), (0, "revisit", 3), (3, "response", 0), (3, "response", 0)]
    assert archive_pages(spark.createDataFrame([], PAGES)).collect() == []


def test_loser_tree_against_heapq():
    rng = random.Random(3)
    for k in range(9):
        runs = [sorted((rng.randrange(20), r) for _ in range(rng.randrange(12))) for r in range(k)]
        assert list(loser_tree_merge(runs)) == list(heapq.merge(*runs))
