"""Records and archives by round trips, the merge against sorting, edge rows by definition."""

import random

import pytest
from support import rows_of

from tidegate.llm import warc
from tidegate.state.shared import shared_root


@pytest.mark.parametrize("seed", range(30))
def test_merge(seed):
    rng = random.Random(seed)
    runs = [sorted((rng.randint(0, 9), k, j) for j in range(rng.randint(0, 12))) for k in range(rng.randint(0, 9))]
    out = list(warc.merge(runs, lambda row: row[0]))
    assert out == sorted((row for run in runs for row in run), key=lambda row: (row[0], row[1]))


def test_records_round_trip():
    bodies = ["", "plain", "a\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n", "é😀\x00", "\r\n"]
    archive = warc.END.join(warc.record(k, f"http://x/{k}", "2024-01-01T00:00:00Z", b.encode(), None, "response") for k, b in enumerate(bodies)) + warc.END
    assert [(f["WARC-Record-ID"], c.decode()) for _, f, c in warc.parse(archive.encode())] == [(f"<urn:page:{k}>", b) for k, b in enumerate(bodies)]
    with pytest.raises(ValueError):
        list(warc.parse(archive.encode()[:-3]))


def test_url_key():
    assert warc.url_key("http://B.example.COM:80/a?b") == "com,example,b:80)/a?b"
    assert warc.url_key("https://x?y") == "x)?y" and warc.url_key("https://x") == "x)"
    assert warc.url_key(None) == "" and warc.url_key("mailto:x") == "mailto:x"


def frame(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return pages.selectExpr("*", "'x' AS digest", "'y' AS payload", "0 AS first_id", "'z' AS kind", "1 AS captured")


ROWS = [
    (5, "http://b.com/1", "same"), (3, "http://a.com/1", "same"), (9, None, None), (4, "http://a.com/1", ""), (None, "http://c.com\n/", "same"),
    (7, "http://a.com/1", "long é " * 50_000), (8, "http://a.com/2", "x\r\n\r\nWARC/1.1"), (None, "u", "only"), (3, "http://a.com/1", "same"),
]


@pytest.mark.parametrize("archive_bytes", [1, 300, 1 << 23])
def test_edge_rows(spark, archive_bytes):
    got = rows_of(warc.archive_and_index(frame(spark, ROWS), archive_bytes=archive_bytes).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    expected = []
    for page, _, html in ROWS:
        data = (html or "").encode()
        ids = [p for p, _, h in ROWS if (h or "") == (html or "") and p is not None]
        first = min(ids) if ids else None
        kind = "response" if page == first else "revisit"
        expected.append((page, len(data), warc.base32_sha1(data), kind, first if kind == "revisit" else None))
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_small_payloads_are_all_responses(spark):
    got = warc.archive_and_index(frame(spark, ROWS), least_bytes=5).collect()
    assert {r["record_type"] for r in got if r["payload_bytes"] < 5} == {"response"}


def test_global_order(spark):
    rng = random.Random(4)
    rows = [(k, f"http://{rng.choice('abc')}.{rng.choice(['com', 'org'])}/{rng.randint(0, 5)}", str(rng.random())) for k in range(500)]
    folder = shared_root(spark)
    warc.write_archives(frame(spark, rows).repartition(5), f"{folder}/archives", archive_bytes=3000)
    runs = warc.stage(warc.read_runs(spark, f"{folder}/archives"), f"{folder}/runs")
    assert runs.select("run").distinct().count() > 20
    index = warc.merged_index(runs, rows_per_range=64)
    order = [(r["url_key"], r["captured"], r["page_id"]) for r in index.collect()]
    assert order == sorted(order) and len(order) == 500 and index.rdd.getNumPartitions() > 1
    by_id = {p: (u, h) for p, u, h in rows}
    assert all(warc.url_key(by_id[p][0]) == key for key, _, p in order)


def test_empty_table(spark):
    assert warc.archive_and_index(frame(spark, [])).collect() == []
