import gzip
import hashlib
import random
import re

import pytest
from chatledger.llm import warc as W
from pyspark.sql import functions as F

ODD = [
    (1, "http://a.com/x", "p" * 2000), (2, "http://a.com/x", "p" * 2000), (3, None, "p" * 2000), (4, "http://b.org", None),
    (5, "http://b.org", ""), (6, "no url", "short"), (7, "http://ü.de/ä b\r\nX: y", "short"), (None, "http://a.com/", "p" * 2000),
    (8, "u", "ends in breaks\r\n"), (9, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n\r\n\r\n"), (10, "u", "é" * 600),
    (11, "u", "é" * 600 + "\r\n\r"), (12, "u", "é" * 600), (12, "u", "é" * 600), (13, "http://z.com", "\n" * 1500 + "x" * 300_000),
    (14, "u", "x" * 999), (15, "u", "x" * 999), (16, "u", "y" * 1000), (17, "u", "y" * 1000), (18, "u", "\r\n" * 700),
]


def want(rows):
    best = {}
    for page, _, html in rows:
        html = html or ""
        best[html] = max((x for x in (best.get(html), page) if x is not None), default=None)
    for page, _, html in rows:
        data = (html or "").encode()
        response = best[html or ""]
        revisit = len(data) >= 1000 and response is not None and page != response
        yield page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", response if revisit else None


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id bigint, url string, html string, size string, digest int")


def test_round_trip(spark):
    got = W.archive(frame(spark, ODD)).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(str(tuple(r[c] for c in columns)) for r in got) == sorted(map(str, want(ODD)))
    keys = [(r.url_key, r.captured_at, r.page_id if r.page_id is not None else -1) for r in got]
    assert keys == sorted(keys)
    assert W.archive(frame(spark, ODD).limit(0)).count() == 0


def test_archives_are_warc(spark, tmp_path):
    """An independent reader: bytes of the files, record by record."""
    path = str(tmp_path / "archives")
    rows = W.decided(frame(spark, ODD), "page_id", "url", "html", F.lit("2024-01-01T00:00:00Z"), 1000)
    W.write_archives(rows, path)
    payloads, places = {}, set()
    for file in (tmp_path / "archives").glob("part-*"):
        data, at = gzip.decompress(file.read_bytes()), 0
        while at < len(data):
            head = re.compile(rb"WARC/1\.1\r\n(?:[^\r\n]+\r\n)*\r\n").match(data, at)
            fields = dict(x.split(": ", 1) for x in head[0].decode().split("\r\n")[1:-2])
            end = head.end() + int(fields["Content-Length"])
            assert data[end : end + 4] == b"\r\n\r\n"
            payloads.setdefault(fields["WARC-Type"], []).append(data[head.end() : end].split(b"\r\n\r\n", 1)[1])
            places.add((file.name, at))
            at = end + 4
    assert sorted(payloads["response"]) == sorted((h or "").encode() for (p, _, h), w in zip(ODD, want(ODD)) if w[3] == "response")
    assert set(payloads["revisit"]) == {b""}
    assert {(r.archive, r.position) for r in W.read_archives(spark, path).collect()} == places


def test_damage_is_found(spark, tmp_path):
    path = tmp_path / "archives"
    rows = W.decided(frame(spark, ODD[:1]), "page_id", "url", "html", F.lit("2024-01-01T00:00:00Z"), 1000)
    W.write_archives(rows, str(path))
    for file in path.glob("part-*"):
        file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"ppp", b"pqp", 1)))
    for crc in path.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="not what its record says"):
        W.read_archives(spark, str(path)).collect()


def test_loser_tree():
    rnd = random.Random(7)
    for k in (0, 1, 2, 3, 5, 8, 13, 40):
        runs = [sorted((rnd.randrange(50), 0) for _ in range(rnd.randrange(12))) for _ in range(k)]
        assert [x[0] for x in W.merged(runs)] == sorted(x[0] for r in runs for x in r)


def test_hot_url_is_spread(spark):
    rows = frame(spark, [(i, "http://hot.com/", f"page {i}") for i in range(3000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = W.archive(rows)
        sizes = [r.n for r in index.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 3000 and len(sizes) > 2 and max(sizes) < 1500
