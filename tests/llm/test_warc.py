import base64
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from clockroll.llm import warc_index as w
from clockroll.session import scratch_dir

SCHEMA = "page_id long, url string, html string, payload string, sha string, n int"


def _digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def _expected(rows, least=0):
    """(page, bytes, digest, kind, refers) of (page, url, html), by definition."""
    groups = {}
    for page, url, html in rows:
        groups.setdefault(html or "", []).append((page is not None, page or 0, url is not None, url or "", page))
    out = []
    for html, members in groups.items():
        size = len(html.encode())
        members.sort(key=lambda m: m[:4])
        for i, m in enumerate(members):
            head = i == len(members) - 1 or size < least
            out.append((m[4], size, _digest(html), "response" if head else "revisit", None if head else members[-1][4]))
    return sorted(out, key=str)


ROWS = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "http://a/4", ""), (None, "http://a/5", "<p>x</p>"),
        (6, "http://a/ä b\r\nX: y", "ünï 中文 😀\r\n\r\nWARC/1.1"), (7, "u", "z" * 300_000), (7, "u", "z" * 300_000), (7, "v", "z" * 300_000), (7, "u", "other"),
        *[(8, "u8", "again")] * 5, (9, "u9", "again"), (None, None, "lost")]


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "p", "s", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("least", [0, 6])
@pytest.mark.parametrize("shuffled", [False, True])
def test_records_come_back_as_defined(spark, monkeypatch, least, shuffled):
    if shuffled:  # as if the keys were too many to broadcast
        monkeypatch.setattr(w, "sized", lambda keys: keys)
    path = scratch_dir(spark, "warc") + "/p"
    index = w.write(_pages(spark, ROWS), path, least=least)
    got = w.digests(w.read(index, path)).collect()
    assert sorted(map(tuple, got), key=str) == _expected(ROWS, least)
    texts = {r["html"] or "" for r in _pages(spark, ROWS).collect()}
    assert {bytes(r["payload"]).decode() for r in w.read(index, path).where("record_type = 'response'").collect()} == texts


def test_selected_records_alone_are_read(spark):
    path = scratch_dir(spark, "warc") + "/p"
    index = w.write(_pages(spark, ROWS), path)
    some = index.where("url = 'http://a/2' OR digest = '" + _digest("lost") + "'")
    got = w.read(some, path).collect()
    assert sorted((r["page"], bytes(r["payload"])) if r["payload"] is not None else (r["page"], None) for r in got if r["page"]) == [("2", b"<p>x</p>")]
    assert {r["payload_digest"] for r in got} == {_digest("<p>x</p>"), _digest("lost")} and len(got) == some.count()


def test_archives_are_readable_by_any_gzip_reader(spark):
    path = scratch_dir(spark, "warc") + "/p"
    index = w.write(_pages(spark, ROWS), path, file_bytes=400)
    assert index.select("file").distinct().count() > 2  # full archives are followed by new ones
    for r in index.collect():
        with open(f"{path}/archives/{r['file']}", "rb") as f:
            f.seek(r["offset"])
            data = zlib.decompress(f.read(r["length"]), 31)
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        head = data.split(b"\r\n\r\n")[0].decode().split("\r\n")
        assert f"WARC-Type: {r['record_type']}" in head and not any(x.startswith("X: y") for x in head)


def test_ranges_coalesce_up_to_gap_and_span():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 10), ("b", 110, 5), ("b", 115, 90), ("b", 205, 5)]
    got = [(f, lo, hi, len(x)) for f, lo, hi, x in w.ranges(iter(rows), gap=5, span=96)]
    assert got == [("a", 0, 30, 3), ("a", 100, 110, 1), ("b", 110, 205, 2), ("b", 205, 210, 1)]
    assert list(w.ranges(iter([]), 5, 96)) == []


def test_a_changed_archive_is_noticed():
    row = {"sha": hashlib.sha1(b"abc").hexdigest(), "page": "1", "url": "u", "copy": 0, "size": 3, "kind": "response", "payload": b"abc"}
    data = w.page_record(row, w.CRAWLED)
    assert w.parse_record(data)["payload"] == b"abc"
    with pytest.raises(ValueError):
        w.parse_record(data.replace(b"abc", b"abd"))


def test_no_pages(spark):
    path = scratch_dir(spark, "warc") + "/p"
    index = w.write(_pages(spark, []), path)
    assert index.count() == 0 and w.read(index, path).count() == 0


def test_a_hot_payload_is_spread(spark):
    rows = [(i, f"u{i}", "same") for i in range(3000)] + [(5000, "r", "rep")] * 2000
    path = scratch_dir(spark, "warc") + "/p"
    index = w.write(_pages(spark, rows), path)
    kinds = {r["record_type"]: r["count"] for r in index.groupBy("record_type").count().collect()}
    assert kinds == {"response": 2, "revisit": 4998}
    got = w.digests(w.read(index, path, payload=False))
    assert got.where("record_type = 'revisit'").select("refers_to").distinct().orderBy(F.col("refers_to")).collect() == [(2999,), (5000,)]
