import gzip
import hashlib

import pytest

from placelake.llm import queries, warc
from placelake.llm.common import Scratch

BIG = "<p>" + "word " * 400 + "\r\n\r\n" + "é" * 10


@pytest.fixture
def pages(spark):
    rows = [(1, "http://a.example.com/x", BIG), (2, "http://b.example.com/x", BIG), (9, "http://a.example.com/x", BIG), (3, None, None),
            (4, "no scheme", ""), (5, "https://Z.org/ä?q=1\n2", "small"), (6, "https://z.org/", "small"), (None, "http://n.org/", BIG),
            (7, "http://c.net/", BIG + "other"), (8, "http://c.net/", "x" * 999), (10, "http://c.net/", "x" * 999), (11, "http://d.net/", "y" * 200_000),
            (12, "http://same.net/", BIG + "same"), (12, "http://same.net/", BIG + "same"), (None, "u", BIG + "nulls"), (None, "u", BIG + "nulls")]
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "page_id long, url string, html string, key string, digest string, file string")


def brute(rows):
    rows = [(p, (h or "").encode()) for p, h in rows]
    target = {}
    for p, h in rows:
        if p is not None and len(h) >= 1000:
            target[h] = max(target.get(h, p), p)
    out = []
    for p, h in rows:
        again = len(h) >= 1000 and h in target and p != target[h]
        out.append((-1 if p is None else p, len(h), hashlib.sha1(h).hexdigest(), "revisit" if again else "response", target[h] if again else None))
    return sorted(out, key=repr)


def written(pages, scratch, file_bytes=4000):
    warc.write_archives(warc.records(pages), f"{scratch.root}/a", file_bytes)
    files = warc.archive_files(pages.sparkSession, f"{scratch.root}/a")
    return files, scratch.write(warc.index_blocks(warc.capture_entries(files), block_lines=3), "index")


def test_round_trip_through_the_index(pages, scratch):
    files, blocks = written(pages, scratch)
    assert files.count() > 3 and blocks.count() > 3
    rows = warc.read_ranges(warc.read_entries(blocks)).collect()
    got = sorted(((-1 if r["page_id"] is None else r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in rows), key=repr)
    assert got == brute([(r["page_id"], r["html"]) for r in pages.collect()])
    texts = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    assert all(bytes(r["payload"]).decode() == texts[r["page_id"]] for r in rows if r["record_type"] == "response" and r["page_id"] is not None)


def test_find_reads_named_blocks_and_bytes_only(spark, pages, scratch):
    files, blocks = written(pages, scratch)
    wanted = spark.createDataFrame([("http://A.example.com/x",), ("http://c.net/",), ("http://none.net/",)], "url string")
    found = warc.find(blocks, wanted)
    entries = found.collect()
    assert sorted(r["page_id"] for r in entries) == [1, 7, 8, 9, 10]
    named = {(r["part"], r["block"]) for r in warc.named_blocks(blocks, wanted).collect()}
    keys = [r["key"] for r in warc.wanted_keys(wanted).collect()]
    assert named == {(r["part"], r["block"]) for r in blocks.collect() if any(r["first_key"] <= k <= r["last_key"] for k in keys)}
    assert 0 < len(named) < blocks.count()
    assert sorted(r["page_id"] for r in warc.read_ranges(found).collect()) == [1, 7, 8, 9, 10]
    by_file = {}
    for r in sorted(entries, key=lambda r: r["offset"]):
        by_file.setdefault(r["file"], []).append((r["offset"], r["length"]))
    read = sum(own[b][0] + own[b][1] - own[a][0] for own in by_file.values() for a, b in warc.runs_of([o for o, _ in own], [n for _, n in own]))
    assert read < sum(r["length"] for r in files.select("length").collect()) + 1
    assert all(r["key"] in keys for r in entries)


def test_reads_join_near_ranges():
    assert list(warc.runs_of([0, 10, 9000, 9010], [10, 5, 5, 5])) == [(0, 1), (2, 3)]
    assert list(warc.runs_of([0, 3 << 20], [3 << 20, 3 << 20])) == [(0, 0), (1, 1)] and list(warc.runs_of([], [])) == []


def test_archives_are_plain_gzip_with_urls(pages, scratch):
    files, _ = written(pages, scratch)
    text = b"".join(gzip.decompress(bytes(r["content"])) for r in files.collect()).decode()
    assert text.count("WARC/1.1\r\n") == pages.count() and "WARC-Target-URI: http://b.example.com/x\r\n" in text
    assert "WARC-Target-URI: https://Z.org/\u00e4?q=1%0A2\r\n" in text and "WARC-Target-URI: \r\n" in text


def test_a_very_large_record_ends_in_an_empty_member():
    large = bytes(17 << 20)
    packed = warc._member(large)
    assert packed[-1] == 0 and gzip.decompress(packed) == large
    found = list(warc.members(memoryview(packed + warc._member(b"next"))))
    assert [len(r) for _, _, r in found] == [17 << 20, 4] and gzip.decompress(packed[:found[0][1]]) == large
    with pytest.raises(ValueError, match="cut off"):
        list(warc.members(memoryview(packed[:50])))


def test_keys_of_a_domain_are_neighbours(spark):
    urls = spark.createDataFrame([("http://b.x.org/",), ("http://x.net/",), ("http://a.x.org/",), ("http://x.org/",)], "url string")
    keys = sorted(r[0] for r in urls.select(warc.reversed_host_key(urls["url"])).collect())
    assert [k.startswith("org") for k in keys] == [False, True, True, True]


def test_no_pages(spark, pages, scratch):
    files, blocks = written(pages.filter("false"), scratch)
    assert files.count() == 0 or warc.read_ranges(warc.read_entries(blocks)).count() == 0
    assert warc.read_ranges(warc.find(blocks, pages)).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    rows = queries.op7_capture_index(spark, sf).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=repr)
    assert got == brute([(r["page_id"], r["html"]) for r in pages])
