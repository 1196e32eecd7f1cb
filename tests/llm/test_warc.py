import gzip
import hashlib
import json
import os
import random

import pytest

from tallyforge.llm import queries, warc

BIG = "<p>" + "same payload " * 200


def brute_force(rows):
    out, first = [], {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= 1000:
            first[data] = max(page, first.get(data, page))
    for page, url, html in rows:
        data = (html or "").encode()
        own = first.get(data, page) if page is not None else None
        revisit = page is not None and own != page
        out.append((page, url, "revisit" if revisit else "response", len(data), hashlib.sha1(data).hexdigest(), own if revisit else None))
    return sorted(out, key=repr)


def _round_trip(spark, pages, **options):
    folder = warc.new_archive_folder(spark)
    captures = warc.write_archives(pages, folder, **options)
    index = warc.write_index(captures, folder, block_lines=7)
    return folder, captures, index


ROWS = [(1, "http://a.org/x", BIG), (9, "http://a.org/y?b=1#c", BIG), (4, None, BIG), (5, "http://WWW.A.org:80/x", "small"), (6, "u", "small"),
        (7, "http://[bad", None), (8, "https://é.example/ü\n", ""), (None, "http://a.org/x", BIG), (None, None, None), (9, "http://a.org/y?b=1#c", BIG),
        (10, "http://b.org", "é" * 700), (11, "http://b.org", "é" * 700)]


def test_round_trip_of_odd_rows(spark):
    pages = spark.createDataFrame([(*r, "x", "y") for r in ROWS], "page_id long, url string, html string, file string, digest string").repartition(3)
    folder, _, index = _round_trip(spark, pages)
    got = warc.fetch(warc.lookup(pages, index, folder), folder, with_payload=True).collect()
    assert sorted(((r.page_id, r.url, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in got), key=repr) == brute_force(ROWS)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert sorted(len(r.payload) for r in got if r.payload is not None) == sorted(b for _, _, t, b, _, _ in brute_force(ROWS) if t == "response")


def test_archives_are_standard_gzip_members(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1)
    folder, captures, _ = _round_trip(spark, pages, file_bytes=1500)
    root = folder.removeprefix("file://")
    names = sorted(f for f in os.listdir(root) if f.endswith(".warc.gz"))
    assert len(names) > 1 and {r.file for r in captures.collect()} == set(names)
    data = b"".join(gzip.open(f"{root}/{n}").read() for n in names)
    assert data.count(b"WARC/1.0\r\n") == len(ROWS)
    with pytest.raises(ValueError):
        warc.parse(data[:200])


def test_lookup_equals_a_scan(spark):
    r = random.Random(1)
    rows = [(i, f"http://h{r.randrange(9)}.org/{r.randrange(40)}", "x") for i in range(400)] + [(1000 + i, "http://hot.org/", "x") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # several block files on small data
    try:
        folder, captures, index = _round_trip(spark, pages)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert index.count() > 1 and index.agg({"lines": "sum"}).first()[0] == len(rows)
    asked = ["http://h3.org/7", "http://hot.org/", "http://none.org/", None, "http://h0.org/0", "HTTP://www.h3.ORG/7#x"]
    found = warc.lookup(spark.createDataFrame([(a,) for a in asked], "url string"), index, folder).collect()
    keys = {warc.url_key(a) for a in asked}
    assert sorted(f.page_id for f in found) == sorted(p for p, u, _ in rows if warc.url_key(u) in keys)
    places = {c.page_id: (c.file, c.offset, c.length) for c in captures.collect()}
    assert all((f.file, f.offset, f.length) == places[f.page_id] for f in found)
    name = index.first().index_file                   # directory entries are the first keys of their blocks
    one = warc.Index(folder, name)
    assert [one.block(k)[0][0] for k in range(len(one.directory))] == one.first == sorted(one.first)
    assert json.loads(open(folder.removeprefix("file://") + f"/{name}.dir").read()) == one.directory


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder, captures, index = _round_trip(spark, pages)
    assert captures.count() == index.count() == 0
    assert warc.fetch(warc.lookup(pages, index, folder), folder).collect() == []


def test_query_matches_brute_force(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = queries.queries()["op3_warc_index"](spark, sf).collect()
    assert sorted((r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in got) == \
        sorted((p, t, b, d, f) for p, _, t, b, d, f in brute_force(rows))


@pytest.mark.parametrize("url,key", [("http://M.a.org:80/B?c#d", "org,a,m)/b?c"), ("https://www.a.org", "org,a)/"), (None, ")"), ("", ")"),
                                     ("not a url", ")"), ("http://[x", ")")])
def test_url_key(url, key):
    assert warc.url_key(url) == key
