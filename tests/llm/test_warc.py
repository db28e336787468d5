"""Archives are valid gzip of valid records, and the index finds every capture."""

import glob
import gzip
import hashlib
import io

import pytest

from zoneflow.llm import warc
from zoneflow.llm.scratch import Scratch


def material():
    same = "é" * 700
    rows = [(i, f"http://h{i % 7}.example.com/p/{i % 11}?q={i}", f"<p>{i}</p>" * (i % 300)) for i in range(300)]
    rows += [(1000 + i, "http://www.hot.example.org/x", same) for i in range(40)]
    rows += [
        (2000, None, None), (2001, "no host", ""), (2002, "http://a.b/\r\nX: y z", "a"), (2003, "http://ü.example/ä", "a"),
        (None, "http://n.example/", same), (1039, "http://www.hot.example.org/x", same), (2004, "http://big.example/", "x" * (17 << 20)),
        (2005, "http://crlf.example/", "WARC/1.1\r\n\r\n" * 200 + "\0\n"),
    ]
    return rows


def expected(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in data:
        if len(b) >= 1000 and i is not None:
            first[b] = max(i, first.get(b, i))
    out = []
    for i, b in data:
        revisit = i is not None and len(b) >= 1000 and i < first[b]
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", first[b] if revisit else None))
    return sorted(out, key=str)


def test_round_trip_through_the_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_ENTRIES", 7)
    rows, path = material(), str(tmp_path / "archives")
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, page string")
    warc.write_archives(pages, path)
    records = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/part-*"))
    assert records.count(b"WARC-Type: ") == len(rows)
    scratch = Scratch(spark)
    index = warc.build_index(warc.captures(spark, path), scratch)
    assert index.count() > 20
    keys = pages.select(warc.clean_uri("url").alias("uri")).select(warc.url_key("uri").alias("key"))
    found = scratch.keep(warc.lookup(index, keys))
    read = warc.read_records(spark, path, found).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read), key=str)
    assert got == expected(rows)
    payloads = {(i, (h or "").encode()) for i, _, h in rows}
    assert all((r.page_id, bytes(r.payload)) in payloads for r in read if r.record_type == "response")

    hot = warc.lookup(index, spark.createDataFrame([("org,example,hot,www)/x",), ("absent)/",), (None,)], "key string")).collect()
    assert len(hot) == 41 and {r.kind for r in hot} == {"response", "revisit"}


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "none"))
    entries = warc.captures(spark, str(tmp_path / "none"))
    index = warc.build_index(entries, Scratch(spark))
    assert entries.count() == 0 and warc.lookup(index, pages.selectExpr("url as key")).count() == 0


def test_keys(spark):
    rows = [("http://WWW.Example.com:80/a?b#c", "com,example,www)/a?b"), ("https://u@x.org", "org,x)/"), ("nothing", "nothing"),
            ("http://x.org?q", "org,x)/?q")]
    df = spark.createDataFrame(rows, "url string, want string")
    assert all(r.key == r.want for r in df.withColumn("key", warc.url_key("url")).collect())


def test_urls_that_end_in_other_white_space(spark, tmp_path):
    rows = [(i, f"http://end.example/{i}{c}", "a") for i, c in enumerate(map(chr, (0xA0, 0x3000, 0x2028, 0x85, 0x78)))]
    pages, path = spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "ends")
    warc.write_archives(pages, path)
    index = warc.build_index(warc.captures(spark, path), Scratch(spark))
    keys = pages.select(warc.clean_uri("url").alias("uri")).select(warc.url_key("uri").alias("key"))
    read = warc.read_records(spark, path, warc.lookup(index, keys)).collect()
    assert sorted((r.page_id, r.uri) for r in read) == [(i, u) for i, u, _ in rows]


def test_one_key_reads_only_its_ranges(spark, tmp_path, monkeypatch):
    rows, path = material(), str(tmp_path / "archives")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), path)
    entries = warc.captures(spark, path)
    wanted = entries.where("key = 'org,example,hot,www)/x' or page in (7, 2004)").collect()
    assert "content" not in warc.archives(spark, path)[0].columns

    class Counting:
        def __init__(self, name):
            self.file, self.bytes = warc.open_archive(name), 0

        def seek(self, at):
            self.file.seek(at)

        def read(self, n):
            self.bytes += n
            return self.file.read(n)

    for name in {e.path for e in wanted}:
        ranges, source = sorted((e.offset, e.length) for e in wanted if e.path == name), Counting(name)
        records = list(warc.read_ranges(source, ranges))
        assert len(records) == len(ranges) and source.bytes == sum(n for _, n in ranges)
        assert all(r.startswith(b"WARC/1.1") for r in records)
    again = entries.where("page = 7").withColumn("other", warc.F.lit(1))
    none = again.withColumn("path", warc.F.lit(None).cast("string"))
    read = warc.read_records(spark, path, again.unionByName(again).unionByName(none)).collect()
    assert [r.page_id for r in read] == [7]


def test_archives_that_tasks_cannot_open(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://a.b/{i}", "x" * i * 10) for i in range(120)]
    path = str(tmp_path / "far")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    near = warc.captures(spark, path).cache()
    direct = sorted(warc.read_records(spark, path, near).collect())
    monkeypatch.setattr(warc, "OPENED", set())
    assert sorted(warc.captures(spark, path).collect()) == sorted(near.collect())
    assert sorted(warc.read_records(spark, path, near).collect()) == direct and len(direct) == 120


def test_an_archive_that_is_cut_off(tmp_path):
    whole = warc.gzip_members(warc.record("response", 1, "http://a.b/", "2024", b"x" * 5000, 5000, b"0" * 20, None))
    assert len(list(warc.members(io.BytesIO(whole * 3)))) == 3
    with pytest.raises(EOFError):
        list(warc.members(io.BytesIO(whole + whole[:-9])))
