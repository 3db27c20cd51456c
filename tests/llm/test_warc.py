import gzip
import hashlib

import pytest

from watchloom.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "<p>é" + "x" * 1200, "y" * 1000
    rows = [(i, f"http://h/{i}", big) for i in range(40)] + [(100, "http://a/b c\r\nd", other), (101, None, other), (102, "u", "y" * 999), (103, "u", "y" * 999), (104, "u", None), (105, "u", ""), (None, "u", big), (106, "u", "WARC/1.1\r\n\r\n" + "z" * 1200), (101, None, other)]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, digest string, n int")


def brute(rows):
    last = {}
    for r in rows:
        body = (r["html"] or "").encode()
        if len(body) >= 1000 and r["page_id"] is not None:
            last[body] = max(last.get(body, r["page_id"]), r["page_id"])
    out = []
    for r in rows:
        body = (r["html"] or "").encode()
        to = last.get(body)
        again = to is not None and r["page_id"] != to
        out.append((r["page_id"], len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives(spark, pages, tmp_path, compression):
    path = f"file://{tmp_path}/w"
    warc.write(warc.resolve(pages), path, compression=compression)
    got = warc.lookup(warc.read(spark, path))
    assert sorted([tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()], key=str) == brute(pages.collect())
    stored = warc.read(spark, path).groupBy("record_type").sum("stored_bytes").collect()
    assert dict(map(tuple, stored))["revisit"] == 0


def test_empty(spark, pages, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write(warc.resolve(pages.where("false")), path)
    assert warc.lookup(warc.read(spark, path)).count() == 0


def read_all(slices):
    return [(head, b"".join(block)) for head, block in warc.parse(slices)]


@pytest.mark.parametrize("cut", [1, 7, 1000])
def test_parse_in_slices(cut):
    bodies = [b"", b"\r\n\r\n", b"WARC/1.1\r\n\r\n", bytes(range(256)) * 9]
    data = b"".join(b"WARC/1.1\r\nX: y\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(x), x) for x in bodies)
    assert [x for _, x in read_all(data[i : i + cut] for i in range(0, len(data), cut))] == bodies
    packed = gzip.compress(data[:100]) + gzip.compress(data[100:])
    assert b"".join(warc.unpacked(packed)) == data and b"".join(warc.unpacked(data)) == data
    with pytest.raises(ValueError):
        list(warc.unpacked(packed[:-20]))


def test_parse_rejects_what_is_cut_off():
    for data in (b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc", b"HTTP/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n", b"WARC/1.1\r\nContent-Length: 0\r\n\r\nxxxx", b"WARC/1.1\r\n"):
        with pytest.raises(ValueError):
            read_all([data])


def test_files_are_bounded_by_bytes(spark, tmp_path):
    """30 records of 5 MB and many small ones: no file holds more than the bound, a larger record has its own."""
    rows = spark.range(30).selectExpr("id as page_id", "concat('http://h/', id) as url", "concat(id, repeat('abcde', 1000000)) as html").unionByName(spark.range(100, 600).selectExpr("id as page_id", "'u' as url", "repeat(id, 400) as html")).coalesce(2)
    path = f"file://{tmp_path}/w"
    warc.write(warc.resolve(rows), path, compression="none", file_bytes=12_000_000)
    sizes = [f.stat().st_size for f in tmp_path.glob("w/*/part-*")]
    assert max(sizes) <= 12_000_000 and sum(sizes) > 150_000_000 and len(sizes) >= 15
    got = warc.lookup(warc.read(spark, path))
    assert got.count() == 530 and got.where("payload_digest is null").count() == 0
    warc.write(warc.resolve(rows.where("page_id < 5")), path + "2", file_bytes=1000)
    assert len(list(tmp_path.glob("w2/*/part-*"))) == 5


def test_urls_keep_their_characters_apart(spark):
    rows = spark.createDataFrame([(1, "a\tb\rc\nd e\x7f\x00é", "h"), (2, "http://x/?q=1", "h")], "page_id long, url string, html string")
    lines = [r["value"].split("\r\n") for r in warc.records(warc.resolve(rows)).collect()]
    assert {x for x in sum(lines, []) if x.startswith("WARC-Target-URI")} == {"WARC-Target-URI: a%09b%0Dc%0Ad%20e%7F%00é", "WARC-Target-URI: http://x/?q=1"}
