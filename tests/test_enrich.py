import json
import re
import struct
from html import unescape

import duckdb
import pytest

from tests.test_state import NOW, by_id, table
from watchloom.functions import web
from watchloom.operators import enrich, failures, pages
from watchloom.operators.tables import written
from watchloom.plans import registry
from watchloom.sources import exports


def wav(samples=b"", rate=16000, channels=1, bits=16, kind=1, junk=b""):
    form = struct.pack("<HHIIHH", kind, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits)
    body = b"fmt " + struct.pack("<I", len(form)) + form + junk + b"data" + struct.pack("<I", len(samples)) + samples
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body


def test_wav_kinds():
    x, e = enrich.decode_wav(wav(struct.pack("<2h", -32768, 32767), junk=b"LIST" + struct.pack("<I", 3) + b"abc\0"))
    assert e is None and x.tolist() == [-1.0, 32767 / 32768]
    assert enrich.decode_wav(wav(struct.pack("<f", 1.5), bits=32, kind=3))[0].tolist() == [1.5]
    for data, kind in ((wav(b"ab", rate=8000), "sample_rate"), (wav(b"abcd", channels=2), "channels"), (wav(b"abc", bits=24), "sample_format"), (wav(), "empty"), (b"nope", "not_wav"), (b"RIFF\0\0\0\0WAVE", "not_wav")):
        assert enrich.decode_wav(data) == (None, kind)


def test_wav_files(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav(bytes(64000)))
    (tmp_path / "b.wav").write_bytes(b"broken")
    (tmp_path / "c.txt").write_bytes(b"")
    got = {r["path"][-5:]: r for r in enrich.wav_files(exports.wav_scan(spark, f"file://{tmp_path}"), samples=True).collect()}
    assert got["a.wav"]["duration_s"] == 2.0 and len(got["a.wav"]["samples"]) == 32000 and got["b.wav"]["error_kind"] == "not_wav" and len(got) == 2


def maker(results):
    def make():
        def run(claim):
            r = results[claim["video_id"]]
            if r == "raise":
                raise RuntimeError("defect")
            return {"stage": "fetch", "result": r, "message": "m", "text": "t", "language": "en", "duration_s": 1.0, "segments": [{"no_speech_prob": 0.5, "tokens": [{"id": 1, "text": "t", "p": 0.5, "plog": -0.5}]}], "model": "fake", "fetcher": "fake", "transcript_source": "asr"}

        return run

    return make


def test_run_routes_each_item_and_writes_before_it_marks(spark, tmp_path):
    v = table(spark, *[{"video_id": k, "first_seen_at": i} for i, k in enumerate("abcde")], {"video_id": "s", "status": "in_progress", "claimed_by": "old", "claimed_at": 1, "first_seen_at": -1})
    keep = lambda d, n=iter(range(99)): (d.write.parquet(p := f"file://{tmp_path}/{next(n)}"), spark.read.schema(d.schema).parquet(p))[1]
    out = f"file://{tmp_path}/artifacts"
    run = enrich.process_run(v, maker({"s": "ok", "a": "ok", "b": "error", "c": "unavailable", "d": "cancelled"}), as_of=NOW, workers=["w"], cap=5, write=lambda a: exports.write_transcripts(a, out), keep=keep)
    assert {k: r["status"] for k, r in by_id(run.videos).items()} == {"s": "succeeded", "a": "succeeded", "b": "failed_retryable", "c": "failed_terminal", "d": "in_progress", "e": "pending"}
    assert by_id(run.videos)["b"]["last_retryable_kind"] == "Fetch" and run.stats.first()["claimed"] == 4
    assert sorted(r["video_id"] for r in spark.read.parquet(out).collect()) == ["a", "s"]
    assert {(r["event_type"], r["video_id"]) for r in run.events.collect()} == {("claimed", k) for k in "sabcd"} | {("succeeded", "s"), ("succeeded", "a"), ("failed_retryable", "b"), ("failed_terminal", "c")}
    with pytest.raises(RuntimeError):
        enrich.process_run(v, maker(dict.fromkeys("sabcde", "raise")), as_of=NOW, workers=["w"], cap=2)


def test_late_success_changes_nothing(spark):
    v = table(spark, {"video_id": "a", "status": "pending"})
    done = spark.createDataFrame([("a", "w", "fetch", "ok", "m", "en", 1.0, "f", "asr")], "video_id string, worker_id string, stage string, result string, message string, language string, duration_s double, fetcher string, transcript_source string")
    new, events, outcomes = enrich.apply_outcomes(v, done, NOW)
    assert outcomes.first()["outcome"] == "stale_after_success" and new.first()["status"] == "pending" and events.count() == 0


FAILURES = [
    ("yt-dlp", 1, False, "ERROR: Video unavailable", "terminal", "Deleted"), ("yt-dlp", 1, False, "Private video", "terminal", "Private"), ("yt-dlp", 1, False, "HTTP Error 429: x", "retryable", "RateLimited"), ("yt-dlp", 1, False, "HTTP Error 502", "retryable", "TransientNetwork"),
    ("yt-dlp", 1, False, "not available in your country", "terminal", "RegionBlocked"), ("yt-dlp", 1, False, "odd", "retryable", "YtDlpUnknown"), ("yt-dlp", 0, False, None, "retryable", "NoMediaProduced"), ("yt-dlp", 137, False, "x", "retryable", "ToolCrashedUnknown"),
    ("yt-dlp", 1, True, "Video unavailable", "retryable", "ToolTimeout"), ("yt-dlp", 1, False, "status code 10231", "terminal", "Deleted"), ("yt-dlp", 1, False, "Your IP address is blocked", "ambiguous", "IpBlocked"), ("ffmpeg", 1, False, "moov atom not found", "retryable", "BadAudio"),
    ("whisper.cpp", 0, False, "", "retryable", "EmptyTranscript"), ("whisper.cpp", 1, False, "cudaMalloc failed", "retryable", "OOM"), ("whisper.cpp", 2, False, "failed to load model", "bug", "Config"), ("other", None, False, None, "retryable", "Unknown"),
]


@pytest.mark.parametrize("table_of_rules", [False, True])
def test_failures_by_rules(spark, table_of_rules):
    d = spark.createDataFrame([(i, *x[:4]) for i, x in enumerate(FAILURES)], "i int, tool string, exit_code int, timed_out boolean, message string")
    got = failures.classify(d, "i", failures.rules(spark) if table_of_rules else None).orderBy("i").collect()
    assert [(r["class"], r["kind"]) for r in got] == [x[4:] for x in FAILURES]


@pytest.mark.parametrize("table_of_rules", [False, True])
def test_defects_of_ours(spark, table_of_rules):
    rows = [("yt-dlp", 0, "", True, False), ("yt-dlp", 0, "", False, False), ("yt-dlp", 0, "", None, None), ("ffmpeg", 1, "No such file or directory", False, True), ("ffmpeg", 1, "No such file or directory", False, False)]
    d = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "i int, tool string, exit_code int, message string, dir_broken boolean, just_written boolean").selectExpr("*", "false as timed_out")
    got = failures.classify(d, "i", failures.rules(spark) if table_of_rules else None).orderBy("i").collect()
    assert [r["class"] for r in got] == ["bug", "retryable", "retryable", "bug", "retryable"]


def test_a_long_table_of_rules_is_whole_or_refused(spark, monkeypatch):
    d = spark.createDataFrame([(1, "t", 1, False, "needle")], "i int, tool string, exit_code int, timed_out boolean, message string")
    many = spark.range(2000).selectExpr("cast(id as int) as priority", "'*' as rule_tool", "'*' as rule_exit", "if(id = 1999, 'needle', concat('x', id)) as pattern", "'c' as class", "cast(id as string) as kind", "'' as flag")
    assert failures.classify(d, "i", many).first()["kind"] == "1999"
    monkeypatch.setattr(failures, "MOST_RULES", 1999)
    with pytest.raises(ValueError):
        failures.classify(d, "i", many)


def test_serial_kind(spark):
    d = spark.createDataFrame([("fetch", "error")], "stage string, result string")
    assert failures.routed(d, serial=True).first()["kind"] == "FetchOrTranscribe" and failures.routed(d).first()["kind"] == "Fetch"


HTML = '<html><head><title>T</title></head><body><nav>menu</nav><div class="markdown  x"><h2>Head &amp; tail</h2><p>One <b>two</b>\n three<br>four</p><pre><code>a  b\n c</code></pre><ul><li>i</li></ul><a href="/x">link</a><script>var s;</script></div><main> </main></body></html>'


def test_page_contents(spark):
    p = spark.createDataFrame([(1, "http://h/a", HTML), (2, "http://h/b", "<body>only <i>body</i></body>"), (3, "http://h/c", None), (4, "http://h/d", "<main>m</main><article>a</article>")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in pages.contents(p).collect()}
    assert got[1]["main_html"].startswith("<h2>") and "menu" not in got[1]["text"] and got[1]["text"].endswith("linkvar s;")
    assert "## Head & tail" in got[1]["markdown"] and "**two** three" in got[1]["markdown"] and "```\na  b\n c\n```" in got[1]["markdown"] and "- i" in got[1]["markdown"] and "[link](/x)" in got[1]["markdown"] and "var s" not in got[1]["markdown"]
    assert got[2]["text"] == "only body" and got[3]["text"] == "" and got[4]["text"] == "m"
    r = {x["url"]: x for x in pages.records(p, "now").collect()}
    assert r["http://h/a"]["links"] == ["http://h/x"] and r["http://h/a"]["title"] == "T" and r["http://h/b"]["title"] == "http://h/b"


def test_records_of_pages_with_one_id(spark):
    """Two pages with one id are two records, each with its own content."""
    p = spark.createDataFrame([(1, "http://h/a", "<title>A</title><main>one</main>"), (1, "http://h/b", "<title>B</title><main>two</main>")], "page_id long, url string, html string")
    assert sorted((r["title"], r["text"]) for r in pages.records(p, "now").collect()) == [("A", "one"), ("B", "two")]


def test_links_and_titles_as_a_browser_reads_them(spark):
    html = """<TITLE> A &amp;
 B </TITLE><A HREF='x.html'>1</A><a href=y.html>2</a><a href="/p?a=1&amp;b=2">3</a><a href="../q">4</a><a href="x.html#f">5</a><!-- <a href="/no"> --><script>'<a href="/no">'</script><a name="n">6</a><a href="">7</a><a href="https://o.example/z">8</a><a href="mailto:m@h">9</a>"""
    p = spark.createDataFrame([(1, "https://h.example/doc/sub/page", html), (2, "u", "<title> </title>"), (3, "v", None)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in pages.outlinks(p).collect()}
    own = ["https://h.example/doc/q", "https://h.example/doc/sub/x.html", "https://h.example/doc/sub/y.html", "https://h.example/p?a=1&b=2"]
    assert got[1]["links"] == [*own, "https://o.example/z"] and got[1]["title"] == "A & B" and got[2]["title"] == "u" and got[3]["links"] == []
    kept = {r["page_id"]: r["links"] for r in pages.outlinks(p, origin="https://h.example", prefix="https://h.example/doc/").collect()}
    assert kept[1] == own[:3]
    assert web.resolved("../q", "https://h.example/doc/sub/page") == "https://h.example/doc/q"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<ol start=3><li>a</li><li>b<ul><li>c<li>d</ul></li></ol>", "3. a\n4. b\n   - c\n   - d"), ("<p>x</p><blockquote><p>q</p><p>r</p></blockquote>", "x\n\n> q\n> \n> r"), ('<img alt="A" src="/i.png"><img>', "![A](/i.png)"),
        ("<h2> T <em>e</em></h2>text<hr>more", "## T _e_\n\ntext\n\n* * *\n\nmore"), ("<pre><code>a  b\n c</code></pre>", "```\na  b\n c\n```"), ("<p>one<br>two <code>c</code> <a>no</a> <a href=u>l</a></p>", "one  \ntwo `c` no [l](u)"), ("<li>loose", "- loose"), ("<p>a<p>b", "a\n\nb"),
    ],
)
def test_markdown(html, want):
    assert pages.Markdown(html).text() == want


def plain_text(html):
    """Text of a page's main content, by regular expressions; enough for the test table's pages."""
    body = re.search(r"<article>(.*)</article>", html, re.S) or re.search(r"<body>(.*)</body>", html, re.S)
    return " ".join(unescape(re.sub(r"<[^>]*>", "", re.sub(r"<!--.*?-->", "", body[1], flags=re.S))).split())


def test_page_text_and_records_of_the_table_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["url"]: r["html"] for r in rows.collect()}
    for r in pages.records(rows, "now").collect():
        h = want[r["url"]]
        assert r["text"] == plain_text(h) and r["title"] == " ".join(unescape(re.search(r"<title>(.*?)</title>", h, re.S)[1]).split())
        assert re.sub(r"[*#_\s]|^- |\n- ", "", r["markdown"]) == re.sub(r"[*#_\s]", "", r["text"])


def test_records_as_files(spark, tmp_path):
    p = spark.createDataFrame([(1, "http://h/a", "<title>A</title><main>one</main>"), (2, "http://g/a", "<title>B</title><main>two</main>"), (3, "http://h/b", "<main>x<p>y</main>")], "page_id long, url string, html string")
    exports.write_page_records(pages.records(p, "now"), f"file://{tmp_path}", per_slug=True)
    assert spark.read.json(f"file://{tmp_path}/index").count() == 3
    one = spark.read.text(f"file://{tmp_path}/json_by_slug").collect()
    assert {r["slug"]: json.loads(r["value"])["title"] for r in one} == {"a": "A", "b": "http://h/b"}
    text = spark.read.text(f"file://{tmp_path}/markdown_by_slug", wholetext=True).collect()
    assert {r["slug"]: r["value"] for r in text} == {"a": "one\n", "b": "x\n\ny\n"}


def test_frontier_rounds_and_cap(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("d", "e"), ("c", "a"), ("x", "y")], "source string, target string")
    s = spark.createDataFrame([("a",)], "url string")
    full = {(r["url"], r["depth"]) for r in pages.frontier(e, s).collect()}
    assert full == {("a", 0), ("b", 1), ("c", 1), ("d", 2), ("e", 3)}
    assert {r["url"] for r in pages.frontier(e, s, cap=2).collect()} == {"a", "b"}
    assert {r["url"] for r in pages.frontier(e, s, rounds=1).collect()} == {"a", "b", "c"}
    assert [r["url"] for r in pages.first_seen(pages.frontier(e, s)).orderBy("nth").collect()] == ["a", "b", "c", "d", "e"]


def test_frontier_follows_links_until_no_page_is_new(spark):
    """A chain longer than ten links and more pages than PAGE_CAP, against a plain breadth-first search."""
    links = [(f"n{i}", f"n{i + 1}") for i in range(12)] + [("n12", f"w{i:04}") for i in range(1100)] + [("w0007", "last"), ("last", "n0"), ("other", "n3")]
    want, fresh, depth = {"n0": 0}, {"n0"}, 0
    while fresh:
        depth += 1
        fresh = {t for s, t in links if s in fresh} - want.keys()
        want |= dict.fromkeys(fresh, depth)
    e, s = spark.createDataFrame(links, "source string, target string"), spark.createDataFrame([("n0",)], "url string")
    got = {r["url"]: r["depth"] for r in pages.frontier(e, s, cap=None, keep=written).collect()}
    assert got == want and len(got) > pages.PAGE_CAP and got["last"] == 14
    assert pages.frontier(e, s, keep=written).count() == pages.PAGE_CAP


def test_pages_that_fail_are_visited_and_not_counted(spark):
    """Against the loop of a crawler: visits by depth and URL, failures seen but not saved, the cap over saved pages."""
    links = [("a", "b"), ("a", "x1"), ("a", "c"), ("b", "x2"), ("b", "d"), ("c", "e"), ("d", "a"), ("e", "f"), ("x1", "never"), ("f", "g")]
    stored = ["a", "b", "c", "d", "e", "f", "g"]
    e, s, p = spark.createDataFrame(links, "source string, target string"), spark.createDataFrame([("a",), ("x0",)], "url string"), spark.createDataFrame([(u,) for u in [*stored, "a"]], "url string")

    def brute(cap):
        fresh, seen, kept, depth = ["a", "x0"], {}, 0, 0
        while fresh:
            after = set()
            for u in sorted(fresh):
                if kept == cap:
                    return seen
                seen[u] = (depth, u in stored)
                kept += u in stored
                after |= {t for f, t in links if f == u and u in stored}
            fresh, depth = [t for t in after if t not in seen], depth + 1
        return seen

    for cap in (0, 1, 2, 3, 5, None):
        assert {r["url"]: (r["depth"], r["saved"]) for r in pages.crawl(e, p, s, cap=cap).collect()} == brute(cap)
    assert {r["url"] for r in pages.crawl(e, p, s, rounds=1).collect()} == {"a", "x0", "b", "c", "x1"}
    assert pages.crawl(e, p, s.where("false")).count() == 0
    order = [r["url"] for r in pages.first_seen(pages.crawl(e, p, s)).orderBy("nth").collect()]
    assert order == sorted(brute(None), key=lambda u: (brute(None)[u][0], u))


@pytest.mark.parametrize("html, browser, ended", [("<title>A &amp; B &amp</title>", "A & B &", "A & B &amp"), ("x\r\x0c\u2028\n<title>a\n &lt;&eacute;&#x27;&quot</title>", "a <\u00e9'\"", "a <\u00e9'&quot"), ("<title>1 < 2 &gt</title>", "1 < 2 >", "1 < 2 &gt"), ("<title>&amp;lt; &lt", "&lt; <", "&lt; &lt"), ("<title></title>", "u", "u")])
def test_titles_with_references_without_a_semicolon(html, browser, ended):
    assert pages.read(html, "u")[0] == browser and pages.read(html, "u", ended=True)[0] == ended


def test_page_title_follows_its_sql_where_a_reference_is_cut(spark, tmp_path):
    rows = [(1, "http://h/a", "<html><title>und &amp;&amp; ver&amp</title></html>"), (2, "http://h/b", "<title>a &lt;b&gt</title>"), (3, "http://h/c", "<p>none")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(map(tuple, registry.QUERIES["page_title"](spark, str(tmp_path)).collect())) == sorted(db.sql(registry.ORACLE["page_title"]).fetchall())


def test_main_content_is_found_after_other_line_ends():
    assert pages.read("a\rb\x0cc\u2028d\n<p>x</p>\n<main>one</main>", "u")[2] == "one"


@pytest.mark.parametrize("run", [pages.contents, pages.outlinks, lambda p: pages.records(p, "now")])
def test_batches_of_pages_are_bounded_by_bytes(spark, run):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    run(spark.createDataFrame([], "page_id long, url string, html string"))
    assert 0 < int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20


def test_a_run_works_its_videos_out_once(spark):
    from watchloom.plans import feeds, registry

    n = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    v = feeds.videos(spark, "/root/testdata/sf0.001")
    run = enrich.process_run(v.mapInArrow(counted, v.schema), registry.fake_enricher, as_of=feeds.AS_OF, workers=["a"], cap=None)
    assert run.videos.count() == v.count() and run.outcomes.count() and n.value == v.count()
