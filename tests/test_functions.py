import pytest
from pyspark.sql import functions as F

from watchloom.functions import links, web

ID = "7234567890123456789"
LINKS = [
    (f"https://www.tiktokv.com/share/video/{ID}/", "video"), (f"https://www.tiktok.com/@coolcreator/video/{ID}", "video"), (f"https://www.tiktokv.com/share/video/{ID}/?utm_source=share", "video"),
    (f"http://tiktok.com/share/video/{ID}?x", "video"), ("https://vm.tiktok.com/ZMabcdef/", "short"), ("https://vt.tiktok.com/ZSabcdef/", "short"), ("https://www.tiktok.com/t/ZTabcdef/", "short"),
    ("https://example.com/video/123", "invalid"), ("not a url at all", "invalid"), ("https://vm.tiktok.com/ZMabcdef/?k=1", "invalid"), (f"https://www.tiktok.com/@c/video/{ID[:-1]}", "invalid"),
    (f"https://www.tiktok.com/@c/video/{ID}0", "invalid"), (f"https://www.tiktok.com/@c/video/{ID}\n", "invalid"), (f"https://www.tiktok.com/@c/video/{ID}#frag", "invalid"),
    (f"https://m.tiktok.com/@c/video/{ID}", "invalid"), (f"https://www.tiktok.com/@/video/{ID}", "invalid"), ("https://vm.tiktok.com/ZM/\n", "invalid"), (None, "invalid"),
]


def values(spark, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string").orderBy("i").select(*columns).collect()]


def test_links(spark):
    got = values(spark, [u for u, _ in LINKS], links.link_class(F.col("x")), links.video_id(F.col("x")))
    assert got == [(c, ID if c == "video" else None) for _, c in LINKS]
    assert values(spark, ["https://vm.tiktok.com/ZMabcdef/?k=1"], links.link_class(F.col("x"), allow_query=True)) == [("short",)]


def test_dates(spark):
    got = values(spark, ["2026-04-15 09:12:30", "2026-04-15 09:12:30 UTC", "2026-04-15T09:12:30", "garbage", "", None, "2026-02-30 00:00:00"], links.watched_at(F.col("x")))
    assert got == [(1776244350,), (1776244350,), (None,), (None,), (None,), (None,), (None,)]


def test_respondents_and_shards(spark):
    names = ["/in/assignment=5_participant=abc_source=t_key=1.json", "participant=x.json", "a/nope.json", "a/participant=_x.json", "x_participant=p q.json"]
    assert [r[0] for r in values(spark, names, links.respondent_id(F.col("x")))] == ["abc", "x", None, None, "p q"]
    assert [r[0] for r in values(spark, ["1234", "7", "", "é1é"], links.shard(F.col("x")))] == ["34", "7", "", "1é"]
    assert values(spark, ["12345"], links.shard_path("t", F.col("x"), ".txt")) == [("t/45/12345.txt",)]


@pytest.mark.parametrize(
    ("href", "want"),
    [
        ("https://d.example/a#x", "https://d.example/a"), ("/b?c=1&enter_method=z", "https://h.example/b?c=1"), ("/b?enter_method=z&c=1", "https://h.example/b?c=1"), ("c.html", "https://h.example/doc/c.html"),
        ("?q", "https://h.example/doc/page?q"), ("//o.example/x", "https://o.example/x"), ("mailto:a@b", None), ("javascript:void(0)", None), ("#top", "https://h.example/doc/page?a=1"),
        ("../q", "https://h.example/q"), ("./a/../b/", "https://h.example/doc/b/"), ("..", "https://h.example/"), ("HTTPS://H.example:443/a/./b/..", "https://h.example/a/"), (" x y ", "https://h.example/doc/x%20y"),
        ("https://h.example", "https://h.example/"), ("http://[bad", None), ("http://h.example:8080/../../z", "http://h.example:8080/z"),
    ],
)
def test_normalised_links(href, want):
    assert web.resolved(href, "https://h.example/doc/page?a=1#f") == want


def test_origin_and_prefix():
    assert web.within("https://h/a") and web.within("https://h/a", "https://h") and not web.within("https://h.evil/a", "https://h")
    assert web.within("https://h/doc/a", "https://h", "https://h/doc") and not web.within("https://h/x", "https://h", "https://h/doc")


def test_slugs(spark):
    assert [r[0] for r in values(spark, ["https://h/a/b c/", "https://h/", "https://h/x?q=1&r", "https://h"], web.slug(F.col("x")))] == ["a_b_c", "index", "x_q_1_r", "index"]
