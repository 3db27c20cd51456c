import json

import pytest

from watchloom import schemas
from watchloom.operators import commits, ingest
from watchloom.sources import exports
from watchloom.streaming import inbox

A, B = "7234567890123456789", "7000000000000000001"
LINK = "https://www.tiktok.com/@c/video/{}"


def entry(date, link):
    return {"Date": date, "Link": link}


@pytest.fixture
def donated(tmp_path):
    box = tmp_path / "inbox"
    (box / "deep").mkdir(parents=True)
    good = [{"other": 1}, {"tiktok_watch_history": [entry("2026-04-15 09:12:30", LINK.format(A)), entry("2026-04-15 09:12:30 UTC", LINK.format(A) + "?x"), entry("2026-04-16 10:00:00", LINK.format(B)), entry("bad", LINK.format(B)), entry("bad", "https://vm.tiktok.com/ZM1/"), entry("2026-04-16 10:00:00", "https://vm.tiktok.com/ZM1/"), entry("2026-04-16 10:00:00", "nope")]}, {"tiktok_watch_history": None}]
    (box / "assignment=1_participant=p1_source=t.json").write_text(json.dumps(good))
    (box / "deep" / "participant=p2_key=2.json").write_text(json.dumps([{"tiktok_watch_history": [entry("2026-04-17 00:00:00", LINK.format(A))]}], indent=2))
    (box / "participant=p3.json").write_text("{not json")
    (box / "participant=p4.json").write_text(json.dumps([{"tiktok_watch_history": [{"Date": "2026-04-17 00:00:00"}]}]))
    (box / "nobody.json").write_text("[]")
    (box / "participant=p5.JSON").write_text(json.dumps(good))
    return f"file://{box}"


def tables(spark):
    return schemas.empty(spark, "videos"), schemas.empty(spark, "watch_history")


def test_files_to_tables(spark, donated):
    rows, bad = exports.entries(exports.export_files(spark, donated))
    assert {(r["file_path"].rsplit("/", 1)[-1], r["error"]) for r in bad.collect()} == {("participant=p3.json", "not_json"), ("participant=p4.json", "missing_field"), ("nobody.json", "no_participant")}
    got = ingest.ingest(rows, *tables(spark), as_of=100)
    assert got.stats.first().asDict() == {"files_processed": 2, "unique_videos_seen": 2, "watch_history_rows_processed": 4, "watch_history_duplicates": 1, "short_links_skipped": 2, "invalid_urls_skipped": 1, "date_parse_failures": 1}
    v = {r["video_id"]: r for r in got.videos.collect()}
    assert v[A]["source_url"] == LINK.format(A) and v[A]["status"] == "pending" and v[A]["canonical"] and v[A]["first_seen_at"] == 100
    assert got.watch_history.count() == 3 and ingest.orphans(got.watch_history, got.videos).count() == 0
    again = ingest.ingest(rows, got.videos, got.watch_history, as_of=200)
    s = again.stats.first()
    assert s["watch_history_duplicates"] == s["watch_history_rows_processed"] and again.new_videos.count() == 0
    assert {r["updated_at"] for r in again.videos.collect()} == {100}
    with pytest.raises(ValueError):
        exports.entries(exports.export_files(spark, donated), strict=True)


def test_missing_inbox_is_empty(spark, tmp_path):
    rows, bad = exports.entries(exports.export_files(spark, f"file://{tmp_path}/none"))
    assert rows.count() == bad.count() == 0


def test_stream_equals_batch_and_repeats_add_nothing(spark, donated, tmp_path):
    where = (donated, f"file://{tmp_path}/t", f"file://{tmp_path}/c")
    inbox.ingest_stream(spark, *where, as_of=100, files_per_trigger=1).awaitTermination()
    batch = ingest.ingest(exports.entries(exports.export_files(spark, donated))[0], *tables(spark), as_of=100)
    for name in ("videos", "watch_history"):
        t = commits.snapshot(spark, where[1]).read(name)
        keys = ["video_id"] if name == "videos" else ["respondent_id", "video_id", "watched_at"]
        assert sorted(map(tuple, t.select(*keys).collect())) == sorted(map(tuple, getattr(batch, name).select(*keys).collect()))
    (tmp_path / "inbox" / "participant=p9.json").write_text(json.dumps([{"tiktok_watch_history": [entry("2026-04-17 00:00:00", LINK.format(A))]}]))
    inbox.ingest_stream(spark, *where, as_of=200).awaitTermination()
    assert commits.snapshot(spark, where[1]).read("watch_history").count() == batch.watch_history.count() + 1
    assert commits.snapshot(spark, where[1]).read("videos").count() == batch.videos.count()


def test_window_and_short_links(spark, donated):
    rows, _ = exports.entries(exports.export_files(spark, donated))
    got = ingest.ingest(rows, *tables(spark), as_of=1, window=("2026-04-16", "2026-04-16"))
    assert {(r["respondent_id"], r["in_window"]) for r in got.watch_history.collect()} == {("p1", True), ("p1", False), ("p2", False)}
    assert ingest.recompute_window(got.watch_history, end="2026-04-15").where("changed").count() == 2
    assert ingest.recompute_window(got.watch_history, clear=True).where("in_window").count() == 3
    with pytest.raises(ValueError):
        ingest.recompute_window(got.watch_history)
    p = ingest.pending_links(rows)
    assert p.count() == 1 and ingest.pending_links(rows, p).count() == 0
    r = spark.createDataFrame([("https://vm.tiktok.com/ZM1/", LINK.format(A), None)], "url string, target string, error string")
    done, left = ingest.promote_links(p, r)
    assert done.first()["video_id"] == A and left.count() == 0
    done, left = ingest.promote_links(p, r.selectExpr("url", "'https://x/' as target", "error"))
    assert done.count() == 0 and left.first()["last_error"] == "target is not a video link"
    assert ingest.promote_links(p, r.where("false"))[1].first()["last_error"] is None


def test_tables_and_versions(spark, tmp_path):
    root = f"file://{tmp_path}/tables"
    exports.init_tables(spark, root)
    exports.init_tables(spark, root)
    meta = exports.read_table(spark, f"{root}/meta", "meta")
    schemas.require_version(meta)
    assert exports.read_table(spark, f"{root}/videos", "videos").count() == 0 and exports.read_table(spark, f"{root}/none", "videos").count() == 0
    old = schemas.empty(spark, "videos").drop(*schemas.ADDED_IN_2)
    new, up = schemas.upgrade(old, schemas.empty(spark, "meta"))
    assert new.schema == schemas.schema(schemas.VIDEOS) and schemas.meta_value(up, "schema_version").first()[0] == "2"
    assert schemas.upgrade(new, up)[0] is new
    for bad in ("3", "x"):
        m = spark.createDataFrame([("schema_version", bad)], schemas.schema(schemas.META))
        with pytest.raises(ValueError):
            schemas.upgrade(new, m)
        with pytest.raises(ValueError):
            schemas.require_version(m)
    with pytest.raises(ValueError):
        schemas.require_version(schemas.empty(spark, "meta"))
    with pytest.raises(ValueError):
        schemas.require_keys(spark.createDataFrame([(None, 1)], "a int, b int"), "a", "b")


def test_sharded_writes_replace_only_their_shards(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    row = lambda *ids: spark.createDataFrame([(i, f"t{i}") for i in ids], "video_id string, text string")
    exports.write_transcripts(row("101", "202"), path)
    exports.write_transcripts(row("301"), path)
    assert {tuple(r) for r in spark.read.parquet(path).select("video_id", "text").collect()} == {("202", "t202"), ("301", "t301")}


def many_files(folder, n):
    for k in range(n):
        at = folder / f"participant=p{k}"
        at.mkdir(parents=True)
        (at / "part-0.json").write_text(json.dumps([{"tiktok_watch_history": [{"Date": "2024-01-01 00:00:00", "Link": f"https://www.tiktok.com/@u/video/{7 * 10**18 + k}"}]}]))


def test_many_small_files_are_read_in_few_tasks(spark, tmp_path):
    many_files(tmp_path / "box", 300)
    files = exports.export_files(spark, f"file://{tmp_path}/box")
    assert files.rdd.getNumPartitions() <= 4 and files.count() == 300


def test_folders_of_many_batches_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "MOST_FOLDERS", 2)
    many_files(tmp_path / "box", 5)
    root = f"file://{tmp_path}/tables"
    inbox.ingest_stream(spark, f"file://{tmp_path}/box", root, f"file://{tmp_path}/progress", as_of=1, files_per_trigger=1, level=-2, buckets=1).awaitTermination()
    got = commits.snapshot(spark, root)
    assert got.read("batches").count() == 5 and all(len(got.tables[t]["0"]) <= 2 and got.read(t).count() == 5 for t in ("videos", "watch_history"))
