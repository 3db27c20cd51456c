import pytest

from watchloom import schemas
from watchloom.operators import reports, state

NOW = 10_000


def table(spark, *rows):
    base = dict.fromkeys(f.name for f in schemas.schema(schemas.VIDEOS)) | {"canonical": True, "attempt_count": 0, "first_seen_at": 1, "updated_at": 1, "source_url": "u", "status": "pending"}
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schemas.schema(schemas.VIDEOS))


def by_id(df):
    return {r["video_id"]: r for r in df.collect()}


def test_claims_take_the_oldest_once(spark):
    v = table(spark, {"video_id": "b", "first_seen_at": 1}, {"video_id": "a", "first_seen_at": 2}, {"video_id": "c", "first_seen_at": 2, "attempt_count": 3}, {"video_id": "d", "status": "failed_retryable", "first_seen_at": 0}, {"video_id": "e", "first_seen_at": 9})
    new, claims, events = state.claim_batch(v, 3, ["w1", "w2"], NOW)
    assert {(r["video_id"], r["worker_id"], r["attempt_count"]) for r in claims.collect()} == {("b", "w1", 1), ("a", "w2", 1), ("c", "w1", 4)}
    n = by_id(new)
    assert [n[k]["status"] for k in "abcde"] == ["in_progress", "in_progress", "in_progress", "failed_retryable", "pending"] and n["a"]["claimed_at"] == n["a"]["updated_at"] == NOW and n["e"]["updated_at"] == 1
    assert events.count() == 3 and {r["event_type"] for r in events.collect()} == {"claimed"}
    again, claims, _ = state.claim_batch(new, 5, ["w3"], NOW)
    assert [r["video_id"] for r in claims.collect()] == ["e"]
    assert state.claim_batch(again, 5, ["w3"], NOW)[1].count() == 0


def test_guards_and_first_passing_request(spark):
    v = table(spark, {"video_id": "a", "status": "in_progress", "claimed_by": "w1", "claimed_at": 5, "terminal_reason": "old"}, {"video_id": "b", "status": "pending"}, {"video_id": "c", "status": "in_progress", "claimed_by": "w2", "claimed_at": 5})
    r = spark.createDataFrame([("a", "w2", 1, "k1", "m1"), ("a", "w1", 2, "k2", "m2"), ("a", "w1", 3, "k3", "m3"), ("b", "w1", 1, "k", "m"), ("zz", "w1", 1, "k", "m")], "video_id string, worker_id string, ord int, kind string, message string")
    c = state.mark_retryable(v, r, NOW)
    assert {(x["video_id"], x["ord"]): x["changed"] for x in c.outcomes.collect()} == {("a", 1): 0, ("a", 2): 1, ("a", 3): 0, ("b", 1): 0, ("zz", 1): 0}
    a = by_id(c.videos)["a"]
    assert (a["status"], a["claimed_by"], a["claimed_at"], a["last_retryable_kind"], a["last_retryable_message"], a["terminal_reason"], a["updated_at"]) == ("failed_retryable", None, None, "k2", "m2", "old", NOW)
    assert [(e["video_id"], e["detail_json"]) for e in c.events.collect()] == [("a", '{"kind":"k2","message":"m2"}')]
    assert c.videos.schema == v.schema and c.videos.count() == 3
    t = state.mark_terminal(v, r, NOW)
    assert by_id(t.videos)["a"]["terminal_reason"] == "k2" and t.events.first()["detail_json"] == '{"reason":"k2","message":"m2"}'
    s = state.mark_succeeded(v, spark.createDataFrame([("c", "w2", 1, 2.5, "en", "f", "asr")], "video_id string, worker_id string, ord int, duration_s double, language string, fetcher string, transcript_source string"), NOW)
    row = by_id(s.videos)["c"]
    assert (row["status"], row["claimed_by"], row["claimed_at"], row["succeeded_at"], row["duration_s"]) == ("succeeded", "w2", 5, NOW, 2.5)
    assert reports.stale_outcomes(s.outcomes, c.outcomes).first().asDict() == {"stale_after_success": 0, "stale_after_failure": 4}


def test_sweep(spark):
    p = {"status": "in_progress", "claimed_by": "w", "attempt_count": 2}
    v = table(spark, {"video_id": "stale", "claimed_at": NOW - 101, **p}, {"video_id": "edge", "claimed_at": NOW - 100, **p}, {"video_id": "future", "claimed_at": NOW + 5, **p}, {"video_id": "none", **p}, {"video_id": "done", "status": "succeeded", "claimed_at": 1})
    new, events = state.sweep_stale(v, NOW, 100)
    assert {k: r["status"] for k, r in by_id(new).items()} == {"stale": "pending", "edge": "in_progress", "future": "in_progress", "none": "in_progress", "done": "succeeded"}
    assert by_id(new)["stale"]["attempt_count"] == 2 and events.count() == 0 and state.sweep_stale(new, NOW, 100)[0].where("status = 'pending'").count() == 1
    assert state.sweep_stale(v, NOW, 100, with_events=True)[1].first()["event_type"] == "released_stale"
    same = table(spark, {"video_id": "x", "claimed_at": NOW, **p})
    assert state.sweep_stale(same, NOW, 0)[0].first()["status"] == "in_progress"
    assert [r[0] for r in state.reset_stale(v, NOW, 100, dry_run=True).collect()] == ["stale"]


def test_requeue(spark):
    f = {"status": "failed_retryable", "last_retryable_kind": "Fetch"}
    v = table(spark, {"video_id": "a", **f, "updated_at": 10}, {"video_id": "b", **f, "updated_at": 20}, {"video_id": "c", **f, "updated_at": 9000}, {"video_id": "d", **f, "attempt_count": 9, "updated_at": 1}, {"video_id": "e", "status": "failed_retryable", "last_retryable_kind": "Other"})
    how = {"older_than": 5000, "kinds": ["Fetch"], "max_attempts": 5, "most": 1}
    assert [r[0] for r in state.requeue(v, NOW, dry_run=True, **how).collect()] == ["a"]
    n = by_id(state.requeue(v, NOW, **how))
    assert n["a"]["status"] == "pending" and n["a"]["last_retryable_kind"] == "Fetch" and n["b"]["status"] == "failed_retryable"


def test_log_reports_and_contract(spark):
    v = table(spark, {"video_id": "a", "status": "succeeded"}, {"video_id": "b", "status": "failed_terminal", "terminal_reason": "r"}, {"video_id": "c"})
    _, _, e = state.claim_batch(v, 1, ["w"], NOW)
    log = state.append_events(state.append_events(schemas.empty(spark, "video_events"), e), e)
    assert [r["id"] for r in state.history(log, "c").collect()] == [1, 2]
    assert reports.process_stats(v).first().asDict() == {"succeeded": 1, "failed_retryable": 0, "failed_terminal": 1, "claimed": 2}
    assert reports.error_list(v).first()["kind"] == "r" and schemas.status_violations(v).count() == 0
    art = lambda *rows: spark.createDataFrame(rows, "video_id string, kind string, schema_version string")
    full = art(("a", "text", None), ("a", "json", "1"))
    assert not reports.done_contract(v, full).first()["done"]
    assert reports.done_contract(v.where("video_id <> 'c'"), full).first()["done"]
    assert reports.done_contract(v.where("video_id <> 'c'"), art(("a", "text", None), ("a", "json", "2"))).first()["other_version"] == 1
    assert reports.done_contract(v.where("video_id = 'a'"), art(("a", "json", "1"))).first()["missing_text"] == 1


def test_shards_are_even(spark):
    ids = spark.range(10_000).selectExpr("cast(7000000000000000000 + id * 37 as string) as video_id")
    assert reports.shard_counts(ids).where("not even").count() == 0


@pytest.mark.parametrize("parts", [1, 8])
def test_results_do_not_hang_on_partitions(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = [{"video_id": f"v{i}", "first_seen_at": i % 7} for i in range(50)]
        claims = state.claim_batch(table(spark, *rows).repartition(parts), 10, ["a", "b"], NOW)[1]
        want = sorted(rows, key=lambda r: (r["first_seen_at"], r["video_id"]))[:10]
        assert {(r["video_id"], r["worker_id"]) for r in claims.collect()} == {(r["video_id"], "ab"[i % 2]) for i, r in enumerate(want)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_numbers_and_claims_without_a_cap(spark):
    from watchloom.operators.tables import numbered

    d = spark.range(1000).selectExpr("id * 7919 % 1009 as k").repartition(5)
    got = [(r["n"], r["k"]) for r in numbered(d, "k", name="n", start=3).orderBy("n").collect()]
    assert got == [(i + 3, k) for i, k in enumerate(sorted(i * 7919 % 1009 for i in range(1000)))]
    assert numbered(d.where("false"), "k").count() == 0
    rows = [{"video_id": f"v{i:02}", "first_seen_at": i % 7} for i in range(40)] + [{"video_id": "x", "status": "succeeded"}]
    new, claims, _ = state.claim_batch(table(spark, *rows), None, ["a", "b", "c"], NOW)
    want = sorted(rows[:40], key=lambda r: (r["first_seen_at"], r["video_id"]))
    assert {(r["video_id"], r["worker_id"]) for r in claims.collect()} == {(r["video_id"], "abc"[i % 3]) for i, r in enumerate(want)} and new.where("status = 'pending'").count() == 0
