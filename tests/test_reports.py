import pytest

from watchloom.operators import reports
from watchloom.plans import registry

SF = "/root/testdata/sf0.001"


def test_manifest_has_every_watch_row(spark):
    got = registry.QUERIES["manifest_all"](spark, SF)
    assert got.count() == registry.watch_rows(spark, SF).count() > registry.QUERIES["manifest"](spark, SF).count()
    assert got.where("cast(substr(respondent_id, 2) as long) % 2 = 1").limit(1).count() == 1


@pytest.mark.parametrize("some, want", [(None, {("u1", "1"), ("u1", "2"), ("u2", "1"), ("u3", "2")}), ([" u1 ", "u1", "u3", "", None, "u9"], {("u1", "1"), ("u1", "2"), ("u3", "2")}), ([], set())])
def test_manifest_takes_a_list_of_respondents(spark, some, want):
    watch = spark.createDataFrame([("u1", "1", 10, True), ("u1", "2", 20, True), ("u2", "1", 30, False), ("u3", "2", 40, True)], "respondent_id string, video_id string, watched_at long, in_window boolean")
    state = "duration_s double, language_detected string, fetcher string, transcript_source string, last_retryable_kind string, terminal_reason string, attempt_count int"
    videos = spark.createDataFrame([("1", "succeeded", *[None] * 6, 1), ("2", "pending", *[None] * 6, 0)], f"video_id string, status string, {state}")
    kinds = spark.createDataFrame([("1", "metadata")], "video_id string, kind string")
    listed = None if some is None else spark.createDataFrame([(r,) for r in some], "respondent_id string")
    got = reports.manifest(watch, videos, kinds, listed).collect()
    assert {(r["respondent_id"], r["video_id"]) for r in got} == want and len(got) == len(want)
    assert all(r["has_transcript"] == r["has_metadata"] == (r["video_id"] == "1") for r in got)
