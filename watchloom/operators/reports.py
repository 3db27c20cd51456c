"""Counts, totals, lists, the manifest and the checks of a finished batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def status_counts(videos: DataFrame) -> DataFrame:
    return videos.groupBy("status").agg(F.count("*").alias("n"))


def process_stats(videos: DataFrame) -> DataFrame:
    """Totals of the whole table: claimed is what has finished one way or another."""
    of = lambda s: F.count_if(F.col("status") == s)
    t = videos.agg(of("succeeded").alias("succeeded"), of("failed_retryable").alias("failed_retryable"), of("failed_terminal").alias("failed_terminal"))
    return t.withColumn("claimed", F.col("succeeded") + F.col("failed_retryable") + F.col("failed_terminal"))


def run_outcomes(outcomes: DataFrame) -> DataFrame:
    """How often each outcome came in a run."""
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


def stale_outcomes(succeeded: DataFrame, failed: DataFrame) -> DataFrame:
    """Requests that came too late, after success and after failure: outcomes of the two transitions."""
    s = succeeded.agg(F.count_if(F.col("changed") == 0).alias("stale_after_success"))
    f = failed.agg(F.count_if(F.col("changed") == 0).alias("stale_after_failure"))
    return s.crossJoin(f)  # two single rows


def shard_counts(ids: DataFrame) -> DataFrame:
    """Ids a shard, and whether that is within half of the mean."""
    from watchloom.functions.links import shard

    counted = ids.groupBy(shard(F.col("video_id")).alias("shard")).agg(F.count("*").alias("n"))
    mean = counted.agg(F.avg("n").alias("mean"))
    return counted.crossJoin(mean).select("shard", "n", F.col("n").between(F.col("mean") * 0.5, F.col("mean") * 1.5).alias("even"))  # one row of means


def status_report(videos: DataFrame, pending: DataFrame) -> DataFrame:
    return status_counts(videos).unionByName(pending.agg(F.lit("unresolved_short_links").alias("status"), F.count("*").alias("n")))


def respondent_summary(watch: DataFrame, videos: DataFrame, pending: DataFrame) -> DataFrame:
    """Seven counts a respondent."""
    w = watch.join(videos.select("video_id", "status"), "video_id", "left")
    of = lambda s: F.countDistinct(F.when(F.col("status") == s, F.col("video_id")))
    seen = w.groupBy("respondent_id").agg(
        F.countDistinct("video_id").alias("videos_seen"),
        F.countDistinct(F.when(F.col("in_window"), F.col("video_id"))).alias("videos_in_window"),
        of("succeeded").alias("videos_succeeded"),
        of("failed_terminal").alias("videos_failed_terminal"),
        of("failed_retryable").alias("videos_failed_retryable"),
        of("pending").alias("videos_pending"),
    )
    left = pending.groupBy("respondent_id").agg(F.count("*").alias("unresolved_short_links"))
    both = seen.join(left, "respondent_id", "full_outer")
    return both.select("respondent_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in both.columns if c != "respondent_id"])


def error_list(videos: DataFrame, kind: str = "failed_terminal") -> DataFrame:
    names = ("terminal_reason", "terminal_message") if kind == "failed_terminal" else ("last_retryable_kind", "last_retryable_message")
    return videos.where(F.col("status") == kind).select("video_id", F.col(names[0]).alias("kind"), F.col(names[1]).alias("message"), "attempt_count")


def respondents(spark: SparkSession, path: str) -> DataFrame:
    """respondent_id, once each, of a CSV file with a header that has such a column, whatever else it has; blanks around an id don't count."""
    rows = spark.read.option("header", True).csv(path)
    if "respondent_id" not in rows.columns:
        raise ValueError(f"{path} has no column respondent_id")
    return rows.select(F.trim("respondent_id").alias("respondent_id")).where("respondent_id <> ''").distinct()


def manifest(watch: DataFrame, videos: DataFrame, artifacts: DataFrame, respondents: DataFrame | None = None) -> DataFrame:
    """One row a watch row with the video's state and which artifacts exist; artifacts: video_id, kind (metadata, comments)."""
    if respondents is not None:
        watch = watch.join(respondents.where("trim(respondent_id) <> ''").select(F.trim("respondent_id").alias("respondent_id")).distinct(), "respondent_id", "left_semi")
    has = artifacts.groupBy("video_id").agg(F.max(F.col("kind") == "metadata").alias("has_metadata"), F.max(F.col("kind") == "comments").alias("has_comments"))
    v = videos.select("video_id", "status", "duration_s", "language_detected", "fetcher", "transcript_source", "last_retryable_kind", "terminal_reason", F.col("attempt_count").cast("int").alias("attempt_count"))
    yes = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return watch.join(v, "video_id").join(has, "video_id", "left").select(
        "respondent_id", "video_id", F.timestamp_seconds("watched_at").alias("watched_at"), "in_window", "status", "duration_s", "language_detected", "fetcher", "transcript_source",
        (F.col("status") == "succeeded").alias("has_transcript"), yes("has_metadata"), yes("has_comments"), "last_retryable_kind", "terminal_reason", "attempt_count",
    )


def done_contract(videos: DataFrame, artifacts: DataFrame, version: str = "1") -> DataFrame:
    """Counts of what keeps a batch from being done: unfinished rows, successes without text or signals, other versions.

    artifacts: video_id, kind (text, json), schema_version.
    """
    won = videos.where("status = 'succeeded'").select("video_id")
    missing = lambda k: won.join(artifacts.where(F.col("kind") == k), "video_id", "left_anti").agg(F.count("*").alias(f"missing_{k}"))
    open_ = videos.agg(F.count_if(F.col("status").isin("pending", "in_progress")).alias("unfinished"))
    other = artifacts.where("kind = 'json'").agg(F.count_if(~F.col("schema_version").eqNullSafe(F.lit(version))).alias("other_version"))
    one = open_.crossJoin(missing("text")).crossJoin(missing("json")).crossJoin(other)  # four single rows
    return one.withColumn("done", (F.col("unfinished") + F.col("missing_text") + F.col("missing_json") + F.col("other_version")) == 0)


def metadata_union(*sources: DataFrame) -> DataFrame:
    """Rows of several metadata sources; what a source doesn't give is null."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def comment_bundles(comments: DataFrame, reported: DataFrame) -> DataFrame:
    """Fetched against reported comments of each video; comments: video_id, comment_id; reported: video_id, reported_total."""
    got = comments.groupBy("video_id").agg(F.countDistinct("comment_id").alias("fetched_count"))
    return reported.join(got, "video_id", "left").select("video_id", F.coalesce("fetched_count", F.lit(0)).alias("fetched_count"), "reported_total", (F.coalesce("fetched_count", F.lit(0)) >= F.col("reported_total")).alias("is_complete"))
