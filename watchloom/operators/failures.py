"""Failures: classification by ordered rules, the mapping of tool errors, and routing of item outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values: (priority, tool, exit, pattern, class, kind, flag). exit: 0, 1, 'other' or '*'; flag: a column that must be true, if
#: any (dir_broken: the tool's folder is gone or can't be written; just_written: the missing file is one we wrote). The first rule that fits decides.
RULES = [
    (1, "*", "*", r"status code 10231", "terminal", "Deleted", ""),
    (2, "*", "*", r"IP address is blocked", "ambiguous", "IpBlocked", ""),
    (10, "yt-dlp", "1", r"Video unavailable|Video has been removed", "terminal", "Deleted", ""),
    (11, "yt-dlp", "1", r"not available in your country|geo", "terminal", "RegionBlocked", ""),
    (12, "yt-dlp", "1", r"not available", "terminal", "Deleted", ""),
    (13, "yt-dlp", "1", r"Private video|private", "terminal", "Private", ""),
    (14, "yt-dlp", "1", r"Login required|requires login", "terminal", "LoginRequired", ""),
    (15, "yt-dlp", "1", r"age restricted|age-restricted", "terminal", "AgeRestricted", ""),
    (16, "yt-dlp", "1", r"HTTP Error 429|rate limit", "retryable", "RateLimited", ""),
    (17, "yt-dlp", "1", r"HTTP Error 5[0-9][0-9]|temporarily unavailable|connection reset|timed out", "retryable", "TransientNetwork", ""),
    (18, "yt-dlp", "1", r"", "retryable", "YtDlpUnknown", ""),
    (19, "yt-dlp", "0", r"", "bug", "TmpDirBroken", "dir_broken"),
    (20, "yt-dlp", "0", r"", "retryable", "NoMediaProduced", ""),
    (21, "yt-dlp", "other", r"", "retryable", "ToolCrashedUnknown", ""),
    (30, "ffmpeg", "*", r"Invalid data found|moov atom not found|truncated", "retryable", "BadAudio", ""),
    (31, "ffmpeg", "*", r"No such file or directory", "bug", "MissingOwnFile", "just_written"),
    (32, "ffmpeg", "*", r"No such file or directory", "retryable", "BadAudio", ""),
    (40, "whisper.cpp", "0", r"", "retryable", "EmptyTranscript", ""),
    (41, "whisper.cpp", "*", r"out of memory|cudaMalloc", "retryable", "OOM", ""),
    (42, "whisper.cpp", "*", r"failed to load model", "bug", "Config", ""),
    (43, "whisper.cpp", "*", r"", "retryable", "WhisperUnknown", ""),
    (99, "*", "*", r"", "retryable", "Unknown", ""),
]
TIMEOUT = ("retryable", "ToolTimeout")
FLAGS = ("dir_broken", "just_written")
#: Rows of a table of rules at most; it is broadcast.
MOST_RULES = 10_000


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "priority int, rule_tool string, rule_exit string, pattern string, class string, kind string, flag string")


def classify(failures: DataFrame, key: str, rules_: DataFrame | None = None) -> DataFrame:
    """failures (key, tool, exit_code, timed_out, message, and FLAGS where they are known) with class and kind.

    The default rules become one expression; other rules are a table of MOST_RULES rows at most (more are refused) that is joined and of which the first that fits is taken.
    """
    flags = {f: F.coalesce(F.col(f), F.lit(False)) if f in failures.columns else F.lit(False) for f in FLAGS}
    if rules_ is None:
        out: Column = F.lit(None)
        tool, code, text = F.col("tool"), F.col("exit_code"), F.coalesce("message", F.lit(""))
        for _, rule_tool, rule_exit, pattern, kind_class, kind, flag in reversed(RULES):
            fits = F.regexp_like(text, F.lit(pattern)) if pattern else F.lit(True)
            if flag:
                fits = fits & flags[flag]
            if rule_tool != "*":
                fits = fits & (tool == rule_tool)
            if rule_exit != "*":
                fits = fits & (F.coalesce(~code.isin(0, 1), F.lit(True)) if rule_exit == "other" else code.eqNullSafe(F.lit(int(rule_exit))))
            out = F.when(fits, F.struct(F.lit(kind_class).alias("class"), F.lit(kind).alias("kind"))).otherwise(out)
        late = F.struct(F.lit(TIMEOUT[0]).alias("class"), F.lit(TIMEOUT[1]).alias("kind"))
        return failures.withColumn("_r", F.when(F.col("timed_out"), late).otherwise(out)).select("*", "_r.class", "_r.kind").drop("_r")
    if (n := rules_.count()) > MOST_RULES:
        raise ValueError(f"{n} rules; a table of rules has {MOST_RULES} at most")
    r = F.broadcast(rules_)
    code = F.when(F.col("exit_code").isin(0, 1), F.col("exit_code").cast("string")).otherwise("other")
    fits = ((F.col("rule_tool") == "*") | (F.col("rule_tool") == F.col("tool"))) & ((F.col("rule_exit") == "*") | (F.col("rule_exit") == code)) & F.regexp_like(F.coalesce("message", F.lit("")), F.col("pattern"))
    for f in FLAGS:
        fits = fits & ((F.col("flag") != f) | flags[f])
    best = failures.join(r, fits, "left").groupBy(key).agg(F.min_by(F.struct("class", "kind"), "priority").alias("_r"))
    late = F.struct(F.lit(TIMEOUT[0]).alias("class"), F.lit(TIMEOUT[1]).alias("kind"))
    return failures.join(best, key, "left").withColumn("_r", F.when(F.col("timed_out"), late).otherwise(F.col("_r"))).select("*", "_r.class", "_r.kind").drop("_r")


def error_map(runs: DataFrame) -> DataFrame:
    """runs (exit_code, timed_out, spawn_failed, output_exists) with error: what a tool's run means for the fetch, null if all is well."""
    e = F.when(F.col("timed_out"), "timeout").when(F.col("spawn_failed"), "spawn").when(F.col("exit_code").isNull(), "io").when(F.col("exit_code") != 0, "tool_failed").when(~F.col("output_exists"), "no_output")
    return runs.withColumn("error", e)


def routed(items: DataFrame, *, serial: bool = False) -> DataFrame:
    """items (stage, result) with route and kind.

    result: ok, error, cancelled, bug, unavailable (final, no transcript to come) or ready (a transcript came with the fetch).
    """
    failed = F.lit("FetchOrTranscribe") if serial else F.initcap("stage")
    route = (
        F.when(F.col("result").isin("ok", "ready"), "succeeded")
        .when(F.col("result") == "error", "failed_retryable")
        .when(F.col("result") == "unavailable", "failed_terminal")
        .when(F.col("result") == "cancelled", "in_progress")
        .when(F.col("result") == "bug", "abort")
    )
    return items.withColumn("route", route).withColumn("kind", F.when(F.col("result") == "error", failed))


def raise_on_bugs(routed_items: DataFrame) -> None:
    """Stop the run if any item met a defect of ours."""
    n = routed_items.where("route = 'abort'").limit(1).count()
    if n:
        raise RuntimeError("an item failed through a defect; see the rows routed to abort")
