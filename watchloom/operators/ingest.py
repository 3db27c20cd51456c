"""Watch entries to the videos and watch_history tables: classify, validate, keep the first of each key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchloom import schemas
from watchloom.functions import links

#: Columns that order entries; "first" is by them.
ORDER = ("file_path", "section_pos", "entry_pos")


def checked(entries: DataFrame, *, allow_query: bool = False) -> DataFrame:
    """entries (respondent_id, link, date, ...) with link_class, video_id, watched_at and skip_reason; the link is judged before the date."""
    out = entries.withColumns({"link_class": links.link_class(F.col("link"), allow_query=allow_query), "video_id": links.video_id(F.col("link")), "watched_at": links.watched_at(F.col("date"))})
    why = F.when(F.col("link_class") == "short", "short_link").when(F.col("link_class") == "invalid", "invalid_url").when(F.col("watched_at").isNull(), "bad_date")
    return out.withColumn("skip_reason", why)


def first_by(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key; row_number = 1 lets Spark drop others before the shuffle."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def insert_ignore(existing: DataFrame, rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """What an insert that ignores known keys adds to existing."""
    return first_by(rows, keys, order).join(existing.select(*keys), keys, "left_anti")


def in_window(seconds: Column, start: str | None, end: str | None) -> Column:
    """Whether a time is within inclusive dates; without any, true."""
    day = F.to_date(F.timestamp_seconds(seconds))
    ok = F.lit(True)
    if start:
        ok = ok & (day >= F.lit(start).cast("date"))
    if end:
        ok = ok & (day <= F.lit(end).cast("date"))
    return ok


@dataclass
class Ingested:
    videos: DataFrame
    watch_history: DataFrame
    new_videos: DataFrame
    new_watch: DataFrame
    stats: DataFrame


def video_values(as_of: int) -> dict[str, str]:
    """What an insert puts into the videos table, as SQL over video_id and link; the other columns are null."""
    given = {"video_id": "video_id", "source_url": "link", "canonical": "true", "status": "'pending'", "attempt_count": "0", "first_seen_at": as_of, "updated_at": as_of}
    return {f.name: f"CAST({given[f.name]} AS {f.dataType.simpleString()})" for f in schemas.schema(schemas.VIDEOS) if f.name in given}


def video_rows(valid: DataFrame, as_of: int) -> DataFrame:
    """Rows of the videos table for valid entries, with the defaults of an insert."""
    given = video_values(as_of)
    return valid.selectExpr(*[f"{given.get(f.name, f'CAST(NULL AS {f.dataType.simpleString()})')} AS {f.name}" for f in schemas.schema(schemas.VIDEOS)])


def stats(entries: DataFrame, new_watch: DataFrame, files: Column | None = None) -> DataFrame:
    """One row of counters of checked entries; duplicates are valid rows that added nothing."""
    ok = F.col("skip_reason").isNull()
    reason = lambda x: F.count_if(F.col("skip_reason") == x)
    counted = entries.agg(
        (files if files is not None else F.lit(0)).cast("long").alias("files_processed"),
        F.countDistinct(F.when(ok, F.col("video_id"))).alias("unique_videos_seen"),
        F.count_if(ok).alias("watch_history_rows_processed"),
        reason("short_link").alias("short_links_skipped"),
        reason("invalid_url").alias("invalid_urls_skipped"),
        reason("bad_date").alias("date_parse_failures"),
    )
    added = new_watch.agg(F.count("*").alias("_added"))
    return counted.crossJoin(added).withColumn("watch_history_duplicates", F.col("watch_history_rows_processed") - F.col("_added")).drop("_added")  # two single rows


def ingest(entries: DataFrame, videos: DataFrame, watch_history: DataFrame, *, as_of: int, window: tuple[str | None, str | None] = (None, None), order: list[str] | None = None) -> Ingested:
    """Entries into both tables: new keys are added, known ones left as they are."""
    order = order or [c for c in ORDER if c in entries.columns]
    done = checked(entries)
    valid = done.where("skip_reason is null")
    names = [f.name for f in schemas.schema(schemas.VIDEOS)]
    new_videos = video_rows(insert_ignore(videos, valid, ["video_id"], order), as_of).select(*names)
    watch = valid.select("respondent_id", "video_id", "watched_at", in_window(F.col("watched_at"), *window).alias("in_window"), *order)
    new_watch = insert_ignore(watch_history, watch, ["respondent_id", "video_id", "watched_at"], order).select("respondent_id", "video_id", "watched_at", "in_window")
    files = F.countDistinct("file_path") if "file_path" in entries.columns else None
    return Ingested(videos.unionByName(new_videos), watch_history.unionByName(new_watch), new_videos, new_watch, stats(done, new_watch, files))


def orphans(watch_history: DataFrame, videos: DataFrame) -> DataFrame:
    """Watch rows whose video isn't known."""
    return watch_history.join(videos.select("video_id"), "video_id", "left_anti")


def recompute_window(watch_history: DataFrame, start: str | None = None, end: str | None = None, *, clear: bool = False) -> DataFrame:
    """watch_history, or links that wait (with in_window), with in_window set anew and `changed`; refuses to run without a date or clear."""
    if not (start or end or clear):
        raise ValueError("give a start, an end, or clear=True")
    new = F.lit(True) if clear else in_window(F.col("watched_at"), start, end)
    return watch_history.withColumn("changed", F.col("in_window") != new).withColumn("in_window", new)


def pending_links(entries: DataFrame, existing: DataFrame | None = None, order: list[str] | None = None, window: tuple[str | None, str | None] | None = None) -> DataFrame:
    """Short links that wait for their target: respondent_id, url, watched_at, once each; with a window also in_window, as watch rows have it."""
    order = order or [c for c in ORDER if c in entries.columns]
    rows = checked(entries).where("skip_reason = 'short_link' and watched_at is not null").select("respondent_id", F.col("link").alias("url"), "watched_at", *order)
    keys = ["respondent_id", "url", "watched_at"]
    new = first_by(rows, keys, order) if existing is None else insert_ignore(existing, rows, keys, order)
    return new.select(*keys) if window is None else new.select(*keys, in_window(F.col("watched_at"), *window).alias("in_window"))


def promote_links(pending: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(watch rows of resolved links, links that still wait with their last error); resolved: url, target, error.

    A target that isn't a video link counts as an error.
    """
    r = resolved.select("url", links.video_id(F.col("target")).alias("video_id"), F.col("target").alias("source_url"), "error")
    both = pending.join(r, "url", "left")
    done = both.where("video_id is not null").select("respondent_id", "video_id", "watched_at", "source_url")
    left = both.where("video_id is null").select("respondent_id", "url", "watched_at", F.coalesce("error", F.when(F.col("source_url").isNotNull(), F.lit("target is not a video link"))).alias("last_error"))
    return done, left
