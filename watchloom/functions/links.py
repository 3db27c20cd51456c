"""Column expressions over links, dates, file names and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a video link and a short link look like. \z, as Java's $ also matches before a last newline.
VIDEO_LINK = r"^https?://(?:www\.)?tiktokv?\.com/(?:share|@[^/]+)/video/([0-9]{19})(?:[/?]|\z)"
SHORT_LINK = r"^https?://(?:v[mt]\.tiktok\.com|(?:www\.)?tiktok\.com/t)/[A-Za-z0-9]+/?\z"
SHORT_LINK_QUERY = r"^https?://(?:v[mt]\.tiktok\.com|(?:www\.)?tiktok\.com/t)/[A-Za-z0-9]+/?(?:\?[^#]*)?\z"
DATE_LAYOUTS = ("yyyy-M-d H:m:s", "yyyy-M-d H:m:s 'UTC'")


def link_class(url: Column, *, allow_query: bool = False) -> Column:
    """video, short or invalid; a short link with a query is invalid unless allowed."""
    short = F.regexp_like(url, F.lit(SHORT_LINK_QUERY if allow_query else SHORT_LINK))
    return F.when(F.regexp_like(url, F.lit(VIDEO_LINK)), "video").when(short, "short").otherwise("invalid")


def video_id(url: Column) -> Column:
    """19 digits as text (too long for a double), or null."""
    return F.nullif(F.regexp_extract(url, VIDEO_LINK, 1), F.lit(""))


def watched_at(date: Column) -> Column:
    """Unix seconds of a date in one of two layouts, read as UTC; null if in neither."""
    return F.unix_timestamp(F.coalesce(*[F.try_to_timestamp(date, F.lit(x)) for x in DATE_LAYOUTS]))


def respondent_id(path: Column, level: int = -1) -> Column:
    """What follows participant= in the file's stem, up to the next underscore; null if absent or empty. level -2: in its folder's name."""
    name = F.try_element_at(F.split(path, "/"), F.lit(level))
    stem = F.regexp_replace(name, r"\.[^.]*\z", "")
    return F.nullif(F.regexp_extract(stem, r"(?:^|_)participant=([^_]*)", 1), F.lit(""))


def shard(key: Column) -> Column:
    """The last two characters, or all of a shorter id."""
    return F.when(F.length(key) < 2, key).otherwise(F.right(key, F.lit(2)))


def shard_path(root: str, key: Column, suffix: str) -> Column:
    return F.concat_ws("/", F.lit(root), shard(key), F.concat(key, F.lit(suffix)))


def rfc3339(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ssXXX")
