"""Declared schemas, their version, and the checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Fixed values.
SCHEMA_VERSION = "2"
SIGNALS_VERSION = "1"
STATUSES = ("pending", "in_progress", "succeeded", "failed_terminal", "failed_retryable")
ADDED_IN_2 = ("last_retryable_kind", "last_retryable_message", "terminal_reason", "terminal_message")

EXPORT = "array<struct<tiktok_watch_history:array<struct<Date:string,Link:string>>>>"
TOKEN = "struct<id:int,text:string,p:float,plog:float>"
SEGMENTS = f"array<struct<no_speech_prob:float,tokens:array<{TOKEN}>>>"
SIGNALS = f"struct<schema_version:string,language:string,lang_probs:array<struct<code:string,p:float>>,segments:{SEGMENTS}>"
#: As written: lang_probs is a list of [code, p] pairs, read as strings.
SIGNALS_WIRE = f"struct<schema_version:string,language:string,lang_probs:array<array<string>>,segments:{SEGMENTS}>"
ARTIFACT = f"video_id string, source_url string, duration_s double, language_detected string, transcribed_at string, fetcher string, transcript_source string, model string, raw_signals {SIGNALS_WIRE}"
VIDEOS = (
    "video_id string, source_url string, canonical boolean, status string, claimed_by string, claimed_at long, attempt_count long, succeeded_at long, "
    "duration_s double, language_detected string, fetcher string, transcript_source string, last_retryable_kind string, last_retryable_message string, "
    "terminal_reason string, terminal_message string, first_seen_at long, updated_at long"
)
WATCH = "respondent_id string, video_id string, watched_at long, in_window boolean"
EVENTS = "id long, video_id string, at long, event_type string, worker_id string, detail_json string"
META = "key string, value string"
TABLES = {"videos": VIDEOS, "watch_history": WATCH, "video_events": EVENTS, "meta": META}


def schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schema(TABLES[name]))


def meta_value(meta: DataFrame, key: str) -> DataFrame:
    return meta.where(F.col("key") == key).select("value")


def require_version(meta: DataFrame, wanted: str = SCHEMA_VERSION) -> None:
    """Raise unless the tables have the wanted version; a table without one is of version 1."""
    row = meta_value(meta, "schema_version").first()
    found = row["value"] if row else "1"
    if found != wanted:
        raise ValueError(f"tables have schema version {found}, not {wanted}: run watchloom.schemas.upgrade on them")


def upgrade(videos: DataFrame, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Version 1 to 2: four nullable columns and the new version; nothing if current; other versions are refused."""
    row = meta_value(meta, "schema_version").first()
    found = row["value"] if row else "1"
    if found == SCHEMA_VERSION:
        return videos, meta
    if found != "1":
        raise ValueError(f"no way from schema version {found} to {SCHEMA_VERSION}")
    order = [f.name for f in schema(VIDEOS)]
    up = videos.withColumns({c: F.lit(None).cast("string") for c in ADDED_IN_2 if c not in videos.columns})
    new = meta.where("key <> 'schema_version'").union(meta.sparkSession.createDataFrame([("schema_version", SCHEMA_VERSION)], schema(META)))
    return up.select(*order), new


def status_violations(videos: DataFrame) -> DataFrame:
    return videos.where(F.col("status").isNull() | ~F.col("status").isin(*STATUSES))


def require_keys(df: DataFrame, *keys: str) -> None:
    """Raise if a key column has a null."""
    bad = df.where(" or ".join(f"{k} is null" for k in keys)).limit(1).count()
    if bad:
        raise ValueError(f"null in a key of {keys}")
