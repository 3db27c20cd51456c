"""Deterministic feeds over the driver's tables: watch entries and video states from events, signals from documents.

Each feed is there twice, as Spark columns and as SQL common table expressions for the oracle.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchloom import schemas
from watchloom.operators import ingest
from watchloom.operators.tables import bounded

AS_OF = 1_707_000_000
ORDER = ["ts", "event_id", "dup"]
#: The probabilities of the tokens and their logarithms, by id modulo 1000: looked up, as rounding a double token by token is slow.
UNIT = [m / 1000.0 for m in range(1000)]
LOGS = [min(round(math.log(p + 0.001), 6), 0.0) for p in UNIT]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def watch_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """respondent_id, link, date and the order ts, event_id, dup."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    vid = (F.lit(7_000_000_000_000_000_000) + F.col("k") * 1_000_003 + F.col("event_id") % 5).cast("string")
    code, m = F.concat(F.lit("ZM"), F.col("k").cast("string")), F.col("event_id") % 10
    link = (
        F.when(m <= 4, F.concat(F.lit("https://www.tiktok.com/@u"), F.col("k").cast("string"), F.lit("/video/"), vid))
        .when(m <= 6, F.concat(F.lit("https://www.tiktokv.com/share/video/"), vid, F.lit("/?utm_source=share")))
        .when(m == 7, F.concat(F.lit("https://vm.tiktok.com/"), code, F.lit("/")))
        .when(m == 8, F.concat(F.lit("https://vm.tiktok.com/"), code, F.lit("/?q=1")))
        .otherwise(F.concat(F.lit("https://example.com/video/"), vid))
    )
    day = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.when(F.col("event_id") % 3 == 0, " UTC").otherwise(""))
    rows = e.select("event_id", "ts", F.concat(F.lit("r"), F.col("user_id").cast("string")).alias("respondent_id"), link.alias("link"), F.when(F.col("event_id") % 47 == 0, "not a date").otherwise(day).alias("date"))
    again = F.when(F.col("event_id") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("dup", F.explode(again))


W = """
w0 AS (SELECT event_id, ts, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
w1 AS (SELECT event_id, ts, 'r' || user_id AS respondent_id, k, CAST(7000000000000000000 + k * 1000003 + event_id % 5 AS VARCHAR) AS vid FROM w0),
w2 AS (SELECT event_id, ts, respondent_id, unnest(CASE WHEN event_id % 7 = 0 THEN [0, 1] ELSE [0] END) AS dup,
  CASE WHEN event_id % 10 <= 4 THEN 'https://www.tiktok.com/@u' || k || '/video/' || vid
       WHEN event_id % 10 <= 6 THEN 'https://www.tiktokv.com/share/video/' || vid || '/?utm_source=share'
       WHEN event_id % 10 = 7 THEN 'https://vm.tiktok.com/ZM' || k || '/'
       WHEN event_id % 10 = 8 THEN 'https://vm.tiktok.com/ZM' || k || '/?q=1'
       ELSE 'https://example.com/video/' || vid END AS link,
  CASE WHEN event_id % 47 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN event_id % 3 = 0 THEN ' UTC' ELSE '' END END AS date
  FROM w1),
w3 AS (SELECT *, CASE WHEN regexp_matches(link, '^https?://(www\\.)?tiktokv?\\.com/(share|@[^/]+)/video/[0-9]{19}([/?]|$)') THEN 'video'
    WHEN regexp_matches(link, '^https?://(v[mt]\\.tiktok\\.com|(www\\.)?tiktok\\.com/t)/[A-Za-z0-9]+/?$') THEN 'short' ELSE 'invalid' END AS link_class,
  nullif(regexp_extract(link, '/video/([0-9]{19})([/?]|$)', 1), '') AS id0,
  CAST(epoch(coalesce(try_strptime(date, '%Y-%m-%d %H:%M:%S'), try_strptime(date, '%Y-%m-%d %H:%M:%S UTC'))) AS BIGINT) AS watched_at FROM w2),
w AS (SELECT event_id, ts, dup, respondent_id, link, date, link_class, CASE WHEN link_class = 'video' THEN id0 END AS video_id, watched_at,
  CASE WHEN link_class = 'short' THEN 'short_link' WHEN link_class = 'invalid' THEN 'invalid_url' WHEN watched_at IS NULL THEN 'bad_date' END AS skip_reason FROM w3),
valid AS (SELECT * FROM w WHERE skip_reason IS NULL)"""


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The videos table in mixed states, from the first valid entry of each video."""
    valid = ingest.checked(watch_entries(spark, sf_dir)).where("skip_reason is null")
    first = ingest.first_by(valid, ["video_id"], ORDER)
    n = F.col("video_id").cast("long")
    status = F.element_at(F.array(*map(F.lit, schemas.STATUSES)), (n % 5 + 1).cast("int"))
    when = lambda s, x: F.when(F.col("status") == s, x)
    t = first.withColumn("status", status)
    made: dict[str, Column] = {
        "source_url": F.col("link"),
        "canonical": F.lit(True),
        "claimed_by": when("in_progress", F.concat(F.lit("w"), (n % 3).cast("string"))),
        "claimed_at": when("in_progress", F.lit(AS_OF + 200) - (n % 97) * 41),
        "attempt_count": n % 4,
        "succeeded_at": when("succeeded", F.lit(AS_OF) - n % 1000),
        "duration_s": when("succeeded", (n % 600) / 10.0),
        "language_detected": when("succeeded", F.element_at(F.array(*map(F.lit, ("en", "fr", "de", "es"))), (n % 4 + 1).cast("int"))),
        "fetcher": when("succeeded", F.lit("ytdlp")),
        "transcript_source": when("succeeded", F.lit("asr")),
        "last_retryable_kind": when("failed_retryable", F.when(n % 2 == 0, "Fetch").otherwise("Transcribe")),
        "last_retryable_message": when("failed_retryable", F.concat(F.lit("code "), (n % 7).cast("string"))),
        "terminal_reason": when("failed_terminal", F.when(n % 2 == 0, "Deleted").otherwise("Private")),
        "terminal_message": when("failed_terminal", F.concat(F.lit("gone "), (n % 3).cast("string"))),
        "first_seen_at": F.col("watched_at"),
        "updated_at": F.lit(AS_OF) - n % 100_000,
    }
    return t.select(*[made.get(f.name, F.col(f.name) if f.name in ("video_id", "status") else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.schema(schemas.VIDEOS)])


V = (
    W
    + """,
v0 AS (SELECT *, CAST(video_id AS BIGINT) AS n, row_number() OVER (PARTITION BY video_id ORDER BY ts, event_id, dup) AS rn FROM valid),
v1 AS (SELECT *, ['pending', 'in_progress', 'succeeded', 'failed_terminal', 'failed_retryable'][CAST(n % 5 + 1 AS INTEGER)] AS status FROM v0 WHERE rn = 1),
v AS (SELECT video_id, n, link AS source_url, true AS canonical, status,
  CASE WHEN status = 'in_progress' THEN 'w' || (n % 3) END AS claimed_by,
  CASE WHEN status = 'in_progress' THEN 1707000200 - (n % 97) * 41 END AS claimed_at,
  n % 4 AS attempt_count,
  CASE WHEN status = 'succeeded' THEN 1707000000 - n % 1000 END AS succeeded_at,
  CASE WHEN status = 'succeeded' THEN CAST(n % 600 AS DOUBLE) / 10.0 END AS duration_s,
  CASE WHEN status = 'succeeded' THEN ['en', 'fr', 'de', 'es'][CAST(n % 4 + 1 AS INTEGER)] END AS language_detected,
  CASE WHEN status = 'succeeded' THEN 'ytdlp' END AS fetcher,
  CASE WHEN status = 'succeeded' THEN 'asr' END AS transcript_source,
  CASE WHEN status = 'failed_retryable' THEN CASE WHEN n % 2 = 0 THEN 'Fetch' ELSE 'Transcribe' END END AS last_retryable_kind,
  CASE WHEN status = 'failed_retryable' THEN 'code ' || (n % 7) END AS last_retryable_message,
  CASE WHEN status = 'failed_terminal' THEN CASE WHEN n % 2 = 0 THEN 'Deleted' ELSE 'Private' END END AS terminal_reason,
  CASE WHEN status = 'failed_terminal' THEN 'gone ' || (n % 3) END AS terminal_message,
  watched_at AS first_seen_at, 1707000000 - n % 100000 AS updated_at FROM v1)"""
)


def requests(v: DataFrame) -> DataFrame:
    """Change requests for every third video, two for every ninth: video_id, worker_id, ord and what a transition stores."""
    n = F.col("video_id").cast("long")
    two = F.when(n % 9 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    r = v.where(n % 3 == 0).select("video_id", n.alias("n"), F.explode(two).alias("ord"))
    worker = F.concat(F.lit("w"), F.when(F.col("ord") == 1, F.col("n") % 2).otherwise(F.col("n") % 3).cast("string"))
    return r.select(
        "video_id", "ord", worker.alias("worker_id"), ((F.col("n") % 300) / 10.0).alias("duration_s"), F.lit("nl").alias("language"), F.lit("ytdlp").alias("fetcher"), F.lit("asr").alias("transcript_source"),
        F.when(F.col("n") % 2 == 0, "Fetch").otherwise("Transcribe").alias("kind"), F.concat(F.lit("m"), (F.col("n") % 11).cast("string")).alias("message"),
    )


R = (
    V
    + """,
r0 AS (SELECT video_id, n, unnest(CASE WHEN n % 9 = 0 THEN [1, 2] ELSE [1] END) AS ord FROM v WHERE n % 3 = 0),
r AS (SELECT video_id, n, ord, 'w' || CASE WHEN ord = 1 THEN n % 2 ELSE n % 3 END AS worker_id, CAST(n % 300 AS DOUBLE) / 10.0 AS duration_s,
  CASE WHEN n % 2 = 0 THEN 'Fetch' ELSE 'Transcribe' END AS kind, 'm' || (n % 11) AS message FROM r0),
r2 AS (SELECT r.*, coalesce(v.status = 'in_progress' AND v.claimed_by = r.worker_id, false) AS passes FROM r JOIN v USING (video_id)),
r3 AS (SELECT *, CASE WHEN passes AND row_number() OVER (PARTITION BY video_id, passes ORDER BY ord) = 1 THEN 1 ELSE 0 END AS changed FROM r2),
won AS (SELECT * FROM r3 WHERE changed = 1)"""
)


def worded(batches: Iterable[pa.RecordBatch], post: bool, real: pa.DataType = pa.float64()) -> Iterator[pa.RecordBatch]:
    """doc_id, language, segments of batches of doc_id, language, text: whole columns at a time, as a lambda a token is slow. real: of the probabilities."""
    for b in batches:
        ids = b.column("doc_id")
        doc, known = np.asarray(ids.fill_null(0)).astype(np.int64), np.asarray(ids.is_valid())
        lines = pc.split_pattern(b.column("text"), "\n")
        n_lines = np.asarray(pc.list_value_length(lines))
        words = pc.split_pattern(lines.flatten(), " ")
        row = np.repeat(np.arange(len(doc)), n_lines)  # of each line
        ends = np.append(0, np.cumsum(n_lines))
        seg = np.arange(len(row)) - ends[row]
        line = np.repeat(np.arange(len(row)), np.asarray(pc.list_value_length(words)))  # of each word
        text = words.flatten()
        full = pc.not_equal(text, "")
        text, line = text.filter(full), line[np.asarray(full)]
        stops = np.append(0, np.cumsum(np.bincount(line, minlength=len(row))))
        tok, at = np.arange(len(line)) - stops[line], row[line]
        i = np.fmod(doc[at] * 31 + seg[line] * 17 + tok * 7, 50000)
        m, lost = np.fmod(i, 1000), ~known[at]
        p = np.asarray(UNIT)[m]
        if post:
            head = (seg[line] == 0) & (tok == 0) & known[at]
            text = pc.if_else(pa.array(head & (doc[at] % 44 == 0)), pc.binary_join_element_wise(text, "x", ""), text)
            p = p + np.where(head & (doc[at] % 44 == 11), 1e-5, 0.0)
        column = lambda x, kind, none: pa.array(x, mask=none).cast(kind)
        tokens = pa.StructArray.from_arrays([column(i.astype(np.int32), pa.int32(), lost), text, column(p, real, lost | (m < 0)), column(np.asarray(LOGS)[m], real, lost | (m < 0))], names=["id", "text", "p", "plog"])
        silence = column(np.fmod(doc[row] + seg, 100) / 100.0, real, ~known[row])
        segments = pa.StructArray.from_arrays([silence, pa.ListArray.from_arrays(pa.array(stops, pa.int32()), tokens)], names=["no_speech_prob", "tokens"])
        yield pa.RecordBatch.from_arrays([ids, b.column("language"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), segments)], names=["doc_id", "language", "segments"])


def artifacts(spark: SparkSession, sf_dir: str, *, post: bool = False, single: bool = False) -> DataFrame:
    """video_id, language, segments from documents: lines are segments, words tokens. post: the same with every 11th perturbed. single: floats, made as such, as a cast a token is slow."""
    d = table(bounded(spark), sf_dir, "documents").select("doc_id", F.col("lang").alias("language"), F.coalesce("text", F.lit("")).alias("text"))
    if post:
        d = d.where("doc_id % 44 <> 33")
    kind = f"doc_id {d.schema['doc_id'].dataType.simpleString()}, language string, segments {schemas.SEGMENTS if single else schemas.SEGMENTS.replace('float', 'double')}"
    out = d.mapInArrow(lambda batches: worded(batches, post, pa.float32() if single else pa.float64()), kind).select("doc_id", F.lpad(F.col("doc_id").cast("string"), 19, "0").alias("video_id"), "language", "segments")
    if post:
        s = F.col("segments")
        merged = F.concat(F.array(F.struct(s[0]["no_speech_prob"].alias("no_speech_prob"), F.concat(s[0]["tokens"], s[1]["tokens"]).alias("tokens"))), F.slice(s, 3, F.size(s)))
        out = out.withColumn("segments", F.when((F.col("doc_id") % 44 == 22) & (F.size(s) >= 2), merged).otherwise(s))
    return out


T = """
t0 AS (SELECT doc_id, lang, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
t1 AS (SELECT doc_id, lang, lines, unnest(range(0, len(lines))) AS seg FROM t0),
t2 AS (SELECT doc_id, lang, seg, [x FOR x IN string_split(lines[seg + 1], ' ') IF x <> ''] AS words FROM t1),
segs AS (SELECT doc_id, lang, seg, CAST((doc_id + seg) % 100 AS DOUBLE) / 100.0 AS nsp, len(words) AS n FROM t2),
t3 AS (SELECT doc_id, seg, words, unnest(range(0, len(words))) AS tok FROM t2),
toks AS (SELECT doc_id, seg, tok, words[tok + 1] AS text, (doc_id * 31 + seg * 17 + tok * 7) % 50000 AS id FROM t3),
tokens AS (SELECT *, CAST(id % 1000 AS DOUBLE) / 1000.0 AS p, least(round(ln(CAST(id % 1000 AS DOUBLE) / 1000.0 + 0.001), 6), 0.0) AS plog FROM toks)"""
