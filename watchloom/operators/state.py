"""The state of videos as a table: claims, guarded transitions, recovery, and the event log.

All functions are pure: DataFrames in, DataFrames out, with the time as a parameter. One driver writes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchloom.operators.tables import numbered

#: Seconds after which a claim is stale, unless told otherwise.
STALE_AFTER = 1800


@dataclass
class Change:
    videos: DataFrame
    events: DataFrame  # without ids
    outcomes: DataFrame  # the requests with `changed` 0 or 1


def event_rows(rows: DataFrame, kind: str, as_of: int, worker: Column, detail: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return rows.select("video_id", F.lit(as_of).cast("long").alias("at"), F.lit(kind).alias("event_type"), worker.alias("worker_id"), (none if detail is None else detail).alias("detail_json"))


def pending_queue(videos: DataFrame, n: int | None = None) -> DataFrame:
    """Claimable videos, oldest first."""
    q = videos.where("status = 'pending'").select("video_id", "source_url", "attempt_count", "first_seen_at").orderBy("first_seen_at", "video_id")
    return q if n is None else q.limit(n)


def claims_of(videos: DataFrame, n: int | None, workers: list[str]) -> DataFrame:
    """video_id, source_url, attempt_count, worker_id of the n oldest pending videos, dealt to the workers in turn; None: all of them."""
    order = ("first_seen_at", "video_id")
    if n is None:
        head = numbered(videos.where("status = 'pending'").select("video_id", "source_url", "attempt_count", "first_seen_at"), *order)
    else:
        head = pending_queue(videos, n).withColumn("nth", F.row_number().over(Window.orderBy(*order)) - 1)  # over n rows at most
    names = F.array(*[F.lit(w) for w in workers])
    return head.select("video_id", "source_url", (F.col("attempt_count") + 1).alias("attempt_count"), F.element_at(names, (F.col("nth") % len(workers) + 1).cast("int")).alias("worker_id"))


def claimed(videos: DataFrame, claims: DataFrame, as_of: int) -> DataFrame:
    """videos with the claims in them."""
    c = claims.select("video_id", F.col("worker_id").alias("_w"))
    hit = F.col("_w").isNotNull()
    now = F.lit(as_of).cast("long")
    new = videos.join(c, "video_id", "left").withColumns(
        {
            "status": F.when(hit, "in_progress").otherwise(F.col("status")),
            "claimed_by": F.coalesce("_w", "claimed_by"),
            "claimed_at": F.when(hit, now).otherwise(F.col("claimed_at")),
            "attempt_count": F.col("attempt_count") + hit.cast("long"),
            "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
        }
    )
    return new.select(*videos.columns)


def claim_batch(videos: DataFrame, n: int | None, workers: list[str], as_of: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(videos, claims, events): the n oldest pending videos go to the workers in turn; None: all of them."""
    claims = claims_of(videos, n, workers)
    return claimed(videos, claims, as_of), claims, event_rows(claims, "claimed", as_of, F.col("worker_id"))


def transition(videos: DataFrame, requests: DataFrame, values: dict[str, Column], kind: str, as_of: int, detail: Column | None = None) -> Change:
    """Apply to each video its first request (by ord) whose worker holds it in progress; other requests change nothing.

    requests: video_id, worker_id, ord, and the columns that values (target column -> column over them) use.
    """
    held = videos.where("status = 'in_progress'").select("video_id", F.col("claimed_by").alias("_holder"))
    asked = requests.join(held, "video_id", "left").withColumn("_passes", F.coalesce(F.col("_holder") == F.col("worker_id"), F.lit(False)))
    turn = F.row_number().over(Window.partitionBy("video_id", "_passes").orderBy("ord"))
    asked = asked.withColumn("changed", (F.col("_passes") & (turn == 1)).cast("int")).drop("_holder", "_passes")
    won = asked.where("changed = 1")
    sets = won.select("video_id", F.struct(*[v.alias(k) for k, v in values.items()], F.lit(as_of).cast("long").alias("updated_at")).alias("_set"))
    hit = F.col("_set").isNotNull()
    new = videos.join(sets, "video_id", "left")
    new = new.select(*[F.when(hit, F.col(f"_set.{f.name}").cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in values or f.name == "updated_at" else F.col(f.name) for f in videos.schema.fields])
    return Change(new, event_rows(won, kind, as_of, F.col("worker_id"), detail), asked)


def mark_succeeded(videos: DataFrame, requests: DataFrame, as_of: int) -> Change:
    """requests also have duration_s, language, fetcher, transcript_source; the claim's columns stay."""
    values = {"status": F.lit("succeeded"), "succeeded_at": F.lit(as_of), "duration_s": F.col("duration_s"), "language_detected": F.col("language"), "fetcher": F.col("fetcher"), "transcript_source": F.col("transcript_source")}
    return transition(videos, requests, values, "succeeded", as_of)


def failure(videos: DataFrame, requests: DataFrame, as_of: int, status: str, names: tuple[str, str], key: str) -> Change:
    """The claim is cleared; what another kind of failure left stays."""
    none = F.lit(None).cast("string")
    values = {"status": F.lit(status), "claimed_by": none, "claimed_at": F.lit(None).cast("long"), names[0]: F.col("kind"), names[1]: F.col("message")}
    return transition(videos, requests, values, status, as_of, F.to_json(F.struct(F.col("kind").alias(key), "message")))


def mark_retryable(videos: DataFrame, requests: DataFrame, as_of: int) -> Change:
    """requests also have kind and message."""
    return failure(videos, requests, as_of, "failed_retryable", ("last_retryable_kind", "last_retryable_message"), "kind")


def mark_terminal(videos: DataFrame, requests: DataFrame, as_of: int) -> Change:
    return failure(videos, requests, as_of, "failed_terminal", ("terminal_reason", "terminal_message"), "reason")


def is_stale(as_of: int, older_than: int) -> Column:
    return (F.col("status") == "in_progress") & F.col("claimed_at").isNotNull() & (F.col("claimed_at") < as_of - older_than)


def sweep_stale(videos: DataFrame, as_of: int, older_than: int = STALE_AFTER, *, with_events: bool = False) -> tuple[DataFrame, DataFrame]:
    """(videos, events): stale claims are pending again, attempts as they were; events only if asked for."""
    stale = F.coalesce(is_stale(as_of, max(0, older_than)), F.lit(False))
    events = event_rows(videos.where(stale if with_events else F.lit(False)), "released_stale", as_of, F.col("claimed_by"))
    new = videos.withColumn("_s", stale)
    put = {"status": F.lit("pending"), "claimed_by": F.lit(None).cast("string"), "claimed_at": F.lit(None).cast("long"), "updated_at": F.lit(as_of).cast("long")}
    return new.select(*[F.when(F.col("_s"), put[c]).otherwise(F.col(c)).alias(c) if c in put else F.col(c) for c in videos.columns]), events


def requeue(videos: DataFrame, as_of: int, *, older_than: int | None = None, kinds: list[str] | None = None, max_attempts: int | None = None, most: int | None = None, dry_run: bool = False) -> DataFrame:
    """Retryable failures back to pending (their history stays); with dry_run the ids that would go."""
    pick = videos.where("status = 'failed_retryable'")
    if older_than is not None:
        pick = pick.where(F.col("updated_at") < as_of - older_than)
    if kinds:
        pick = pick.where(F.col("last_retryable_kind").isin(*kinds))
    if max_attempts is not None:
        pick = pick.where(F.col("attempt_count") < max_attempts)
    pick = pick.orderBy("updated_at", "video_id")
    pick = (pick if most is None else pick.limit(most)).select("video_id")
    if dry_run:
        return pick
    got = videos.join(pick.withColumn("_hit", F.lit(True)), "video_id", "left")
    put = {"status": F.lit("pending"), "updated_at": F.lit(as_of).cast("long")}
    return got.select(*[F.when(F.col("_hit"), put[c]).otherwise(F.col(c)).alias(c) if c in put else F.col(c) for c in videos.columns])


def reset_stale(videos: DataFrame, as_of: int, max_age: int, *, dry_run: bool = False) -> DataFrame:
    """The sweep by hand; the age has no default. With dry_run the ids that would go."""
    return videos.where(is_stale(as_of, max_age)).select("video_id") if dry_run else sweep_stale(videos, as_of, max_age)[0]


def append_events(log: DataFrame, events: DataFrame) -> DataFrame:
    """The log with new events under the next ids, by time and video."""
    last = log.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return log.unionByName(numbered(events, "at", "video_id", "event_type", name="id", start=last + 1).select(*log.columns))


def history(log: DataFrame, video_id: str) -> DataFrame:
    return log.where(F.col("video_id") == video_id).orderBy("id")
