"""Runs over committed state: claims, sweeps, marks and a loop of batches that goes on where a killed one left off.

Each step is one commit (see commits): it reads and rewrites the buckets of the videos it touches, and its events, artifacts and
outcomes become visible with it. Several drivers may work on one root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchloom.operators import commits, enrich, failures, state, tables
from watchloom.operators.commits import Change, Snapshot


def start(spark: SparkSession, root: str, videos: DataFrame, *, buckets: int = commits.BUCKETS) -> Snapshot:
    """A root with these videos, if it has none yet."""
    return commits.transact(spark, root, lambda s: None if "videos" in s.tables else Change(appended={"videos": videos}, reads={"videos": None}), buckets=buckets)[0]


def numbered_events(base: Snapshot, events: DataFrame) -> DataFrame:
    """Events under ids of their own, by time and video; ids are reserved first, so a change that fails leaves a gap."""
    rows = tables.written(events)
    first = commits.reserve(base.spark, base.root, "event_id", rows.count())
    return tables.numbered(rows, "at", "video_id", "event_type", name="id", start=first).select("id", *events.columns)


def claim(spark: SparkSession, root: str, n: int, workers: list[str], as_of: int) -> DataFrame | None:
    """The n oldest pending videos, claimed; None if none is pending. Of drivers that claim at once, one works its claims out anew."""

    def work(base: Snapshot) -> Change | None:
        claims = tables.written(state.claims_of(base.read("videos"), n, workers))  # n rows at most
        at = base.touched("videos", claims)
        if not at:
            return None
        events = numbered_events(base, state.event_rows(claims, "claimed", as_of, F.col("worker_id")))
        return Change(replaced={"videos": (state.claimed(base.read("videos", at), claims, as_of), at)}, appended={"video_events": events}, reads={"videos": None}, result=claims)

    return commits.transact(spark, root, work)[1]


def sweep(spark: SparkSession, root: str, as_of: int, older_than: int = state.STALE_AFTER) -> int:
    """How many stale claims are pending again; only their buckets are rewritten."""

    def work(base: Snapshot) -> Change | None:
        stale = tables.written(state.reset_stale(base.read("videos"), as_of, max(0, older_than), dry_run=True))
        at = base.touched("videos", stale)
        return Change(replaced={"videos": (state.sweep_stale(base.read("videos", at), as_of, older_than)[0], at)}, result=stale.count()) if at else None

    return commits.transact(spark, root, work)[1] or 0


def mark(spark: SparkSession, root: str, done: DataFrame, as_of: int) -> Snapshot:
    """Guarded transitions for enriched rows (durable ones: they are read more than once), with their artifacts and outcomes.

    The artifacts of a success whose claim is gone are not kept: another run has the video.
    """

    def work(base: Snapshot) -> Change | None:
        at = base.touched("videos", done)
        if not at:
            return None
        new, events, outcomes = enrich.apply_outcomes(base.read("videos", at), done, as_of)
        outcomes = tables.written(outcomes.withColumn("at", F.lit(as_of).cast("long")))
        kept = done.join(outcomes.where("outcome = 'succeeded'").select("video_id"), "video_id", "left_semi")
        return Change(replaced={"videos": (new, at)}, appended={"video_events": numbered_events(base, events), "artifacts": enrich.artifacts_of(kept, as_of), "outcomes": outcomes})

    return commits.transact(spark, root, work)[0]


def run(spark: SparkSession, root: str, make: Callable[[], enrich.Enricher], *, clock: Callable[[], int], workers: list[str], batch: int, cap: int | None = None, stale_after: int = state.STALE_AFTER) -> Snapshot:
    """Sweep, then batch by batch claim, enrich, and mark, until no video is pending or `cap` are claimed.

    A run that is killed leaves claims behind, no half marks; the next one takes them up when they are stale. Committed batches
    aren't done again.
    """
    sweep(spark, root, clock(), stale_after)
    left = cap
    while left is None or left > 0:
        claims = claim(spark, root, batch if left is None else min(batch, left), workers, clock())
        if claims is None:
            break
        done = tables.written(enrich.enrich(claims, make))
        failures.raise_on_bugs(failures.routed(done))
        mark(spark, root, done, clock())
        left = None if left is None else left - claims.count()
        for table in ("video_events", "artifacts", "outcomes"):
            commits.compact(spark, root, table)
    return commits.snapshot(spark, root)
