"""Batch enrichment of claimed rows by a user's callable, WAV decoding, and the driver of a run."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchloom import schemas
from watchloom.functions.links import rfc3339
from watchloom.operators import failures, reports, signals, state, tables

#: Fixed values.
RATE = 16000
#: What an enricher returns for a row: a result (see failures.routed), and a transcript or an error message.
RESULT = f"video_id string, source_url string, attempt_count long, worker_id string, stage string, result string, message string, text string, language string, duration_s double, lang_probs array<struct<code:string,p:float>>, segments {schemas.SEGMENTS}, model string, fetcher string, transcript_source string"

#: A callable that is made once a Python worker and takes a claim (a dict) to a dict of RESULT's columns.
Enricher = Callable[[dict], dict]


def enrich(claims: DataFrame, make: Callable[[], Enricher], parallel: int | None = None) -> DataFrame:
    """Run the enricher over the claims on the executors; an exception it raises becomes a row with result bug."""
    names = [f.name for f in schemas.schema(RESULT)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make()
        for b in batches:
            rows = []
            for claim in b.to_dict("records"):
                try:
                    got = fn(claim)
                except Exception as e:  # noqa: BLE001 - reported as a row, the run stops on it
                    got = {"stage": "transcribe", "result": "bug", "message": f"{type(e).__name__}: {e}"[:500]}
                rows.append({**dict.fromkeys(names), **claim, **got})
            yield pd.DataFrame(rows, columns=names)

    rows = claims if parallel is None else claims.repartition(parallel)
    return rows.mapInPandas(run, RESULT)


def decode_wav(data: bytes) -> tuple[np.ndarray | None, str | None]:
    """(samples in [-1, 1], None) of 16 kHz mono 16-bit or 32-bit float PCM, or (None, kind of error)."""
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return None, "not_wav"
    at, form, body = 12, None, None
    while at + 8 <= len(data):
        name, n = struct.unpack_from("<4sI", data, at)
        if name == b"fmt ":
            form = data[at + 8 : at + 8 + n]
        elif name == b"data":
            body = data[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    if form is None or len(form) < 16 or body is None:
        return None, "not_wav"
    kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", form)
    if kind == 0xFFFE and len(form) >= 26:
        kind = struct.unpack_from("<H", form, 24)[0]
    if rate != RATE:
        return None, "sample_rate"
    if channels != 1:
        return None, "channels"
    if (kind, bits) == (1, 16):
        x = np.frombuffer(body, "<i2", len(body) // 2).astype(np.float32) / np.float32(32768)
    elif (kind, bits) == (3, 32):
        x = np.frombuffer(body, "<f4", len(body) // 4)
    else:
        return None, "sample_format"
    return (x, None) if len(x) else (None, "empty")


def wav_files(files: DataFrame, *, samples: bool = False) -> DataFrame:
    """path, n_samples, duration_s, error_kind (and samples) of binaryFile rows; a bad file is a row, not a failure."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [decode_wav(bytes(c)) for c in b["content"]]
            out = pd.DataFrame({"path": b["path"], "n_samples": [len(x) if x is not None else 0 for x, _ in got], "duration_s": [len(x) / RATE if x is not None else None for x, _ in got], "error_kind": [e for _, e in got]})
            yield out.assign(samples=[x for x, _ in got]) if samples else out

    return files.select("path", "content").mapInPandas(run, "path string, n_samples long, duration_s double, error_kind string" + ", samples array<float>" * samples)


@dataclass
class Run:
    videos: DataFrame
    events: DataFrame
    outcomes: DataFrame
    artifacts: DataFrame
    stats: DataFrame


def artifacts_of(done: DataFrame, as_of: int) -> DataFrame:
    """Artifact rows of enriched items."""
    probs = signals.ranked_languages(F.col("lang_probs"))
    return done.select("video_id", "source_url", "duration_s", F.col("language").alias("language_detected"), rfc3339(F.lit(as_of)).alias("transcribed_at"), "fetcher", "transcript_source", "model", F.when(F.col("segments").isNotNull(), signals.raw_signals(F.col("language"), probs, F.col("segments"))).alias("raw_signals"), "text")


def apply_outcomes(videos: DataFrame, done: DataFrame, as_of: int, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(videos, events, outcomes): guarded transitions for routed items; a success whose claim is gone is stale_after_success.

    keep: see process_run; without it, each transition works out the ones before it twice.
    """
    r = failures.routed(done).withColumn("ord", F.lit(0))
    ok = state.mark_succeeded(videos, r.where("route = 'succeeded'"), as_of)
    bad = state.mark_retryable(keep(ok.videos), r.where("route = 'failed_retryable'"), as_of)
    end = state.mark_terminal(keep(bad.videos), r.where("route = 'failed_terminal'").withColumn("kind", F.lit("unavailable")), as_of)
    told = lambda c, name, late: c.outcomes.select("video_id", F.when(F.col("changed") == 1, name).otherwise(late).alias("outcome"))
    outcomes = told(ok, "succeeded", "stale_after_success").unionByName(told(bad, "failed_retryable", "stale_after_failure")).unionByName(told(end, "failed_terminal", "stale_after_failure"))
    return end.videos, ok.events.unionByName(bad.events).unionByName(end.events), outcomes


def process_run(videos: DataFrame, make: Callable[[], Enricher], *, as_of: int, workers: list[str], cap: int | None, stale_after: int = state.STALE_AFTER, write=None, keep=tables.written) -> Run:  # noqa: ANN001
    """Sweep, claim up to the cap (None: until no video is pending), enrich, write artifacts, then mark: artifacts are there before a success is.

    write(artifacts) commits them; keep(df) makes a step's rows durable and reads them back, so that the enricher runs once.
    """
    swept, _ = state.sweep_stale(keep(videos), as_of, stale_after)  # each step below reads the videos twice
    claims = keep(state.claims_of(swept, cap, workers))
    claimed, events = keep(state.claimed(swept, claims, as_of)), state.event_rows(claims, "claimed", as_of, F.col("worker_id"))
    done = keep(enrich(claims, make))
    failures.raise_on_bugs(failures.routed(done))
    artifacts = artifacts_of(done.where("result in ('ok', 'ready')"), as_of)
    if write is not None:
        write(artifacts)
    new, more, outcomes = apply_outcomes(claimed, done, as_of, keep)
    return Run(new, events.unionByName(more), outcomes, artifacts, reports.process_stats(new))
