"""Improbable-feature digests of documents.

Every window of 64 bytes (W) gets the Shannon entropy of its bytes. How often each entropy occurs in the corpus,
counted on windows that cover every byte of all texts, gives its rarity; a window's rank is that rarity. A window that is the
rarest (the leftmost of equals) in at least `POPULAR` of the W spans of W windows around it is a feature. Features
go into a chain of Bloom filters of 2048 bits, 5 bits and at most 128 features each. A text below `SHORT` bytes also has
windows of 8 bytes (SMALL), with a rarity and a chain of their own. Two digests are compared filter by filter by the overlap of
their bits, between what chance gives (0) and what is possible (1): by the chains of small windows if both have one.

Defined results: a null text is an empty one; an empty text has an empty fingerprint; a chain without a feature (a text shorter than the
window, or the same byte throughout) has the text itself as its one feature; two equal fingerprints have likeness 1, an empty one and
another 0; `next` follows descending (doc_id, text hash), null ids last, and the last row is followed by the first;
rows equal in both follow one another; a single row follows itself; an empty table gives an empty result; other
columns are not touched. An id is a whole number, as the order goes by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import below, halves, keys_of, materialise, need, ordered_key, pieces, prepare, slice_of, splitters
from watchloom.llm.words import U, flat, mix64

W, POPULAR, BITS, FULL, MARKS = 64, 16, 2048, 128, 5
#: Windows of short texts, of how many spans such a window must be the rarest, and below how many bytes a text is short.
SMALL, SMALL_POPULAR, SHORT = 8, 2, 512
#: Slices at most: the driver holds a key of each.
MOST_SLICES = 1 << 16
#: Entropies are told apart in so many steps.
STEPS = 512
_c = np.arange(W + 1)
#: c log2 c, and what it gains from c - 1 to c.
TERM = _c * np.log2(np.maximum(_c, 1))
GAIN = np.diff(TERM, prepend=0.0)
WEIGHT = mix64(np.arange(1, W + 1, dtype=np.uint64) * U(0xC2B2AE3D27D4EB4F)) | U(1)


def quantised(total: np.ndarray, w: int = W) -> np.ndarray:
    """Entropy step of windows by their sum of c log2 c; entropy is log2 w - total / w."""
    return np.clip((STEPS - 1) * (1 - total / (w * np.log2(w))) + 0.5, 0, STEPS - 1).astype(np.int32)


def entropies(data: np.ndarray, w: int = W) -> np.ndarray:
    """The entropy step of every window of w bytes, each found from the one before."""
    n = len(data)
    if n < w:
        return np.zeros(0, np.int32)
    order = np.argsort(data, kind="stable")
    key = data[order].astype(np.int64) * (2 * n + 2 * w) + order
    at = np.arange(n)
    ahead = np.searchsorted(key, key + w) - at  # equal bytes from here to w - 1 on, itself included
    back = at - np.searchsorted(key, key - w, "right") + 1
    out, into = np.empty(n), np.empty(n)
    out[order], into[order] = GAIN[ahead], GAIN[back]
    first = TERM[np.bincount(data[:w], minlength=256)].sum()
    total = np.empty(n - w + 1)
    total[0] = first
    np.cumsum(into[w:] - out[: n - w], out=total[1:])
    total[1:] += first
    return quantised(total, w)


def side_by_side(data: np.ndarray, w: int = W) -> np.ndarray:
    """Entropy steps of the windows at multiples of w, and of the last one: together they cover every byte."""
    rows = data[: len(data) // w * w].reshape(-1, w)
    if len(data) % w and len(rows):
        rows = np.concatenate([rows, data[None, -w:]])
    rows = np.sort(rows, axis=1)
    edge = np.ones((len(rows), w + 1), bool)
    edge[:, 1:w] = rows[:, 1:] != rows[:, :-1]
    at = np.nonzero(edge.ravel())[0]
    length = np.diff(at)
    row = at[:-1] // (w + 1)
    inside = at[:-1] % (w + 1) < w
    return quantised(np.bincount(row[inside], TERM[np.minimum(length[inside], w)], len(rows)), w)


def rarity(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each entropy step, rarest first, for windows and for small windows; the step of a constant window comes last. 2 STEPS counts reach the driver."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(2 * STEPS, np.int64)
        for b in pieces(batches, "text"):
            data, ends = flat(b.column("text"))
            for a, e in zip(ends[:-1], ends[1:], strict=True):
                if e - a >= W:
                    seen[:STEPS] += np.bincount(side_by_side(data[a:e]), minlength=STEPS)
                if SMALL <= e - a < SHORT:
                    seen[STEPS:] += np.bincount(side_by_side(data[a:e], SMALL), minlength=STEPS)
        full = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(seen[full])], names=["step", "n"])

    counts = np.zeros(2 * STEPS, np.int64)
    for r in need(docs, "text").mapInArrow(count, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).collect():
        counts[r["step"]] = r["n"]
    out = []
    for c in (counts[:STEPS], counts[STEPS:]):
        rank = np.empty(STEPS, np.int64)
        rank[np.lexsort((np.arange(STEPS), c))] = np.arange(STEPS)
        rank[0] = STEPS
        out.append(rank)
    return out[0], out[1]


def chosen(rank: np.ndarray, w: int = W, popular: int = POPULAR) -> np.ndarray:
    """Starts of the windows that are the leftmost of lowest rank in at least `popular` spans of w windows."""
    n = len(rank)
    best = rank << 40 | np.arange(n)
    span = min(w, n)
    width = 1
    while width * 2 <= span:
        best = np.minimum(best[: n - 2 * width + 1], best[width : n - width + 1])
        width *= 2
    if width < span:
        best = np.minimum(best[: n - span + 1], best[span - width : n - width + 1])
    edge = np.append(True, best[1:] != best[:-1])
    at = np.flatnonzero(edge)
    often = np.diff(np.append(at, len(best))) >= min(popular, len(best))
    won = best[at[often]]
    return (won & ((1 << 40) - 1))[won >> 40 < STEPS]


def steps_of(raw: bytes, known: np.ndarray | None = None, same: int = 0) -> np.ndarray:
    """entropies of a text; `known` are those of another one whose first `same` bytes are equal."""
    data, n = np.frombuffer(raw, np.uint8), max(0, same - W + 1)
    return entropies(data) if not n else np.concatenate([known[:n], entropies(data[n:])])


def features(raw: bytes, rank: np.ndarray, steps: np.ndarray, w: int = W, popular: int = POPULAR) -> np.ndarray:
    """64-bit hashes of a text's features, in order."""
    if not raw:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(raw, np.uint8)
    at = chosen(rank[steps], w, popular) if len(steps) else np.zeros(0, np.int64)
    if not len(at):
        return np.array([int.from_bytes(hashlib.sha256(raw).digest()[:8], "little")], np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(data, w)[at]
    return mix64((windows * WEIGHT[:w]).sum(axis=1, dtype=np.uint64))


#: A digest: the chains of its windows and of its small windows (empty if the text isn't short).
Digest = tuple[np.ndarray, np.ndarray]


def digest(raw: bytes, ranks: tuple[np.ndarray, np.ndarray], steps: np.ndarray) -> Digest:
    """steps: steps_of the text."""
    small = features(raw, ranks[1], entropies(np.frombuffer(raw, np.uint8), SMALL), SMALL, SMALL_POPULAR) if len(raw) < SHORT else np.zeros(0, np.uint64)
    return filters(features(raw, ranks[0], steps)), filters(small)


def filters(found: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters, a row of bits each."""
    if not len(found):
        return np.zeros((0, BITS), np.uint8)
    out = np.zeros((-(-len(found) // FULL), BITS), np.uint8)
    row = np.arange(len(found)) // FULL
    for k in range(MARKS):
        out[row, (found >> U(11 * k) & U(BITS - 1)).astype(np.int64)] = 1
    return out


def likeness(x: Digest, y: Digest) -> float:
    """0 to 1, by the small windows if both texts are short."""
    if x[0].shape == y[0].shape and (x[0] == y[0]).all() and x[1].shape == y[1].shape and (x[1] == y[1]).all():
        return 1.0
    small = len(x[1]) and len(y[1])
    return min(overlap(x[1], y[1]) if small else overlap(x[0], y[0]), 0.999999)


def overlap(x: np.ndarray, y: np.ndarray) -> float:
    """0 to 1: the mean, over the filters of the shorter chain, of the best normalised overlap in the other."""
    if not len(x) or not len(y):
        return 0.0
    if len(x) > len(y):
        x, y = y, x
    nx, ny = x.sum(axis=1, dtype=np.int64)[:, None], y.sum(axis=1, dtype=np.int64)[None, :]
    both = x.astype(np.float32) @ y.astype(np.float32).T
    chance, most = nx * ny / BITS, np.minimum(nx, ny)
    share = np.where(most > chance, (both - chance) / np.maximum(most - chance, 1e-9), 0.0)
    best = np.clip(share, 0, 1).max(axis=1)
    return float(best.mean())


def written(d: Digest) -> str:
    """Hexadecimal; the chain of small windows, if there is one, after a colon."""
    text = [np.packbits(f, axis=1).tobytes().hex() if len(f) else "" for f in d]
    return ":".join(text) if text[1] else text[0]


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the following one."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def in_order(docs: DataFrame, slice_bytes: int) -> tuple[DataFrame, int]:
    """Rows dealt out once to slices by descending id, each slice with the first row of the next one (head = true) behind its own."""
    key = ordered_key(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))), descending=True)
    rows = need(docs, "doc_id", "text").withColumn("key", key)
    narrow = materialise(rows.select("key", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("weight")))
    total = narrow.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    bounds = splitters(narrow, total, min(MOST_SLICES, max(1, -(-total // slice_bytes))), tolerance=0.25, probes=1024)
    narrow = materialise(narrow.withColumn("slice", slice_of(bounds)))
    heads = sorted((int.from_bytes(bytes(r["key"]), "big"), r["slice"]) for r in narrow.groupBy("slice").agg(F.min("key").alias("key")).collect())  # a row a slice
    marks, mine = halves(k for k, _ in heads), np.array([s for _, s in heads] or [0], np.int32)
    before = np.roll(mine, 1)  # the slice that each head follows; the first follows the last

    @F.pandas_udf("slice int, follows int")
    def placed(key: pd.Series) -> pd.DataFrame:
        k = keys_of(pa.array(key, pa.binary()))
        nth = below(k, marks) - 1
        return pd.DataFrame({"slice": mine[nth], "follows": np.where((k == marks[nth]).all(axis=1), before[nth], -1)})

    rows = rows.withColumn("at", placed("key"))
    own = F.struct(F.col("at.slice").alias("slice"), F.lit(False).alias("head"))
    ahead = F.struct(F.col("at.follows").alias("slice"), F.lit(True).alias("head"))
    return rows.select("doc_id", "text", "key", F.inline(F.when(F.col("at.follows") >= 0, F.array(own, ahead)).otherwise(F.array(own)))), max(1, len(heads))


def with_next(docs: DataFrame, *, slice_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row."""
    prepare(docs.sparkSession)
    ranks = rarity(docs)
    rows, n = in_order(docs, slice_bytes)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior: tuple | None = None

        def row(doc_id, text: str, steps: np.ndarray, own: Digest, following: str, other: Digest) -> tuple:  # noqa: ANN001
            e = edited(text, following)
            raw = e.encode()
            same = len(text[: len(text) - len(text) // 3].encode())
            mark = own if e == text else digest(raw, ranks, steps_of(raw, steps, same))
            return doc_id, len(text), hashlib.sha256(raw).hexdigest(), written(own), written(mark), likeness(own, mark), likeness(own, other)

        for b in batches:
            out = []
            for s, head, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("slice", "head", "doc_id", "text")), strict=True):
                text = text or ""
                raw = text.encode()
                steps = steps_of(raw)
                own = digest(raw, ranks, steps)
                if prior is not None and prior[0] == s:
                    out.append(row(*prior[1:], text, own))
                prior = None if head else (s, doc_id, text, steps, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [b.column("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()], strict=True)], names=names)

    dealt = rows.repartition(n, "slice").sortWithinPartitions("slice", "head", "key")
    return dealt.select("slice", "head", "doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op9_improbable_digest(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    return with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
