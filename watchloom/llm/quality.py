"""Quality by ordinal regression: shared hashed-text weights with ordered thresholds (cumulative links).

P(grade >= j) = sigmoid(x w - t[j]) with t ascending; the grades that the sample holds, whatever whole numbers they are, count from 0 up. x is the mean, over a text's words, of hashed features: the
word's end, its shape with the one before it, and whether it repeats the one before. The expected grade is the sum of
the tails; selection goes by the tail at the top grade (or another one).

The model is fitted on a sample of at most `most` labelled documents, which is small enough for the driver; scoring runs over
all texts where they are read.

Defined results: null and blank texts have x = 0 and get the tails of the thresholds alone; labels without a document, null labels and
null ids don't teach; several labels of an id count as the largest, several rows of one as the one of least text; without labels, or with one grade only, every document is
kept with tail 1; other columns are not touched; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchloom.llm.common import labelled_sample, need, pieces, prepare, unused
from watchloom.llm.words import BYTE_CODE, U, flat, mix64, words_of

#: log2 of the number of hashed features; labelled documents for the fit at most.
FEATURE_BITS, SAMPLE = 16, 6000
#: Documents whose tail is below this are rejected: well under the middle, so that clean ones stay.
KEEP = 0.4
KIND = np.zeros(256, np.uint8)  # other bytes: punctuation
KIND[list(range(97, 123))], KIND[list(range(65, 91))], KIND[list(range(48, 58))] = 1, 2, 4
KIND[128:] = 1


def hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features: a row of three for each word, offsets of the documents in the words)."""
    w = words_of(column)
    n = len(w.start)
    if not n:
        return np.zeros((0, 3), np.int64), w.first
    raw = flat(column)[0]
    kind = KIND[raw]
    length = w.stop - w.start
    has = np.zeros((n, 4), bool)
    for k, bit in enumerate((1, 2, 4)):
        total = np.concatenate([[0], np.cumsum(kind == bit)])
        has[:, k] = total[w.stop] > total[w.start]
    total = np.concatenate([[0], np.cumsum(kind == 0)])
    marks = np.minimum(total[w.stop] - total[w.start], 3)
    shape = (has[:, 0] + 2 * has[:, 1] + 4 * has[:, 2] + 8 * marks + 32 * np.minimum(length, 12) // 4).astype(np.uint64)
    end = np.zeros(n, np.uint64)
    for k in (1, 2, 3):
        at = np.maximum(w.stop - k, 0)
        end = end * U(257) + np.where(length >= k, BYTE_CODE[raw[at]], U(1))
    last = np.append(U(0), shape[:-1])
    same = np.append(False, w.hash[1:] == w.hash[:-1]).astype(np.uint64)
    starts = w.first[:-1][np.diff(w.first) > 0]
    last[starts], same[starts] = U(1 << 20), U(0)
    shift = U(64 - FEATURE_BITS)
    return np.stack([(mix64(end) >> shift), (mix64(shape * U(4099) + last + U(7)) >> shift), (mix64(same + U(12345)) >> shift)], axis=1).astype(np.int64), w.first


def sample_matrix(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, share, grades) of the sample: features are counted on the executors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            f, first = hashed(b.column("text"))
            out = []
            for a, e, y in zip(first[:-1], first[1:], b.column("label").to_pylist(), strict=True):
                k, c = np.unique(f[a:e], return_counts=True)
                out.append((y, k.astype(np.int32).tobytes(), (c / max(1, e - a)).astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int32(), pa.binary(), pa.binary()], strict=True)], names=["label", "f", "v"])

    got = rows.mapInArrow(run, "label int, f binary, v binary").collect()
    cols, vals = [np.frombuffer(r["f"], np.int32) for r in got], [np.frombuffer(r["v"], np.float32) for r in got]
    row = np.repeat(np.arange(len(got)), [len(c) for c in cols])
    none = np.zeros(0)
    grade = np.unique([r["label"] for r in got], return_inverse=True)[1].astype(int)
    return row, np.concatenate(cols) if cols else none.astype(int), np.concatenate(vals) if vals else none, grade


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(row: np.ndarray, col: np.ndarray, val: np.ndarray, grade: np.ndarray, *, dims: int = 1 << FEATURE_BITS, rounds: int = 200, rate: float = 0.3, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ascending thresholds), by Adam on the log loss of the grades 0 .. K - 1."""
    top = int(grade.max()) if len(grade) else 0
    w = np.zeros(dims)
    if top < 1 or grade.min() == grade.max():
        return w, np.full(max(top, 1), -50.0)
    share = np.array([np.mean(grade >= j) for j in range(1, top + 1)]).clip(1e-3, 1 - 1e-3)
    t = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(top))
    order = np.argsort(col, kind="stable")
    row, col, val = row[order], col[order], val[order]
    m, v = np.zeros(dims + top), np.zeros(dims + top)
    n, index = len(grade), np.arange(len(grade))
    for step in range(1, rounds + 1):
        x = np.bincount(row, w[col] * val, n)
        s = sigmoid(x[:, None] - t)  # P(grade >= j)
        tails = np.concatenate([np.ones((n, 1)), s, np.zeros((n, 1))], axis=1)
        p = np.maximum(tails[index, grade] - tails[index, grade + 1], 1e-9)
        slope = np.concatenate([np.zeros((n, 1)), s * (1 - s), np.zeros((n, 1))], axis=1)
        up, down = slope[index, grade], slope[index, grade + 1]
        gx = -(up - down) / p / n
        gt = np.zeros(top + 2)
        np.add.at(gt, grade, up / p / n)
        np.add.at(gt, grade + 1, -down / p / n)
        g = np.concatenate([np.bincount(col, gx[row] * val, dims) + decay * w, gt[1:-1]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:dims]
        t = np.maximum.accumulate(t - 0.1 * move[dims:])
    return w, t


def train(docs: DataFrame, labels: DataFrame, *, column: str = "quality", most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    prepare(docs.sparkSession)
    return fit(*sample_matrix(labelled_sample(docs, labels, column, most)))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], *, at: int | None = None, names: tuple[str, str] = ("expected_grade", "tail_probability")) -> DataFrame:
    """docs with expected_grade and tail_probability, P(grade >= at), at the top grade if none is given; columns of these names are replaced."""
    w, t = docs.sparkSession.sparkContext.broadcast(model[0].astype(np.float32)), model[1]
    keep = [f for f in docs.schema.fields if f.name not in names]
    docs = docs.select(*[docs[f.name] for f in keep])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            f, first = hashed(b.column("text"))
            total = np.concatenate([[0.0], np.cumsum(w.value[f].sum(axis=1, dtype=np.float64))])
            x = (total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1)
            tails = sigmoid(x[:, None] - t)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, (at or len(t)) - 1])], names=[*b.schema.names, *names])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return docs.mapInArrow(run, f"{out}, `{names[0]}` double, `{names[1]}` double")


def selected(docs: DataFrame, labels: DataFrame, *, keep: float = KEEP) -> DataFrame:
    """The documents whose tail probability reaches `keep`, in the columns of docs."""
    names = unused(docs, "_grade"), unused(docs, "_tail")
    return score(docs, train(docs, labels), names=names).where(F.col(names[1]) >= keep).select(*docs.columns)


def op6_ordinal_quality(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = score(need(docs, "doc_id", "text"), train(docs, labels))
    return found.select("doc_id", "expected_grade", "tail_probability", (F.col("tail_probability") >= KEEP).alias("keep"))
